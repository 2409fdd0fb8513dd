"""Recompute daily summaries over date windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.operators.keys import broadcast_if_short

# Days of windows, a few bytes each.
_SHORT_DAYS = 100_000


def window_days(windows: DataFrame, label: str) -> DataFrame:
    """Every day of every window; a reversed window has none."""
    start, end = F.col("window_start"), F.col("window_end")
    return (
        windows.where(start <= end)
        .select(F.col(label), F.explode(F.sequence(start, end)).alias("day"))
        .distinct()
    )


def recompute_windows(
    facts: DataFrame, ts: str, windows: DataFrame, label: str, by: list[str], aggregates: list[Column]
) -> DataFrame:
    """Summaries of all days that some window covers, one set per window label.

    Days are aggregated once however many windows share them; only the short
    result meets the windows. The span of the windows limits the scan itself.
    """
    days = window_days(windows, label)
    kind = facts.schema[ts].dataType

    def edge(day: Column) -> Column:
        return days.agg(day.cast(kind)).scalar()

    spanned = (F.col(ts) >= edge(F.min("day"))) & (F.col(ts) < edge(F.date_add(F.max("day"), 1)))
    dated = facts.where(spanned).withColumn("day", F.col(ts).cast("date"))
    needed = dated.join(broadcast_if_short(days.select("day").distinct(), _SHORT_DAYS), "day", "left_semi")
    return needed.groupBy("day", *by).agg(*aggregates).join(broadcast_if_short(days, _SHORT_DAYS), "day")


def replace_days(mart: DataFrame, fresh: DataFrame, windows: DataFrame, label: str, day: str = "day") -> DataFrame:
    """Mart with the days of the windows replaced by fresh rows.

    A day that several windows share comes with the rows of the first label
    alone; equal rows of one label all stay.
    """
    labelled = window_days(windows, label).withColumnRenamed("day", day)
    days = labelled.select(day).distinct()
    kept = mart.join(broadcast_if_short(days, _SHORT_DAYS), day, "left_anti")
    chosen = labelled.groupBy(day).agg(F.min(label).alias(label))
    taken = fresh.join(broadcast_if_short(chosen, _SHORT_DAYS), [day, label], "left_semi")
    return kept.unionByName(taken.select(*mart.columns))
