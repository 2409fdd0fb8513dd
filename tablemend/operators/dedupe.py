"""Latest rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.functions.windows import TimeWindow


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str], tie_break: list[str] | None = None, missing_first: bool = False
) -> DataFrame:
    """One row per key, the greatest by `order`.

    Ties fall to the remaining columns (or `tie_break`), so the pick is stable.
    A missing order value loses unless `missing_first`, the rule of warehouses
    that sort nulls as greatest. The row-number filter lets every map task keep
    one row per key before the shuffle, whatever the number of copies.
    """
    ties = [c for c in df.columns if c not in {*keys, *order}] if tie_break is None else tie_break

    def last(c: str) -> Column:
        return F.col(c).desc_nulls_first() if missing_first else F.col(c).desc_nulls_last()

    ranked = Window.partitionBy(*keys).orderBy(*[last(c) for c in order], *[F.col(c).desc() for c in ties])
    return df.withColumn("__rank", F.row_number().over(ranked)).where(F.col("__rank") == 1).drop("__rank")


def latest_in_window(df: DataFrame, keys: list[str], ts: str, window: TimeWindow) -> DataFrame:
    """Rows of a half-open window with the latest time of their key; ties are kept.

    The maximum is joined back on key and time, a plain semi join that adaptive
    execution can split when many rows share both.
    """
    rows = df.where(window.holds_half_open(F.col(ts)))
    latest = rows.groupBy(*keys).agg(F.max(ts).alias(ts))
    return rows.join(latest, [*keys, ts], "left_semi")


def latest_run(runs: DataFrame, job: list[str], started: str) -> DataFrame:
    """Newest run of every job."""
    return latest_per_key(runs, job, [started])


def sort_result(df: DataFrame, *order: str) -> DataFrame:
    """Presentation order, missing values last; the other columns settle ties and spread them over partitions."""
    rest = [c for c in df.columns if c not in order]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in [*order, *rest]])


def limit_sample(df: DataFrame, n: int) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def distinct_tables(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
