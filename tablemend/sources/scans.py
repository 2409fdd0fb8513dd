"""Table scans. A source is a DataFrame, so filters and column lists reach the files or the database."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.functions.predicates import keys_present
from tablemend.functions.times import day_start, ntz
from tablemend.functions.windows import TimeWindow


@dataclass(frozen=True)
class Route:
    """Where a table is read from: a reader format with its options."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)


def pick_source(spark: SparkSession, table: str, routes: Mapping[str, Route], default: Route) -> DataFrame:
    """Open a table through the route of its name; `{table}` in an option stands for the name."""
    route = routes.get(table, default)
    return spark.read.format(route.format).options(
        **{name: value.replace("{table}", table) for name, value in route.options.items()}
    ).load()


def read_window(source: DataFrame, ts: str, window: TimeWindow, bounds: str = "closed") -> DataFrame:
    """Rows whose change time is in the window: `closed`, `half_open` or `after` its end."""
    column = F.col(ts)
    conditions = {"closed": window.holds, "half_open": window.holds_half_open, "after": window.from_end}
    return source.where(conditions[bounds](column))


def read_full_partitioned(source: DataFrame) -> DataFrame:
    """Whole table, every row once, in the splits of its files.

    Files are cut into tasks as they are, by `spark.sql.files.maxPartitionBytes`;
    only a database needs key ranges, see `read_jdbc_partitioned`.
    """
    return source


def read_jdbc_partitioned(
    spark: SparkSession, options: Mapping[str, str], key: str, lower: int | str, upper: int | str, n: int
) -> DataFrame:
    """Whole database table through n connections, each reading one key range.

    The bounds only place the cuts; rows beyond them are read by the outer ranges.
    """
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("partitionColumn", key)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(n))
        .load()
    )


def read_after_key(source: DataFrame, keys: list[str], last: DataFrame | None = None) -> DataFrame:
    """Rows beyond the last key read, `last` being a mark of `next_mark`.

    A multi-column key is compared column after column. The next mark comes
    from all rows read, so rows sharing a key never fall between two reads.
    """
    if last is None:
        return source
    mark = {k: last.select(F.col("mark")[k]).scalar() for k in keys}
    *leading, final = keys
    beyond = F.col(final) > mark[final]
    for k in reversed(leading):
        beyond = (F.col(k) > mark[k]) | ((F.col(k) == mark[k]) & beyond)
    # The bound on the first key alone can be handed to the scan.
    return source.where((F.col(keys[0]) >= mark[keys[0]]) & beyond)


def next_mark(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The greatest key read, to go on from."""
    return rows.agg(F.max(F.struct(*keys)).alias("mark"))


def read_required(source: DataFrame, columns: list[str], keys: list[str], ts: str, window: TimeWindow) -> DataFrame:
    """Column list of the rows of a window whose keys are all present."""
    return source.where(window.holds(F.col(ts)) & keys_present(keys)).select(*columns)


def hourly_slices(source: DataFrame, ts: str, day: str) -> DataFrame:
    """One scan of a day with the hour each row belongs to; empty hours simply have no rows."""
    start = day_start(ntz(day))
    return source.where((F.col(ts) >= start) & (F.col(ts) < start + F.make_dt_interval(days=F.lit(1)))).withColumn(
        "slice_hour", F.hour(ts)
    )
