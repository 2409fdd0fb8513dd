"""Row numbers without collecting a group, or the table, into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemend.operators.keys import estimated_bytes
from tablemend.session import materialize

_PART, _FROM, _COPIES, _TOTAL, _OFFSET = "__part", "__from", "__copies", "__total", "__offset"
# Compressed bytes; rows take several times as much in memory.
_PARTITION_BYTES = 64 * 2**20
_MORE, _UNKNOWN = 8, 2**34
# Numbers of copies written out at a time.
_AT_ONCE = 100_000


def _partitions_for(df: DataFrame) -> int:
    """Range partitions for the estimated size, no fewer than the session's shuffles use and at most `_MORE` times as many:
    estimates of joins, and of rows that are no files, may be far too high."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = (estimated_bytes(df) or 0) // _PARTITION_BYTES
    return usual if wanted > _UNKNOWN else max(usual, min(wanted, _MORE * usual))


def numbered(
    df: DataFrame, group: list[str], order: list[str], name: str = "row_no", partitions: int | None = None
) -> DataFrame:
    """Number the rows of each group by `order`, from 1; nulls form their own group.

    The other columns settle ties. Equal rows of a task are one row with a count, so it does not matter which of them is
    which. These counted rows are range-partitioned by group and order, a large group thus over many partitions, and
    written once with the sum of the counts before them in their partition and group. A row's numbers begin after that
    sum and the group's counts in earlier partitions. A partition has at most one group that began earlier, hence at
    most one such offset each, and the broadcast table is never longer than the number of partitions.
    """
    ties = [c for c in df.columns if c not in {*group, *order}]
    # Copies from different tasks stay apart and can lie in different partitions.
    counted = df.withColumn(_PART, F.spark_partition_id()).groupBy(*df.columns, _PART).agg(F.count("*").alias(_COPIES))
    sort = [*group, *order, *ties, _PART]
    in_order = counted.repartitionByRange(partitions or _partitions_for(df), *sort).sortWithinPartitions(*sort)
    placed = in_order.drop(_PART).withColumns({_PART: F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    here = Window.partitionBy(_PART, *group).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = materialize(placed, "numbered").withColumn(_FROM, F.sum(_COPIES).over(here) - F.col(_COPIES))
    before = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(_PART, *group)
        .agg(F.sum(_COPIES).alias(_TOTAL))
        .withColumn(_OFFSET, F.sum(_TOTAL).over(before))
        .where(F.col(_OFFSET) > 0)
        .select(F.col(_PART).alias("__in"), *[F.col(c).alias(f"__in_{c}") for c in group], _OFFSET)
    )
    same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"__in_{c}")), group, F.col(_PART) == F.col("__in"))
    first = (F.col(_FROM) + F.coalesce(F.col(_OFFSET), F.lit(0))).alias(_FROM)
    found = placed.join(F.broadcast(offsets), same, "left").select(*df.columns, first, _COPIES)
    # Two steps, so that no array is longer than a bound however many copies there are.
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col(_COPIES) - 1, F.lit(_AT_ONCE).cast("long")))
    last = F.least(F.col("__start") + _AT_ONCE, F.col(_COPIES)) - 1
    return (
        found.select("*", start.alias("__start"))
        .select(*df.columns, _FROM, F.explode(F.sequence(F.col("__start"), last)).alias("__copy"))
        .select(*df.columns, (F.col(_FROM) + F.col("__copy") + 1).alias(name))
    )


def row_range(df: DataFrame, key: list[str], lo: int, hi: int) -> DataFrame:
    """Rows `lo` to `hi`, both included, by row number in the order of a key."""
    return numbered(df, [], key).where(F.col("row_no").between(lo, hi))
