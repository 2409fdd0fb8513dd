"""Incremental load of a table from its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.functions.windows import TimeWindow
from tablemend.operators.convert import nan_to_null
from tablemend.operators.upsert import dedupe_upsert, upsert
from tablemend.session import materialize
from tablemend.sources.scans import read_window

# Partition values read to the driver to prune the scan; more of them are matched by a join.
_LISTED_PARTITIONS = 10_000


def incremental_load(
    target: DataFrame, source: DataFrame, keys: list[str], ts: str, window: TimeWindow, columns: list[str] | None = None
) -> DataFrame:
    """Target after loading the latest source row per key of a closed window."""
    changed = nan_to_null(read_window(source, ts, window))
    return dedupe_upsert(target, changed, keys, [ts], columns)


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition: str, staging: str
) -> None:
    """Upsert into partitioned files, writing the touched partitions alone.

    For tables too large to rewrite as a whole. A key stays in its partition
    for life, as with a creation day; a change set in which one moves raises
    ValueError and changes nothing. To know this, the keys and partitions of the
    whole target are scanned, no other columns. Rows without a partition are one
    of their own. The change set is evaluated once and written down. The merged partitions are complete in the staging folder before the
    first old file is replaced.
    """
    target = spark.read.parquet(path)
    source = materialize(source, "changes")
    moved = (
        target.select(*keys, partition)
        .join(source.select(*keys, F.col(partition).alias("__new")), keys)
        .where(~F.col(partition).eqNullSafe(F.col("__new")))
    )
    if not moved.isEmpty():
        raise ValueError(f"a key of the change set is held in another partition of {path}")
    touched = source.select(partition).distinct()
    values = [r[0] for r in touched.limit(_LISTED_PARTITIONS + 1).collect()]
    unknown = F.col(partition).isNull()
    if len(values) <= _LISTED_PARTITIONS:
        listed = F.col(partition).isin([v for v in values if v is not None])
        current = target.where(listed | unknown if None in values else listed)
    else:
        current = target.join(touched, partition, "left_semi").unionByName(target.where(unknown))
    merged = upsert(current, source.select(*target.columns), keys)
    merged.hint("rebalance", partition).write.partitionBy(partition).parquet(staging)
    done = spark.read.schema(merged.schema).parquet(staging).select(*target.columns)
    done.write.partitionBy(partition).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
