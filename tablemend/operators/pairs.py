"""Comparison of two row sets by value, without change windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.operators.keys import rows_with_key, rows_without_key


def outer_indicator(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Which side every distinct row occurs on, and how often.

    Grouping compares null with null and NaN with NaN, and merges copies before
    the shuffle.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    stacked = left.select(*columns, one.alias("left_rows"), none.alias("right_rows")).unionByName(
        right.select(*columns, none.alias("left_rows"), one.alias("right_rows"))
    )
    counted = stacked.groupBy(*columns).agg(
        F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")
    )
    side = (
        F.when(F.col("right_rows") == 0, "left_only").when(F.col("left_rows") == 0, "right_only").otherwise("both")
    )
    return counted.withColumn("side", side)


def one_sided_rows(left: DataFrame, right: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Rows on one side only, as comma-joined key text, change time and a source flag."""
    compared = outer_indicator(left, right, [*keys, ts]).where(F.col("side") != "both")
    return compared.select(
        F.concat_ws(",", *[F.col(k).cast("string") for k in keys]).alias("keys"),
        F.col(ts).alias("chg_dtm"),
        F.when(F.col("side") == "left_only", "Y").otherwise("N").alias("source_yn"),
    )


def key_set_diff(source: DataFrame, target: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """Keys on one side only with y/n flags and the carried columns, each key once."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*carried).alias(name))

    stacked = side(source, "s").unionByName(side(target, "t"), allowMissingColumns=True)
    found = stacked.groupBy(*keys).agg(F.max("s").alias("s"), F.max("t").alias("t"))
    here, there = F.col("s").isNotNull(), F.col("t").isNotNull()
    return found.where(here != there).select(
        *keys,
        *[F.coalesce(F.col("s")[c], F.col("t")[c]).alias(c) for c in carried],
        F.when(there, "y").otherwise("n").alias("target_yn"),
        F.when(here, "y").otherwise("n").alias("source_yn"),
    )


def deleted_keys(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Target keys gone from the source, each once."""
    return outer_indicator(target, source, keys).where(F.col("side") == "left_only").select(*keys)


def still_missing(log: DataFrame, target: DataFrame, keys: list[str], batch_id: str) -> DataFrame:
    """Logged source-only keys of a batch that the target still lacks."""
    return rows_without_key(log.where(F.col("batch_id") == batch_id), target, keys)


def still_present(log: DataFrame, target: DataFrame, keys: list[str], batch_id: str) -> DataFrame:
    """Logged target-only keys of a batch that the target still has."""
    return rows_with_key(log.where(F.col("batch_id") == batch_id), target, keys)


def rows_for_keys(source: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Full source rows for a list of keys; a short list is broadcast by the optimizer."""
    return rows_with_key(source, wanted, keys)


def merged_keys(changed: DataFrame, missing: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of both lists, each once."""
    return changed.select(*keys).unionByName(missing.select(*keys)).distinct()


def set_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of `left` that `right` lacks; null equals null."""
    return left.select(*columns).subtract(right.select(*columns))


def tables_to_repair(log: DataFrame, catalog: DataFrame, batch_id: str, with_source_only: bool = True) -> DataFrame:
    """Tables of a batch with differences to repair, with their schema.

    The narrow form looks at changed rows alone.
    """
    wrong = F.col("chg_dtm_diff_count") != 0
    if with_source_only:
        wrong = wrong | (F.col("source_only_count") != 0)
    hit = log.where((F.col("batch_id") == batch_id) & wrong).select("table_nm").distinct()
    return catalog.select("table_schema", "table_name").distinct().join(
        hit, F.col("table_name") == F.col("table_nm")
    ).select("table_nm", "table_schema")
