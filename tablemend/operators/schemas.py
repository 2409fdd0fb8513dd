"""Catalogs of key columns and table columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.text import comma_list

# Staging columns that have no source counterpart.
STAGING_COLUMNS = ("GBN", "DMS_SCN")
_SIDES = ("source", "staged", "target", "private")


def collect_keys(catalog: DataFrame, position: str = "ordinal_position") -> DataFrame:
    """Key columns of every verified table, in catalog order."""
    rows = catalog.where(F.col("verification_yn") == "Y")
    columns = F.array_sort(F.collect_list(F.struct(position, "column_name")))
    return rows.groupBy(F.concat_ws(".", "owner", "table_name").alias("full_table_name")).agg(
        columns["column_name"].alias("key_columns")
    )


def tables_with_column(tables: DataFrame, columns: DataFrame, name: str) -> DataFrame:
    """Tables that have a column of the given name."""
    having = columns.where(F.col("column_name") == name)
    return tables.join(having, ["schema_name", "table_name"], "left_semi")


def schema_parity(
    source: DataFrame,
    staged: DataFrame,
    target: DataFrame,
    private: DataFrame,
    table: tuple[str, ...] = ("schema_name", "table_name"),
) -> DataFrame:
    """Column lists of source, staging and target compared table by table.

    Staging must hold the same columns as the source in any order, apart from
    its own technical ones. The target must hold the source columns without
    the private ones, in source order. One-sided columns are listed by name.
    What is gathered per table is its column list, never rows.
    """

    def side(df: DataFrame, mark: str, position: Column | None = None) -> DataFrame:
        return df.select(
            *table,
            "column_name",
            F.lit(mark).alias("mark"),
            (F.lit(None) if position is None else position).cast("long").alias("position"),
        )

    ordinal = F.col("ordinal_position")
    stacked = reduce(
        DataFrame.unionByName,
        [
            side(source, "source", ordinal),
            side(staged.where(~F.col("column_name").isin(*STAGING_COLUMNS)), "staged"),
            side(target, "target", ordinal),
            side(private, "private"),
        ],
    )

    def has(mark: str) -> Column:
        return F.max(F.col("mark") == mark)

    def place(mark: str) -> Column:
        return F.min(F.when(F.col("mark") == mark, F.col("position")))

    columns = stacked.groupBy(*table, "column_name").agg(
        *[has(side).alias(side) for side in _SIDES],
        place("source").alias("source_at"),
        place("target").alias("target_at"),
    )
    facts = F.struct("column_name", "source", "staged", "target", "private", "source_at", "target_at")
    listed = columns.groupBy(*table).agg(F.array_sort(F.collect_list(facts)).alias("c"))

    def chosen(when: Callable[[Column], Column]) -> Column:
        """Columns that meet a condition, by name."""
        return F.filter("c", when)

    def by_position(when: Callable[[Column], Column], position: str) -> Column:
        moved = F.transform(chosen(when), lambda x: F.struct(x[position].alias("p"), x["column_name"].alias("n")))
        return F.transform(F.array_sort(moved), lambda x: x["n"])

    def count(side: str) -> Column:
        return F.size(chosen(lambda x: x[side])).cast("long")

    compared = listed.select(
        *table,
        *[count(side).alias(f"{side}_col_cnt") for side in _SIDES],
        comma_list(chosen(lambda x: x["source"] & ~x["staged"])["column_name"]).alias("source_only"),
        comma_list(chosen(lambda x: x["staged"] & ~x["source"])["column_name"]).alias("staged_only"),
        by_position(lambda x: x["source"] & ~x["private"], "source_at").alias("__expected"),
        by_position(lambda x: x["target"], "target_at").alias("__actual"),
    )
    return compared.select(
        *table,
        ((F.col("source_only") == "") & (F.col("staged_only") == "")).alias("staged_is_match"),
        (F.col("__expected") == F.col("__actual")).alias("target_is_match"),
        *[f"{side}_col_cnt" for side in _SIDES],
        "source_only",
        "staged_only",
    )
