"""Row counts and column sums, and their comparison across copies of a table.

Results are matched by table and column name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.functions.numbers import exact_sum, or_zero, percent, round_sum
from tablemend.functions.times import day_last_second, day_start, ntz
from tablemend.functions.windows import TimeWindow


def table_count(df: DataFrame, table: str, ts: str | None = None, window: TimeWindow | None = None) -> DataFrame:
    """Row count, of a closed window if one is given."""
    rows = df if window is None else df.where(window.holds(F.col(ts)))
    return rows.agg(F.lit(table).alias("table_name"), F.count("*").alias("row_count"))


def count_and_sums(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Count and column sums from one scan: one row per column, or a single row without columns."""
    totals = df.agg(F.count("*").alias("row_count"), *[exact_sum(df.schema[c]).alias(c) for c in columns])
    named = totals.withColumn("table_name", F.lit(table))
    if not columns:
        return named.select(
            "table_name",
            "row_count",
            F.lit(None).cast("string").alias("column_name"),
            F.lit(None).cast("decimal(38,6)").alias("total"),
        )
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("total")) for c in columns]
    return named.select("table_name", "row_count", F.inline(F.array(*pairs)))


def on_load_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Rows of one load day, without its last second."""
    start = day_start(ntz(day))
    return df.where((F.col(ts) >= start) & (F.col(ts) < day_last_second(ntz(day))))


def count_and_sums_today(df: DataFrame, table: str, columns: list[str], ts: str, day: str) -> DataFrame:
    return count_and_sums(on_load_day(df, ts, day), table, columns)


def table_profiles(
    tables: dict[str, DataFrame],
    sums: dict[str, list[str]] | None = None,
    load_day: dict[str, str] | None = None,
    day: str | None = None,
) -> DataFrame:
    """Profiles of several tables; those in `load_day` are limited to that day by the named column."""
    sums, load_day = sums or {}, load_day or {}

    def profile(name: str) -> DataFrame:
        rows = tables[name] if name not in load_day else on_load_day(tables[name], load_day[name], day)
        return count_and_sums(rows, name, sums.get(name, []))

    return reduce(DataFrame.unionByName, [profile(name) for name in tables])


def _counts(profiles: DataFrame, name: str) -> DataFrame:
    return profiles.select("table_name", F.col("row_count").alias(name)).distinct()


def compare_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts, difference and its percentage of the source; a table missing on one side has no count."""
    both = _counts(source, "source_cnt").join(_counts(target, "target_cnt"), "table_name", "full_outer")
    gap = or_zero(F.col("source_cnt")) - or_zero(F.col("target_cnt"))
    return both.select(
        "table_name",
        "source_cnt",
        "target_cnt",
        gap.alias("source_minus_target_cnt"),
        percent(gap, or_zero(F.col("source_cnt"))).alias("diff_range"),
    )


def compare_sums(source: DataFrame, target: DataFrame) -> DataFrame:
    """Column sums rounded to three digits, missing as zero, and their difference."""

    def sums(profiles: DataFrame, name: str) -> DataFrame:
        rows = profiles.where(F.col("column_name").isNotNull())
        return rows.select("table_name", "column_name", F.col("total").alias(name))

    both = sums(source, "s").join(sums(target, "t"), ["table_name", "column_name"], "full_outer")
    left, right = round_sum(F.col("s")), round_sum(F.col("t"))
    return both.select(
        "table_name",
        "column_name",
        left.alias("source_sum"),
        right.alias("target_sum"),
        (left - right).cast("decimal(38,3)").alias("source_minus_target_sum"),
    )


def compare_three(files: DataFrame, source: DataFrame, target: DataFrame, skipped: list[str] | None = None) -> DataFrame:
    """Counts of landing files, source and target with their pairwise differences.

    Tables in `skipped` have no landing files and count as zero there.
    """
    names = ("files_cnt", "source_cnt", "target_cnt")
    joined = reduce(
        lambda a, b: a.join(b, "table_name", "full_outer"),
        [_counts(p, n) for p, n in zip((files, source, target), names)],
    )
    f, s, t = (or_zero(F.col(n)) for n in names)
    f = F.when(F.col("table_name").isin(skipped or []), 0).otherwise(f).cast("long")

    def gap(a: Column, b: Column, name: str) -> Column:
        return (a - b).alias(name)

    return joined.select(
        "table_name",
        f.alias("files_cnt"),
        s.alias("source_cnt"),
        t.alias("target_cnt"),
        gap(f, s, "files_minus_source_cnt"),
        gap(s, t, "source_minus_target_cnt"),
        gap(f, t, "files_minus_target_cnt"),
    )


def check_catalog(count_list: DataFrame, sum_list: DataFrame, by_load_day: str) -> DataFrame:
    """Tables to count with the columns to sum; a table without columns keeps one row."""
    names = ["schema_name", "table_name"]
    chosen = count_list.where((F.col("verification_yn") == "Y") & (F.col("etl_dtm_exist_yn") == by_load_day))
    sums = sum_list.where((F.col("sum_check_yn") == "Y") & (F.col("etl_dtm_exist_yn") == by_load_day))
    return chosen.select(*names).join(sums.select(*names, "column_name"), names, "left")


def _log_names(full_name: Column) -> list[Column]:
    """Schema and table of a full name."""
    return [F.split_part(full_name, F.lit("."), F.lit(1)).alias("schema_name"), F.split_part(full_name, F.lit("."), F.lit(2)).alias("table_name")]


# The fields of both logs have these names.
def count_log(source: DataFrame, target: DataFrame, verify_date: str, database: str, by_load_day: str) -> DataFrame:
    """Compared counts of profiles named `schema.table` as rows of the count log; no count is zero."""
    compared = compare_counts(source, target)
    return compared.select(
        F.lit(verify_date).alias("verify_date"),
        F.lit(database).alias("database_name"),
        *_log_names(F.col("table_name")),
        F.lit(by_load_day).alias("etl_dtm_exist_yn"),
        or_zero(F.col("source_cnt")).alias("source_cnt"),
        or_zero(F.col("target_cnt")).alias("target_cnt"),
        "source_minus_target_cnt",
    )


def sum_log(source: DataFrame, target: DataFrame, verify_date: str, database: str, by_load_day: str) -> DataFrame:
    """Compared column sums of profiles named `schema.table` as rows of the sum log."""
    compared = compare_sums(source, target)
    return compared.select(
        F.lit(verify_date).alias("verify_date"),
        F.lit(database).alias("database_name"),
        *_log_names(F.col("table_name")),
        "column_name",
        F.lit(by_load_day).alias("etl_dtm_exist_yn"),
        "source_sum",
        "target_sum",
        "source_minus_target_sum",
    )


def catalog_profiles(
    catalog: DataFrame, open_table: Callable[[str], DataFrame], load_day: str | None = None, day: str | None = None
) -> DataFrame:
    """Profiles of the tables of a check catalog, with the sums it asks for; `load_day` limits them to a day."""
    named = F.concat_ws(".", "schema_name", "table_name").alias("name")
    # A row for each column to sum of each table that is checked.
    rows = catalog.groupBy(named).agg(F.sort_array(F.collect_set("column_name")).alias("columns")).orderBy("name").collect()
    tables = {r["name"]: open_table(r["name"]) for r in rows}
    by_day = dict.fromkeys(tables, load_day) if load_day else None
    return table_profiles(tables, {r["name"]: list(r["columns"]) for r in rows}, by_day, day)


_FILE = ["file_path", "file_size", "file_modification_time"]


def refreshed_file_sums(spark: SparkSession, path: str, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """Row count and exact sums of every parquet file under a prefix: path, size, time, row_count and a sum a column.

    `known` is what an earlier run returned, written down. Files with the same path, size and time keep their sums, only
    new and changed files are read, and files that are gone fall out. Files are listed without being opened; the names
    of those to read pass through the driver, which plans the scan by them anyway. An empty prefix has no rows.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    there = listing.select(*[F.col(f"_metadata.{c}").alias(c) for c in _FILE])
    new = there if known is None else there.join(known.select(*_FILE), _FILE, "left_anti")
    names = [r["file_path"] for r in new.select("file_path").collect()]
    sums = [F.sum(F.col(c).cast("decimal(38,6)")).alias(f"sum_{c}") for c in columns]
    kept = None if known is None else known.join(there, _FILE, "left_semi")
    if not names:
        if kept is None:
            fields = ", ".join(f"sum_{c} decimal(38,6)" for c in columns)
            types = "file_path string, file_size long, file_modification_time timestamp, row_count long"
            return spark.createDataFrame([], f"{types}, {fields}" if fields else types)
        return kept
    read = spark.read.parquet(*names).groupBy(*[F.col(f"_metadata.{c}").alias(c) for c in _FILE])
    # A file without rows still has a line, so that it is not read again.
    found = new.join(read.agg(F.count("*").alias("row_count"), *sums), _FILE, "left").fillna(0, ["row_count"])
    return found if kept is None else kept.unionByName(found)


def total_of_files(sums: DataFrame, table: str) -> DataFrame:
    """One row: the table's name, its row count and the sums over all files."""
    columns = [c for c in sums.columns if c.startswith("sum_")]
    totals = [F.sum(c).cast("decimal(38,6)").alias(c) for c in columns]
    count = F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    return sums.agg(F.lit(table).alias("table_name"), count, *totals)
