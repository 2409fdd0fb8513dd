"""File and table writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.session import exists, materialize

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_landing(df: DataFrame, base: str, schema: str, table: str, run_at: dt.datetime) -> str:
    """Parquet of one run under `schema/table/YYYY/MM/DD/`; a repeated run replaces its own files."""
    path = f"{base}/{schema}/{table}/{run_at:%Y/%m/%d}/{run_at:%Y%m%d-%H%M%S}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_landing_by_day(df: DataFrame, base: str, schema: str, table: str, ts: str) -> str:
    """Parquet under `schema/table` with a folder per day of the change time; days at hand are replaced.

    Rows are gathered by day first; adaptive execution splits a day that is too
    large for one task.
    """
    path = f"{base}/{schema}/{table}"
    day = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    gathered = df.withColumns(day).hint("rebalance", *day)
    gathered.write.partitionBy(*day).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return path


def write_chunks(df: DataFrame, path: str, rows: int) -> None:
    """Files of at most `rows` rows."""
    df.write.option("maxRecordsPerFile", rows).mode("overwrite").parquet(path)


def replace_prefix(df: DataFrame, path: str) -> None:
    """Replace what a prefix holds."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).option("emptyValue", "").csv(path)


def append_batches(df: DataFrame, target: str | Mapping[str, str], batch: int = 10_000) -> None:
    """Append to a folder, or to a database table given by its connection options, `batch` rows at a time.

    A run that is repeated appends its rows again; see `append_run` for folders.
    """
    _save(df, target, "append", batch)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Append the rows of one run to a folder; the same run again replaces its own rows and no others.

    Readers see the run as a column `run`.
    """
    df.write.mode("overwrite").parquet(f"{path}/run={run_id}")


def load_missing(source: DataFrame, ranges: list[str], path: str) -> list[int]:
    """Load a table range by range, each into a folder of its own, and leave out those that are complete already.

    `ranges` are conditions as of `ranges.key_ranges`, kept by the caller between runs. A range that was cut off has no
    mark of success and is loaded anew. Returns the numbers of the ranges loaded.
    """
    spark, loaded = source.sparkSession, []
    for number, condition in enumerate(ranges):
        folder = f"{path}/range={number}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            source.where(condition).write.mode("overwrite").parquet(folder)
            loaded.append(number)
    return loaded


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """A catalog table with a file for each bucket of the keys, sorted by them, so that joins on the keys need no shuffle."""
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).mode("overwrite").saveAsTable(table)


def truncate_insert(df: DataFrame, target: str | Mapping[str, str], batch: int = 10_000) -> None:
    """Empty the target and load it; a database table keeps its definition and grants."""
    _save(df, target, "overwrite", batch)


def _save(df: DataFrame, target: str | Mapping[str, str], mode: str, batch: int) -> None:
    if isinstance(target, str):
        df.write.mode(mode).parquet(target)
    else:
        writer = df.write.format("jdbc").options(**target).option("batchsize", str(batch))
        writer.option("truncate", "true").mode(mode).save()


def replace_periods(target: DataFrame, new: DataFrame, period: str, lo: str, hi: str) -> DataFrame:
    """Content of a table after deleting a range of periods and loading the new rows."""
    outside = ~F.coalesce(F.col(period).between(lo, hi), F.lit(False))
    return target.where(outside).unionByName(new.select(*target.columns))


def delete_window_insert(spark: SparkSession, table: str, new: DataFrame, period: str, lo: str, hi: str) -> None:
    """Delete a range of periods from a table partitioned by them, then load.

    Only partitions of the range are removed: those with new rows are replaced
    in one commit, the others are dropped afterwards. New rows outside the
    range join what is there, in the same commit, for which the rows of those
    partitions are written along. The new rows are evaluated once.
    """
    rows = materialize(new.select(*spark.table(table).columns), "new")
    inside = F.coalesce(F.col(period).between(lo, hi), F.lit(False))
    value = F.regexp_extract("partition", rf"(?:^|/){period}=([^/]*)", 1)
    held = spark.sql(f"SHOW PARTITIONS {table}").select(value.alias("p")).where(F.col("p").between(lo, hi)).distinct()
    loaded = rows.where(inside).select(F.col(period).cast("string").alias("p")).distinct()
    # Names of partitions, known to the catalog; no rows of the table.
    stale = [r["p"] for r in held.join(loaded, "p", "left_anti").collect()]
    joined = rows.where(~inside).select(F.col(period).alias("__joined")).distinct()
    there = spark.table(table).join(joined, F.col(period).eqNullSafe(F.col("__joined")), "left_semi")
    written = materialize(rows.unionByName(there), "window")
    # Only the session setting reaches a catalog table; the writer's option would be ignored.
    mode = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        written.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, mode)
    if stale:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({period} = '{p}')" for p in stale))


def rewrite_published(
    spark: SparkSession, path: str, staging: str, change: Callable[[DataFrame], DataFrame]
) -> None:
    """Replace published files with a changed copy.

    The copy is written beside them first, and takes their place only if it
    holds as many rows: the old folder is moved aside, the copy moved in, and the
    old one removed. Nothing is written twice, and what fails in between leaves
    both complete. Where a store has no move of its own, it copies.
    """
    old = spark.read.parquet(path)
    change(old).write.parquet(staging)
    copy = spark.read.parquet(staging)
    before, after = old.count(), copy.count()
    if before != after:
        raise ValueError(f"the copy holds {after} rows, the original {before}")
    files = spark._jvm.org.apache.hadoop.fs
    published, fresh, aside = (files.Path(p) for p in (path, staging, f"{staging}-replaced"))
    system = published.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.rename(published, aside):
        raise OSError(f"{path} cannot be moved aside")
    if not system.rename(fresh, published):
        system.rename(aside, published)
        raise OSError(f"{staging} cannot be moved to {path}")
    system.delete(aside, True)
    spark.catalog.refreshByPath(path)
