"""Verify and repair many tables by a catalog of their keys.

The catalog says which tables to look at and what their keys are; how a table is opened is up to the caller. The tables
of a schema are handled one after another, schemas side by side if asked for, each in a scheduler pool of its own. A table
that fails or takes too long is reported as a row instead of ending the run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from threading import Thread

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.functions.windows import TimeWindow
from tablemend.operators.ledger import SOURCE_TIME, TARGET_TIME, all_differences
from tablemend.operators.repair import diff_log, repair_events
from tablemend.operators.schemas import collect_keys
from tablemend.operators.upsert import apply_changes
from tablemend.plans.verify import TableCheck
from tablemend.session import exists, remove

# Opens a table of the catalog, given its full name and its key columns.
Opener = Callable[[str, list[str]], TableCheck]
_STATUS = "table_nm string, status string, message string"
# Times a table that takes too long is told to stop, a second apart.
_CANCELS = 10
_LOGGED = ["kind", "key_text", SOURCE_TIME, TARGET_TIME]


def listed_tables(catalog: DataFrame) -> list[tuple[str, list[str]]]:
    """Full names and keys of the verified tables, a row of the catalog for each key column."""
    rows = collect_keys(catalog).orderBy("full_table_name").collect()
    return [(r["full_table_name"], list(r["key_columns"])) for r in rows]


def _key_text(check: TableCheck) -> Column:
    """The key as JSON, since the tables of one log have different keys."""
    return F.to_json(F.struct(*check.keys), {"ignoreNullFields": "false"})


Work = Callable[[TableCheck, str], str]


def _outcome(name: str, work: Callable[[], str]) -> tuple[str, str, str]:
    # Whatever an opener or a job raises is this table's failure and no other's.
    try:
        return name, "done", work()
    except Exception as wrong:
        return name, "failed", (str(wrong) or type(wrong).__name__).splitlines()[0]


def _limited(spark: SparkSession, pool: str, name: str, work: Callable[[], str], seconds: float | None) -> tuple[str, str, str]:
    """The outcome of work done as a job group of its own, which is cancelled after some seconds."""
    group, found = f"{name}-{uuid.uuid4().hex}", []

    def run() -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        spark.sparkContext.setJobGroup(group, f"table {name}", interruptOnCancel=True)
        found.append(_outcome(name, work))

    thread = Thread(target=run, name=group, daemon=True)
    thread.start()
    thread.join(seconds)
    if not thread.is_alive():
        return found[0]
    # Between two jobs of the group there is nothing to cancel, so it is asked for until the work has ended.
    for _ in range(_CANCELS):
        spark.sparkContext.cancelJobGroup(group)
        thread.join(1)
        if not thread.is_alive():
            break
    return name, "timed out", f"cancelled after {seconds:g} seconds"


def _each(
    spark: SparkSession, catalog: DataFrame, open_table: Opener, work: Work, side_by_side: int = 1, seconds: float | None = None
) -> DataFrame:
    """Do the work for every table; its note, or the first line of what went wrong."""
    by_schema: dict[str, list[tuple[str, list[str]]]] = {}
    for name, keys in listed_tables(catalog):
        by_schema.setdefault(name.rpartition(".")[0], []).append((name, keys))

    def handled(schema: str) -> list[tuple[str, str, str]]:
        return [
            _limited(spark, schema, name, lambda name=name, keys=keys: work(open_table(name, keys), name), seconds)
            for name, keys in by_schema[schema]
        ]

    with ThreadPoolExecutor(max(1, side_by_side)) as workers:
        done = [row for rows in workers.map(handled, by_schema) for row in rows]
    return spark.createDataFrame(done, _STATUS)


def check_all(
    spark: SparkSession,
    catalog: DataFrame,
    open_table: Opener,
    window: TimeWindow,
    batch_id: str,
    path: str,
    side_by_side: int = 1,
    seconds: float | None = None,
) -> DataFrame:
    """Write the differences of all tables to a log, a folder for each table; one status row a table.

    A repeated run of a batch begins with an empty log, so tables that fail or have left the catalog since have none.
    `side_by_side` schemas are checked at once, for which the session should schedule fairly; a table that takes longer
    than `seconds` is cancelled and reported.
    """
    remove(spark, f"{path}/batch={batch_id}")

    def work(check: TableCheck, name: str) -> str:
        found = all_differences(check.source, check.target, check.keys, check.ts, window, check.deletes)
        rows = found.withColumn("key_text", _key_text(check)).select(*_LOGGED).withColumn("table_nm", F.lit(name))
        folder = f"{path}/batch={batch_id}/{name}"
        diff_log(rows, batch_id, window.lo).write.mode("overwrite").parquet(folder)
        return f"{spark.read.parquet(folder).count()} differences"

    return _each(spark, catalog, open_table, work, side_by_side, seconds)


def read_log(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """Logged differences of a batch over all tables."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/batch={batch_id}")


def repair_all(
    spark: SparkSession, log_path: str, catalog: DataFrame, open_table: Opener, batch_id: str, path: str
) -> DataFrame:
    """Write the repaired content of every table with changed or source-only keys; one status row a table.

    The events come from the table's own folder of the written log, not from a second comparison.
    """

    def work(check: TableCheck, name: str) -> str:
        folder = f"{log_path}/batch={batch_id}/{name}"
        if not exists(spark, folder):
            return "not in the log"
        wanted = spark.read.parquet(folder).where(F.col("kind").isin("changed", "source_only"))
        if wanted.isEmpty():
            return "nothing to repair"
        schema = check.source.select(*check.keys).schema
        keys = wanted.select(F.from_json("key_text", schema).alias("k")).select("k.*").distinct()
        events = repair_events(check.source, keys, check.keys)
        apply_changes(check.target, events, check.keys, [check.ts]).write.mode("overwrite").parquet(f"{path}/{name}")
        return "repaired"

    return _each(spark, catalog, open_table, work)


def repaired(spark: SparkSession, check: TableCheck, name: str, path: str) -> TableCheck:
    """The check with the target that a repair wrote."""
    return replace(check, target=spark.read.schema(check.target.schema).parquet(f"{path}/{name}"))
