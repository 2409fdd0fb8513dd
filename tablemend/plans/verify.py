"""Verify two copies of a table, log the differences, repair them and check again."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.functions.times import ntz
from tablemend.functions.windows import TimeWindow
from tablemend.operators.ledger import all_differences, difference_counts
from tablemend.operators.pairs import merged_keys
from tablemend.operators.repair import diff_log, repair_events
from tablemend.operators.upsert import apply_changes
from tablemend.sinks.files import append_batches


@dataclass(frozen=True)
class TableCheck:
    """Two copies of one table with their key and change-time columns."""

    schema_name: str
    table_name: str
    source: DataFrame
    target: DataFrame
    keys: list[str]
    ts: str
    deletes: DataFrame | None = None


def verification_summary(check: TableCheck, window: TimeWindow, batch_id: str, executed_at: str) -> DataFrame:
    """One row: totals, the three difference counts, latest source time and the batch."""
    counts = difference_counts(check.source, check.target, check.keys, check.ts, window, check.deletes)
    return counts.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(check.table_name).alias("table_nm"),
        F.lit(check.schema_name).alias("schema_name"),
        window.start.alias("verifi_date"),
        "source_total_count",
        "target_total_count",
        "chg_dtm_diff_count",
        "source_only_count",
        "target_only_count",
        ntz(executed_at).alias("execute_dtm"),
        "temp_max_chg_dtm",
    )


def verify_tables(checks: list[TableCheck], window: TimeWindow, batch_id: str, executed_at: str) -> DataFrame:
    """Summaries of several tables in one job."""
    return reduce(DataFrame.unionByName, [verification_summary(c, window, batch_id, executed_at) for c in checks])


def verification_log(check: TableCheck, window: TimeWindow, batch_id: str) -> DataFrame:
    """Differences of one table with their kind and batch, in one pass over both copies."""
    found = all_differences(check.source, check.target, check.keys, check.ts, window, check.deletes)
    return diff_log(found, batch_id, window.lo)


def write_diff_log(check: TableCheck, window: TimeWindow, batch_id: str, path: str) -> None:
    append_batches(verification_log(check, window, batch_id), path)


def repair_queue(check: TableCheck, log: DataFrame, batch_id: str) -> DataFrame:
    """Update events for the changed and the source-only keys of a batch."""
    rows = log.where(F.col("batch_id") == batch_id)
    changed, missing = (rows.where(F.col("kind") == kind) for kind in ("changed", "source_only"))
    return repair_events(check.source, merged_keys(changed, missing, check.keys), check.keys)


def repaired_target(check: TableCheck, events: DataFrame) -> DataFrame:
    """Target after applying the queued events."""
    return apply_changes(check.target, events, check.keys, [check.ts])
