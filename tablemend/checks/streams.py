"""Streaming jobs run to the end of the files at hand."""

from __future__ import annotations

from tablemend.checks import fixtures as X
from tablemend.checks.loading import latest_sql, upsert_sql
from tablemend.checks.registry import query
from tablemend.session import scratch_path
from tablemend.streaming import jobs


def _land(rows, spark, label: str, files: int) -> str:
    path = scratch_path(spark, label)
    rows.repartition(files).write.parquet(path)
    return path


@query(f"{X.COPIES_SQL}, v AS ({X.DUPLICATES_SQL}) {upsert_sql('SELECT * FROM t', latest_sql('SELECT * FROM v'))}")
def stream_upsert(spark, sf_dir):
    staged = X.versioned_orders(spark, sf_dir)
    landing = jobs.landing_stream(spark, _land(staged, spark, "landed", 4), staged.schema, files_per_batch=2)
    changes = scratch_path(spark, "changes")
    jobs.stream_upsert(landing, X.KEYS, ["chg_dtm"], changes, scratch_path(spark, "upsert-state")).awaitTermination()
    return jobs.current_table(X.target_orders(spark, sf_dir), spark.read.parquet(changes), X.KEYS, ["chg_dtm"])


@query(f"{X.COPIES_SQL}, v AS ({X.DUPLICATES_SQL}) {upsert_sql('SELECT * FROM t', latest_sql('SELECT * FROM v'))}")
def stream_folded(spark, sf_dir):
    """First versions are streamed and folded into a new target, later ones are streamed and read with it."""
    staged = X.versioned_orders(spark, sf_dir)
    landed, changes, state = (scratch_path(spark, n) for n in ("landed", "changes", "fold-state"))
    target, last = X.target_orders(spark, sf_dir), None
    for later in ("o_orderstatus <> 'V'", "o_orderstatus = 'V'"):
        staged.where(later).repartition(2).write.mode("append").parquet(landed)
        landing = jobs.landing_stream(spark, landed, staged.schema, files_per_batch=1)
        jobs.stream_upsert(landing, X.KEYS, ["chg_dtm"], changes, state).awaitTermination()
        if last is None:
            folder = scratch_path(spark, "folded")
            last = jobs.compact_changes(target, spark.read.parquet(changes), X.KEYS, ["chg_dtm"], folder)
            target = spark.read.schema(target.schema).parquet(folder)
    return jobs.current_table(target, jobs.changes_after(spark.read.parquet(changes), last), X.KEYS, ["chg_dtm"])


@query(
    f"""SELECT time_bucket(INTERVAL 10 MINUTE, endtime) AS window_start,
 time_bucket(INTERVAL 10 MINUTE, endtime) + INTERVAL 10 MINUTE AS window_end, pgmid, count(*) AS error_count
 FROM ({X.RUNS_SQL}) WHERE st = 'ER' GROUP BY ALL"""
)
def stream_error_counts(spark, sf_dir):
    runs = X.job_runs(spark, sf_dir).select("pgmid", "endtime", "st")
    landing = jobs.landing_stream(spark, _land(runs, spark, "runs", 4), runs.schema, files_per_batch=2)
    counts = scratch_path(spark, "counts")
    # The files are not in order of time, so the lateness covers the whole month.
    jobs.stream_error_counts(
        landing, "endtime", "10 minutes", "40 days", counts, scratch_path(spark, "count-state")
    ).awaitTermination()
    return jobs.final_counts(spark.read.parquet(counts))


@query(
    f"""SELECT time_bucket(INTERVAL 10 MINUTE, endtime) AS window_start,
 time_bucket(INTERVAL 10 MINUTE, endtime) + INTERVAL 10 MINUTE AS window_end, pgmid, count(*) AS error_count
 FROM ({X.RUNS_SQL}) WHERE st = 'ER' GROUP BY ALL"""
)
def error_counts(spark, sf_dir):
    return jobs.error_counts(X.job_runs(spark, sf_dir), "endtime", "10 minutes")


@query(
    f"""WITH f AS (SELECT event_id, pgmid, time_bucket(INTERVAL 10 MINUTE, endtime) AS w, endtime FROM ({X.RUNS_SQL}) WHERE st = 'ER'),
 mark AS (SELECT max(endtime) - INTERVAL 1 DAY AS m FROM f WHERE event_id % 2 = 0)
 SELECT w AS window_start, w + INTERVAL 10 MINUTE AS window_end, pgmid, count(*) AS error_count FROM f, mark
 WHERE event_id % 2 = 0 OR w + INTERVAL 10 MINUTE > m GROUP BY ALL"""
)
def stream_late_rows(spark, sf_dir):
    """Half of the runs arrive after the others; of these, what is more than a day late is left out."""
    runs = X.job_runs(spark, sf_dir).select("event_id", "pgmid", "endtime", "st")
    landed, counts, state = (scratch_path(spark, n) for n in ("late-runs", "late-counts", "late-state"))
    for half in (0, 1):
        runs.where(f"event_id % 2 = {half}").repartition(1).write.mode("append").parquet(landed)
        landing = jobs.landing_stream(spark, landed, runs.schema, files_per_batch=1)
        jobs.stream_error_counts(landing, "endtime", "10 minutes", "1 day", counts, state).awaitTermination()
    return jobs.final_counts(spark.read.parquet(counts))
