"""Job-run records: alignment, comparison, mirroring and failure texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.numbers import or_zero
from tablemend.functions.predicates import is_error
from tablemend.functions.text import last_chars
from tablemend.functions.times import ntz, run_seconds
from tablemend.functions.windows import TimeWindow
from tablemend.operators.dedupe import latest_per_key
from tablemend.operators.numbering import numbered

# Fields of a run record.
COUNTERS = ("readcnt", "bycnt", "errcnt", "updcnt", "wrtcnt")
RUN_COLUMNS = ("pgmid", "starttime", "endtime", "st", "jbpmt", *COUNTERS)
# Names of the mirrored run table, in the order of its columns.
MIRROR_COLUMNS = {
    "pgmid": "prg_nm",
    "starttime": "strt_dtm",
    "endtime": "end_dtm",
    "st": "exec_rst_val",
    "jbpmt": "para_val",
    "readcnt": "exec_cnt",
    "bycnt": "skip_cnt",
    "errcnt": "err_cnt",
    "updcnt": "updt_cnt",
    "wrtcnt": "wrt_cnt",
    "msg": "msg",
}


def _since(runs: DataFrame, since: str) -> DataFrame:
    """Runs from an instant on; an empty parameter is a missing one."""
    rows = runs.select(*RUN_COLUMNS).where(F.col("starttime") >= ntz(since))
    return rows.withColumn("jbpmt", F.nullif("jbpmt", F.lit("")))


def align_runs(source: DataFrame, target: DataFrame, since: str, by: str = "position") -> DataFrame:
    """Every target run beside its source run of the same job and parameter.

    `position` pairs the first with the first, the second with the second, and
    so on. `first` pairs every target run with the earliest source run. Source
    columns get the prefix `src_`; they are null where there is no partner.
    """
    job = ["pgmid", "jbpmt"]
    order = [c for c in RUN_COLUMNS if c not in job]
    src, tgt = _since(source, since), _since(target, since)
    if by == "position":
        both = src.withColumn("side", F.lit("source")).unionByName(tgt.withColumn("side", F.lit("target")))
        placed = numbered(both, ["side", *job], order, "run_no")
        src, tgt = (placed.where(F.col("side") == side).drop("side") for side in ("source", "target"))
        matched = [*job, "run_no"]
    elif by == "first":
        src = src.groupBy(*job).agg(F.min(F.struct(*order)).alias("run")).select(*job, "run.*")
        matched = job
    else:
        raise ValueError(f"unknown alignment {by}")
    partner = src.select(*[F.col(c).alias(f"src_{c}") for c in src.columns])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"src_{c}")) for c in matched])
    return tgt.join(partner, on, "left").drop("run_no", "src_run_no")


def run_parity(source: DataFrame, target: DataFrame, day: str, since: str, by: str = "position") -> DataFrame:
    """Run time and counter differences, source minus target.

    `match_yn` asks for five zero differences, `match_yn_reference` for five
    equal ones. A target run without a partner carries a message, its own
    counters in the place of the source's, and no differences.
    """
    runs = align_runs(source, target, since, by)
    paired = F.col("src_pgmid").isNotNull()

    def gap(c: str) -> Column:
        return or_zero(F.col(f"src_{c}")) - or_zero(F.col(c))

    gaps = [gap(c) for c in COUNTERS]
    all_zero = reduce(lambda a, b: a & b, [g == 0 for g in gaps])
    all_equal = reduce(lambda a, b: a & b, [gaps[0] == g for g in gaps[1:]])
    src_seconds = run_seconds(F.col("src_starttime"), F.col("src_endtime"))
    tgt_seconds = run_seconds(F.col("starttime"), F.col("endtime"))

    def flag(condition: Column) -> Column:
        return F.when(paired, F.when(condition, "Y").otherwise("N"))

    message = F.concat(
        F.lit("the source has no run of "), "pgmid", F.lit(" with parameter "), F.coalesce("jbpmt", F.lit("(none)"))
    )
    return runs.select(
        F.lit(day).alias("smr_dt"),
        "pgmid",
        F.col("src_starttime").alias("src_start_time"),
        F.col("src_endtime").alias("src_end_time"),
        src_seconds.alias("src_exec_time"),
        "src_st",
        F.col("starttime").alias("tgt_start_time"),
        F.col("endtime").alias("tgt_end_time"),
        tgt_seconds.alias("tgt_exec_time"),
        F.col("st").alias("tgt_st"),
        (src_seconds - tgt_seconds).cast("decimal(18,2)").alias("exec_time_diff"),
        "jbpmt",
        *[F.when(paired, g).alias(f"{c}_diff") for c, g in zip(COUNTERS, gaps)],
        *[or_zero(F.when(paired, F.col(f"src_{c}")).otherwise(F.col(c))).alias(f"src_{c}") for c in COUNTERS],
        flag(all_zero).alias("match_yn"),
        flag(all_equal).alias("match_yn_reference"),
        F.when(~paired, message).alias("err_msg"),
    )


def newest_run(runs: DataFrame, started_from: str, ended_by: str) -> DataFrame:
    """Newest run of every job that started and ended between two instants."""
    held = (F.col("starttime") >= ntz(started_from)) & (F.col("endtime") <= ntz(ended_by))
    return latest_per_key(runs.where(held), ["pgmid"], ["starttime"])


def error_rows(runs: DataFrame, window: TimeWindow, closed: bool = False) -> DataFrame:
    """Failed runs that ended in the window; half-open, so neighbours never report one twice."""
    ended = F.col("endtime")
    return runs.where(is_error() & (window.holds(ended) if closed else window.holds_half_open(ended)))


def tail_run_log(runs: DataFrame, window: TimeWindow, tail: int = 100) -> DataFrame:
    """Runs that ended in the closed window in the shape of the mirrored table."""
    rows = runs.where(window.holds(F.col("endtime")))
    changed = {"msg": last_chars(F.col("msg"), tail), "wrtcnt": or_zero(F.col("wrtcnt"))}
    return rows.select(*[changed.get(c, F.col(c)).alias(name) for c, name in MIRROR_COLUMNS.items()])


def failure_messages(runs: DataFrame, window: TimeWindow, tail: int = 100) -> DataFrame:
    """Title and body of the notice for every failed run of the closed window."""

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("?"))

    body = F.format_string(
        "job %s ran from %s to %s and ended in an error: %s",
        text("pgmid"),
        text("starttime"),
        text("endtime"),
        F.coalesce(last_chars(F.col("msg"), tail), F.lit("?")),
    )
    return error_rows(runs, window, closed=True).select(
        "pgmid",
        "starttime",
        "endtime",
        F.concat(F.lit("failed job "), "pgmid").alias("msg_titl"),
        body.alias("txt_cntn"),
    )
