"""Counts, sums, catalogs and job runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.checks import fixtures as X
from tablemend.checks.registry import query
from tablemend.operators import counts as C
from tablemend.operators import dedupe as D
from tablemend.operators import runs as R
from tablemend.operators import schemas as S
from tablemend.session import materialize

_SUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINES = "SELECT * FROM lineitem"
_FEWER = "SELECT * FROM lineitem WHERE l_returnflag <> 'R'"


def _lines(spark, sf_dir):
    return X.table(spark, sf_dir, "lineitem")


def _fewer_lines(spark, sf_dir):
    return _lines(spark, sf_dir).where("l_returnflag <> 'R'")


def _sums_sql(name: str, rows: str, columns: list[str]) -> str:
    parts = [
        f"""SELECT '{name}' AS table_name, count(*) AS row_count, '{c}' AS column_name,
 CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DECIMAL(38,6)) AS total FROM ({rows})"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _count_sql(name: str, rows: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS column_name,
 CAST(NULL AS DECIMAL(38,6)) AS total FROM ({rows})"""


@query(f"SELECT 'orders' AS table_name, count(*) AS row_count FROM orders WHERE o_orderdate {X.IN_ORDERS}")
def table_count(spark, sf_dir):
    return C.table_count(X.table(spark, sf_dir, "orders"), "orders", "o_orderdate", X.ORDER_WINDOW)


@query(_sums_sql("lineitem", _LINES, _SUMS))
def count_sum(spark, sf_dir):
    return C.count_and_sums(_lines(spark, sf_dir), "lineitem", _SUMS)


@query(
    _sums_sql(
        "events",
        "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-10 23:59:59'",
        ["value"],
    )
)
def count_sum_today(spark, sf_dir):
    return C.count_and_sums_today(X.table(spark, sf_dir, "events"), "events", ["value"], "ts", "2024-01-10 07:00:00")


_PROFILE_SUMS = {"lineitem": _SUMS, "orders": ["o_totalprice"]}
_SOURCE_PROFILE = " UNION ALL ".join(
    [
        _sums_sql("lineitem", _LINES, _SUMS),
        _sums_sql("orders", X.SOURCE_SQL, ["o_totalprice"]),
        _count_sql("customer", "SELECT * FROM customer"),
        _count_sql("empty", "SELECT * FROM part WHERE p_size < 0"),
    ]
)
_TARGET_PROFILE = " UNION ALL ".join(
    [
        _sums_sql("lineitem", _FEWER, _SUMS),
        _sums_sql("orders", X.TARGET_SQL, ["o_totalprice"]),
        _count_sql("customer", "SELECT * FROM customer WHERE c_nationkey <> 3"),
        _count_sql("empty", "SELECT * FROM part WHERE p_size = 7"),
    ]
)


def _source_profile(spark, sf_dir):
    tables = {
        "lineitem": _lines(spark, sf_dir),
        "orders": X.source_orders(spark, sf_dir),
        "customer": X.table(spark, sf_dir, "customer"),
        "empty": X.table(spark, sf_dir, "part").where("p_size < 0"),
    }
    return C.table_profiles(tables, _PROFILE_SUMS)


def _target_profile(spark, sf_dir):
    tables = {
        "lineitem": _fewer_lines(spark, sf_dir),
        "orders": X.target_orders(spark, sf_dir),
        "customer": X.table(spark, sf_dir, "customer").where("c_nationkey <> 3"),
        "empty": X.table(spark, sf_dir, "part").where("p_size = 7"),
    }
    return C.table_profiles(tables, _PROFILE_SUMS)


@query(
    f"""WITH a AS (SELECT DISTINCT table_name, row_count FROM ({_SOURCE_PROFILE})),
 b AS (SELECT DISTINCT table_name, row_count FROM ({_TARGET_PROFILE}))
 SELECT table_name, a.row_count AS source_cnt, b.row_count AS target_cnt,
 a.row_count - b.row_count AS source_minus_target_cnt,
 CAST(CASE WHEN a.row_count > 0 THEN round((a.row_count - b.row_count) * 100.0 / a.row_count, 6) ELSE 0 END
 AS DECIMAL(28,6)) AS diff_range FROM a JOIN b USING (table_name)"""
)
def compare_counts(spark, sf_dir):
    return C.compare_counts(_source_profile(spark, sf_dir), _target_profile(spark, sf_dir))


@query(
    f"""WITH a AS ({_SOURCE_PROFILE}), b AS ({_TARGET_PROFILE})
 SELECT a.table_name, a.column_name, CAST(round(coalesce(a.total, 0), 3) AS DECIMAL(38,3)) AS source_sum,
 CAST(round(coalesce(b.total, 0), 3) AS DECIMAL(38,3)) AS target_sum,
 CAST(round(coalesce(a.total, 0), 3) - round(coalesce(b.total, 0), 3) AS DECIMAL(38,3)) AS source_minus_target_sum
 FROM a JOIN b ON a.table_name = b.table_name AND a.column_name = b.column_name"""
)
def compare_sums(spark, sf_dir):
    return C.compare_sums(_source_profile(spark, sf_dir), _target_profile(spark, sf_dir))


@query(
    """SELECT 'orders' AS table_name, (SELECT count(*) FROM lineitem) AS files_cnt,
 (SELECT count(*) FROM orders WHERE o_orderkey % 53 <> 0) AS source_cnt,
 (SELECT count(*) FROM orders WHERE o_orderkey % 47 <> 0) AS target_cnt,
 (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders WHERE o_orderkey % 53 <> 0) AS files_minus_source_cnt,
 (SELECT count(*) FROM orders WHERE o_orderkey % 53 <> 0) - (SELECT count(*) FROM orders WHERE o_orderkey % 47 <> 0)
 AS source_minus_target_cnt,
 (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders WHERE o_orderkey % 47 <> 0) AS files_minus_target_cnt
 UNION ALL SELECT 'customer', 0, (SELECT count(*) FROM customer), (SELECT count(*) FROM customer),
 -(SELECT count(*) FROM customer), 0, -(SELECT count(*) FROM customer)"""
)
def compare_three(spark, sf_dir):
    customer = X.table(spark, sf_dir, "customer")
    files = C.table_profiles({"orders": _lines(spark, sf_dir), "customer": customer})
    source = C.table_profiles({"orders": X.source_orders(spark, sf_dir), "customer": customer})
    target = C.table_profiles({"orders": X.target_orders(spark, sf_dir), "customer": customer})
    return C.compare_three(files, source, target, skipped=["customer"])


_DAY = "ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-10 23:59:59'"


@query(
    f"""SELECT table_name, a AS source_cnt, b AS target_cnt, a - b AS source_minus_target_cnt,
 CAST(CASE WHEN a > 0 THEN round((a - b) * 100.0 / a, 6) ELSE 0 END AS DECIMAL(28,6)) AS diff_range FROM (
 SELECT 'events' AS table_name, (SELECT count(*) FROM events WHERE {_DAY}) AS a,
 (SELECT count(*) FROM events WHERE {_DAY} AND event_type <> 'error') AS b
 UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM part WHERE p_size > 25))"""
)
def compare_layers(spark, sf_dir):
    """Mart against its copy: one table whole, one limited to the load day."""
    events, part = X.table(spark, sf_dir, "events"), X.table(spark, sf_dir, "part")
    limited = {"load_day": {"events": "ts"}, "day": "2024-01-10 07:00:00"}
    mart = C.table_profiles({"events": events, "part": part}, **limited)
    copy = C.table_profiles({"events": events.where("event_type <> 'error'"), "part": part.where("p_size > 25")}, **limited)
    return C.compare_counts(mart, copy)


# Catalogs -------------------------------------------------------------------


@query(
    f"""SELECT 'LOAD.' || table_name AS full_table_name, string_agg(column_name, ',' ORDER BY ordinal_position)
 AS key_columns FROM ({X.CATALOG_SQL}) WHERE ordinal_position <= 5 GROUP BY table_name"""
)
def collect_keys(spark, sf_dir):
    verified = F.when(F.col("ordinal_position") <= 5, "Y").otherwise("N")
    catalog = X.column_catalog(spark, sf_dir).withColumn("verification_yn", verified)
    keys = S.collect_keys(catalog.withColumnRenamed("schema_name", "owner"))
    return keys.select("full_table_name", F.array_join("key_columns", ",").alias("key_columns"))


@query(
    f"""WITH c AS ({X.CATALOG_SQL}), t AS (SELECT DISTINCT table_name, CAST(substr(table_name, 2) AS BIGINT) AS n FROM c),
 src AS (SELECT table_name, column_name, ordinal_position FROM c),
 stg AS (SELECT table_name, column_name FROM c WHERE NOT (column_name = 'C2' AND CAST(substr(table_name, 2) AS BIGINT) % 5 = 0)
  UNION ALL SELECT table_name, 'EXTRA' FROM t WHERE n % 7 = 0),
 prv AS (SELECT table_name, column_name FROM c WHERE column_name = 'C4'),
 tgt AS (SELECT table_name, column_name, CASE WHEN CAST(substr(table_name, 2) AS BIGINT) % 11 = 0 THEN 10 - ordinal_position
  ELSE ordinal_position END AS ordinal_position FROM c WHERE column_name <> 'C4'),
 want AS (SELECT table_name, string_agg(column_name, ',' ORDER BY ordinal_position) AS l FROM src
  WHERE column_name <> 'C4' GROUP BY 1),
 have AS (SELECT table_name, string_agg(column_name, ',' ORDER BY ordinal_position) AS l FROM tgt GROUP BY 1),
 so AS (SELECT table_name, string_agg(column_name, ',' ORDER BY column_name) AS l FROM src
  WHERE (table_name, column_name) NOT IN (SELECT (table_name, column_name) FROM stg) GROUP BY 1),
 go AS (SELECT table_name, string_agg(column_name, ',' ORDER BY column_name) AS l FROM stg
  WHERE (table_name, column_name) NOT IN (SELECT (table_name, column_name) FROM src) GROUP BY 1)
 SELECT 'LOAD' AS schema_name, t.table_name, (so.l IS NULL AND go.l IS NULL) AS staged_is_match,
 coalesce(want.l, '') = coalesce(have.l, '') AS target_is_match,
 (SELECT count(*) FROM src x WHERE x.table_name = t.table_name) AS source_col_cnt,
 (SELECT count(*) FROM stg x WHERE x.table_name = t.table_name) AS staged_col_cnt,
 (SELECT count(*) FROM tgt x WHERE x.table_name = t.table_name) AS target_col_cnt,
 (SELECT count(*) FROM prv x WHERE x.table_name = t.table_name) AS private_col_cnt,
 coalesce(so.l, '') AS source_only, coalesce(go.l, '') AS staged_only
 FROM t LEFT JOIN want USING (table_name) LEFT JOIN have USING (table_name)
 LEFT JOIN so USING (table_name) LEFT JOIN go USING (table_name)"""
)
def schema_parity(spark, sf_dir):
    source = materialize(X.column_catalog(spark, sf_dir), "catalog")
    n = F.substring("table_name", 2, 18).cast("long")
    name, position = F.col("column_name"), F.col("ordinal_position")
    tables = source.select("schema_name", "table_name").distinct()

    def extra(column: str, every: int):
        return tables.where(n % every == 0).select("*", F.lit(column).alias("column_name"), F.lit(9).cast("long").alias("ordinal_position"))

    staged = source.where(~((name == "C2") & (n % 5 == 0))).unionByName(extra("EXTRA", 7)).unionByName(extra("GBN", 1))
    turned = F.when(n % 11 == 0, 10 - position).otherwise(position)
    target = source.where(name != "C4").withColumn("ordinal_position", turned)
    return S.schema_parity(source, staged, target, source.where(name == "C4"))


@query(
    """SELECT o.o_orderstatus AS schema_name, 'T' || o.o_orderkey AS table_name, l.column_name FROM orders o
 LEFT JOIN (SELECT DISTINCT 'T' || l_orderkey AS table_name, 'C' || l_linenumber AS column_name FROM lineitem
 WHERE l_linenumber % 2 = 1) l ON l.table_name = 'T' || o.o_orderkey WHERE o.o_orderpriority <> '5-LOW'"""
)
def check_catalog(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("schema_name"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("table_name"),
        F.when(F.col("o_orderpriority") == "5-LOW", "N").otherwise("Y").alias("verification_yn"),
        F.lit("N").alias("etl_dtm_exist_yn"),
    )
    sums = (
        X.column_catalog(spark, sf_dir)
        .drop("schema_name")
        .join(orders.select("schema_name", "table_name"), "table_name")
        .withColumn("sum_check_yn", F.when(F.col("ordinal_position") % 2 == 1, "Y").otherwise("N"))
        .withColumn("etl_dtm_exist_yn", F.lit("N"))
    )
    return C.check_catalog(orders, sums, "N")


# Job runs -------------------------------------------------------------------

_SINCE = "2024-01-03 00:10:00"
_COUNTERS = R.COUNTERS
_RUN_ORDER = "starttime, endtime, st, readcnt, bycnt, errcnt, updcnt, wrtcnt"


def _parity_sql(pairs: str) -> str:
    """Differences of `a` (source) and `b` (target) joined as in `pairs`."""
    gap = {c: f"(coalesce(a.{c}, 0) - coalesce(b.{c}, 0))" for c in _COUNTERS}
    zero = " AND ".join(f"{g} = 0" for g in gap.values())
    same = " AND ".join(f"{gap['readcnt']} = {g}" for g in gap.values())
    seconds = "CAST((epoch_us({0}.endtime) - epoch_us({0}.starttime) + 5000) // 10000 / 100 AS DECIMAL(18,2))"
    return f"""SELECT '2024-01-03' AS smr_dt, b.pgmid, a.starttime AS src_start_time, a.endtime AS src_end_time,
 {seconds.format('a')} AS src_exec_time, a.st AS src_st, b.starttime AS tgt_start_time, b.endtime AS tgt_end_time,
 {seconds.format('b')} AS tgt_exec_time, b.st AS tgt_st,
 CAST({seconds.format('a')} - {seconds.format('b')} AS DECIMAL(18,2)) AS exec_time_diff, b.jbpmt,
 {', '.join(f'CASE WHEN a.pgmid IS NOT NULL THEN {g} END AS {c}_diff' for c, g in gap.items())},
 {', '.join(f'coalesce(CASE WHEN a.pgmid IS NOT NULL THEN a.{c} ELSE b.{c} END, 0) AS src_{c}' for c in _COUNTERS)},
 CASE WHEN a.pgmid IS NOT NULL THEN CASE WHEN {zero} THEN 'Y' ELSE 'N' END END AS match_yn,
 CASE WHEN a.pgmid IS NOT NULL THEN CASE WHEN {same} THEN 'Y' ELSE 'N' END END AS match_yn_reference,
 CASE WHEN a.pgmid IS NULL THEN concat('the source has no run of ', b.pgmid, ' with parameter ',
 coalesce(b.jbpmt, '(none)')) END AS err_msg FROM {pairs}"""


def _numbered_sql(rows: str) -> str:
    return f"""(SELECT *, row_number() OVER (PARTITION BY pgmid, jbpmt ORDER BY {_RUN_ORDER}) AS run_no
 FROM {rows} WHERE starttime >= TIMESTAMP '{_SINCE}')"""


@query(
    f"""{X.RUN_COPIES_SQL} SELECT b.pgmid, b.jbpmt, b.starttime, b.readcnt, a.starttime AS src_starttime,
 a.readcnt AS src_readcnt FROM {_numbered_sql('t')} b LEFT JOIN {_numbered_sql('s')} a ON a.pgmid = b.pgmid
 AND a.jbpmt IS NOT DISTINCT FROM b.jbpmt AND a.run_no = b.run_no"""
)
def align_runs(spark, sf_dir):
    pairs = R.align_runs(X.source_runs(spark, sf_dir), X.target_runs(spark, sf_dir), _SINCE)
    return pairs.select("pgmid", "jbpmt", "starttime", "readcnt", "src_starttime", "src_readcnt")


@query(
    f"""{X.RUN_COPIES_SQL} {_parity_sql(f'''{_numbered_sql('t')} b LEFT JOIN {_numbered_sql('s')} a ON a.pgmid = b.pgmid
 AND a.jbpmt IS NOT DISTINCT FROM b.jbpmt AND a.run_no = b.run_no''')}"""
)
def run_parity(spark, sf_dir):
    return R.run_parity(X.source_runs(spark, sf_dir), X.target_runs(spark, sf_dir), "2024-01-03", _SINCE)


@query(
    f"""{X.RUN_COPIES_SQL} {_parity_sql(f'''(SELECT * FROM t WHERE starttime >= TIMESTAMP '{_SINCE}') b LEFT JOIN
 (SELECT * FROM {_numbered_sql('s')} WHERE run_no = 1) a ON a.pgmid = b.pgmid
 AND a.jbpmt IS NOT DISTINCT FROM b.jbpmt''')}"""
)
def run_parity_first(spark, sf_dir):
    return R.run_parity(X.source_runs(spark, sf_dir), X.target_runs(spark, sf_dir), "2024-01-03", _SINCE, by="first")


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pgmid, jbpmt
 ORDER BY starttime DESC, event_id DESC) AS rn FROM ({X.RUNS_SQL})) WHERE rn = 1"""
)
def latest_run(spark, sf_dir):
    return D.latest_run(X.job_runs(spark, sf_dir), ["pgmid", "jbpmt"], "starttime")


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pgmid
 ORDER BY starttime DESC, event_id DESC) AS rn FROM ({X.RUNS_SQL})
 WHERE starttime >= TIMESTAMP '2024-01-05' AND endtime <= TIMESTAMP '2024-01-20') WHERE rn = 1"""
)
def newest_run(spark, sf_dir):
    return R.newest_run(X.job_runs(spark, sf_dir), "2024-01-05 00:00:00", "2024-01-20 00:00:00")


_RUN_DAY = "endtime >= TIMESTAMP '2024-01-10 00:00:00' AND endtime {} TIMESTAMP '2024-01-11 00:00:00'"


@query(f"SELECT event_id, pgmid, endtime FROM ({X.RUNS_SQL}) WHERE st = 'ER' AND {_RUN_DAY.format('<')}")
def error_rows(spark, sf_dir):
    return R.error_rows(X.job_runs(spark, sf_dir), X.RUN_WINDOW).select("event_id", "pgmid", "endtime")


@query(
    f"""SELECT pgmid AS prg_nm, starttime AS strt_dtm, endtime AS end_dtm, st AS exec_rst_val, jbpmt AS para_val,
 readcnt AS exec_cnt, bycnt AS skip_cnt, errcnt AS err_cnt, updcnt AS updt_cnt, coalesce(wrtcnt, 0) AS wrt_cnt,
 right(msg, 100) AS msg FROM ({X.RUNS_SQL}) WHERE {_RUN_DAY.format('<=')}"""
)
def run_log_tail(spark, sf_dir):
    return R.tail_run_log(X.job_runs(spark, sf_dir), X.RUN_WINDOW)


@query(
    f"""SELECT pgmid, starttime, endtime, concat('failed job ', pgmid) AS msg_titl, concat('job ', pgmid, ' ran from ',
 CAST(starttime AS VARCHAR), ' to ', CAST(endtime AS VARCHAR), ' and ended in an error: ', coalesce(right(msg, 100), '?'))
 AS txt_cntn FROM ({X.RUNS_SQL}) WHERE st = 'ER' AND {_RUN_DAY.format('<=')}"""
)
def failure_messages(spark, sf_dir):
    return R.failure_messages(X.job_runs(spark, sf_dir), X.RUN_WINDOW)
