"""Projections, conversions and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.checks import fixtures as X
from tablemend.checks.registry import query
from tablemend.functions import numbers as N
from tablemend.functions import text as S
from tablemend.functions import times as T
from tablemend.operators import convert as C

_AT = "2024-02-01 03:04:05"


@query("SELECT o_orderkey, o_totalprice FROM orders")
def project(spark, sf_dir):
    return C.project(X.table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"])


@query(f'SELECT op AS "Op", o_orderkey, chg_dtm AS transact_id FROM ({X.QUEUE_SQL})')
def rename(spark, sf_dir):
    rows = X.queued_events(spark, sf_dir).select("op", "o_orderkey", "chg_dtm")
    return C.rename(rows, {"op": "Op", "chg_dtm": "transact_id"})


@query('SELECT o_orderkey AS "O_ORDERKEY", o_orderstatus AS "O_ORDERSTATUS" FROM orders')
def upper_names(spark, sf_dir):
    return C.upper_names(X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"))


_ISO = """CASE WHEN microsecond({0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%d{1}%H:%M:%S')
 ELSE strftime({0}, '%Y-%m-%d{1}%H:%M:%S.%f') END"""


@query(
    f"""SELECT event_id, {_ISO.format('starttime', 'T')} AS starttime, {_ISO.format('endtime', 'T')} AS endtime,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE note END AS note FROM (SELECT event_id,
 CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE ts END AS starttime,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS endtime, event_type AS note FROM events)"""
)
def ts_to_string(spark, sf_dir):
    n, ts = F.col("event_id"), F.col("ts")
    blank = F.when(n % 6 == 0, "  ").otherwise("NaT")
    rows = X.table(spark, sf_dir, "events").select(
        n,
        F.when(n % 2 == 0, T.whole_second(ts)).otherwise(ts).alias("starttime"),
        F.when(n % 5 == 0, None).otherwise(ts).alias("endtime"),
        F.when(n % 3 == 0, blank).otherwise(F.col("event_type")).alias("note"),
    )
    return C.timestamps_to_string(C.timestamps_to_string(rows), ["note"])


@query(f"SELECT event_id, {_ISO.format('ts', ' ')} AS ts FROM events")
def ts_to_plain_string(spark, sf_dir):
    return C.timestamps_to_string(X.table(spark, sf_dir, "events").select("event_id", "ts"), plain=True)


_WITH_NAN = """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN CAST('nan' AS DOUBLE) ELSE c_acctbal END AS c_acctbal
 FROM customer"""


def _with_nan(spark, sf_dir):
    nan = F.lit(float("nan"))
    balance = F.when(F.col("c_custkey") % 9 == 0, nan).otherwise(F.col("c_acctbal")).alias("c_acctbal")
    return X.table(spark, sf_dir, "customer").select("c_custkey", balance)


@query(
    f"""SELECT c_custkey, CAST(CASE WHEN isnan(c_acctbal) THEN NULL ELSE c_acctbal END AS DECIMAL(38,6)) AS c_acctbal
 FROM ({_WITH_NAN})"""
)
def num_to_decimal(spark, sf_dir):
    return C.numbers_to_decimal(_with_nan(spark, sf_dir))


@query(f"SELECT c_custkey, CASE WHEN isnan(c_acctbal) THEN NULL ELSE c_acctbal END AS c_acctbal FROM ({_WITH_NAN})")
def nan_to_null(spark, sf_dir):
    return C.nan_to_null(_with_nan(spark, sf_dir))


@query("SELECT c_custkey, 'XXXX' AS c_name, c_nationkey, 'XXXX' AS c_mktsegment FROM customer")
def mask(spark, sf_dir):
    rows = X.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return C.mask_columns(rows, ["c_name", "c_mktsegment", "c_phone"])


_CODE = """CASE cust_grd_gbcd WHEN 'F' THEN '1001' WHEN 'FC' THEN '1001' WHEN 'A' THEN '2001' WHEN 'M' THEN '3001'
 WHEN 'I' THEN '4001' WHEN 'L' THEN '5001' WHEN 'Y' THEN '6001' WHEN 'T' THEN '7001' END"""


@query(f"SELECT cust_no, {_CODE} AS itnt_grd_gbcd FROM ({X.GRADES_SQL})")
def decode_grade(spark, sf_dir):
    code = C.decode_map(F.col("cust_grd_gbcd"), C.GRADE_CODES)
    return X.customer_grades(spark, sf_dir).select("cust_no", code.alias("itnt_grd_gbcd"))


@query(
    f"""SELECT '202402' AS bsic_ym, cust_no, {_CODE} AS itnt_grd_gbcd, item_eval_cnt AS blog_cnt, rord_cnt AS ord_cnt,
 rord_amt AS ord_amt, m11_item_eval_cnt AS rcnt_11_mths_eval_cnt, m11_rord_cnt AS rcnt_11_mths_ord_cnt,
 m11_rord_amt AS rcnt_11_mths_ord_amt, grd_retn_mths, 'loader' AS rgst_id, 'SYSTEM' AS rgst_ip,
 TIMESTAMP '{_AT}' AS reg_dtm, 'loader' AS chgp_id, 'SYSTEM' AS chgp_ip, TIMESTAMP '{_AT}' AS chg_dtm
 FROM ({X.GRADES_SQL})"""
)
def reshape_grade(spark, sf_dir):
    return C.reshape_grades(X.customer_grades(spark, sf_dir), "202402", "loader", "SYSTEM", _AT)


@query(
    f"""SELECT o_custkey AS cust_no, o_orderstatus AS cust_stat_gbcd, CAST(NULL AS VARCHAR) AS notc_cmpt_dt,
 'SYSTEM' AS rgst_id, o_orderdate AS reg_dtm FROM orders"""
)
def reshape(spark, sf_dir):
    return C.reshape(
        X.table(spark, sf_dir, "orders"),
        {
            "cust_no": "o_custkey",
            "cust_stat_gbcd": "o_orderstatus",
            "notc_cmpt_dt": F.lit(None).cast("string"),
            "rgst_id": F.lit("SYSTEM"),
            "reg_dtm": "o_orderdate",
        },
    )


@query(f"SELECT o_orderkey, TIMESTAMP '{_AT}' AS etl_dtm FROM orders")
def stamp_load_time(spark, sf_dir):
    return C.stamp_load_time(X.table(spark, sf_dir, "orders").select("o_orderkey"), _AT)


@query("SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders")
def drop_trailing(spark, sf_dir):
    return C.drop_trailing(X.table(spark, sf_dir, "orders"), 3, ["k", "c", "s"])


@query("SELECT o_orderkey, o_custkey FROM orders")
def drop_helper(spark, sf_dir):
    rows = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.lit(1).alias("rnum"))
    return C.drop_helper(rows, "rnum", "rn")


@query("SELECT user_id, event_id, concat(user_id, ',', event_id) AS keys FROM events")
def concat_keys(spark, sf_dir):
    return C.concat_keys(X.table(spark, sf_dir, "events").select(*X.PAIR_KEYS), X.PAIR_KEYS)


def _parsed_sql(site: str) -> str:
    return f"""SELECT substr(ucid, 2, 20) AS ucid, '{site}' AS acd, '240131' AS proc_date,
 substr(ltrim(proc_time), 1, 12) AS proc_time, tred, substr(call_id, 2, 5) AS call_id, mesg,
 CASE WHEN starts_with(q_wait_time, 'Q') THEN substr(q_wait_time, 2) ELSE q_wait_time END AS q_wait_time,
 substr(ston, 2, 4) AS ston, upper(substr(vdn_dial_no, 1, 1)) AS vdn_dial_dvcd, substr(vdn_dial_no, 2) AS vdn_dial_no,
 substr(in_call_no, 2) AS in_call_no, '{_AT}' AS etl_dtm FROM ({X.CALL_LOG_SQL})"""


@query(_parsed_sql("1"))
def parse_call_log(spark, sf_dir):
    return C.parse_call_log(X.call_log(spark, sf_dir), "1", "240131", _AT)


@query(f"{_parsed_sql('1')} UNION ALL {_parsed_sql('2')}")
def site_logs(spark, sf_dir):
    log = X.call_log(spark, sf_dir)
    return C.site_logs({"1": log, "2": log}, "240131", _AT)


@query(
    """SELECT doc_id, substr(text, 2, 20) AS part, upper(substr(text, 1, 1)) AS initial, ltrim(text, ' ') AS trimmed,
 CASE WHEN starts_with(text, 'T') THEN substr(text, 2) ELSE text END AS stripped, right(text, 100) AS tail,
 lang || source AS joined FROM documents"""
)
def text_functions(spark, sf_dir):
    text = F.col("text")
    return X.table(spark, sf_dir, "documents").select(
        "doc_id",
        S.cut(text, 1, 21).alias("part"),
        S.first_upper(text).alias("initial"),
        S.left_trim(text).alias("trimmed"),
        S.strip_leading(text, "T").alias("stripped"),
        S.last_chars(text, 100).alias("tail"),
        S.join_text(F.col("lang"), F.col("source")).alias("joined"),
    )


@query(
    """SELECT event_id, strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS parsed,
 date_trunc('second', ts) AS whole, strftime(ts + INTERVAL 3 DAY, '%Y%m%d') AS later_day,
 strftime(ts, '%Y%m') AS ym, strftime(ts, '%d') AS dd, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_lo,
 CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '23:59:59' AS day_hi,
 CAST((epoch_us(ts) - epoch_us(TIMESTAMP '2023-12-31 23:59:59.5') + 5000) // 10000 / 100 AS DECIMAL(18,2)) AS run_seconds,
 date_diff('second', TIMESTAMP '2023-12-31 23:59:59.5', ts) AS crossed FROM events"""
)
def time_functions(spark, sf_dir):
    ts, day = F.col("ts"), F.date_format("ts", "yyyyMMdd")
    begin = T.ntz("2023-12-31 23:59:59.5")
    return X.table(spark, sf_dir, "events").select(
        "event_id",
        T.parse_compact(T.compact_text(ts)).alias("parsed"),
        T.whole_second(ts).alias("whole"),
        T.shift_date_text(day, 3).alias("later_day"),
        T.year_month(day).alias("ym"),
        T.day_of_text(day).alias("dd"),
        T.day_start(ts).alias("day_lo"),
        T.day_last_second(ts).alias("day_hi"),
        T.run_seconds(begin, ts).alias("run_seconds"),
        T.seconds_between(begin, ts).alias("crossed"),
    )


@query(
    f"""SELECT event_id, coalesce(wrtcnt, 0) AS wrtcnt, CAST(round(CAST(readcnt AS DECIMAL(20,6)) / 7, 3) AS DECIMAL(38,3))
 AS rounded, CAST(CASE WHEN updcnt > 0 THEN round(readcnt * 100.0 / updcnt, 6) ELSE 0 END AS DECIMAL(28,6)) AS share
 FROM ({X.RUNS_SQL})"""
)
def number_functions(spark, sf_dir):
    return X.job_runs(spark, sf_dir).select(
        "event_id",
        N.or_zero(F.col("wrtcnt")).alias("wrtcnt"),
        N.round_sum(F.col("readcnt").cast("decimal(20,6)") / 7).alias("rounded"),
        N.percent(F.col("readcnt"), F.col("updcnt")).alias("share"),
    )
