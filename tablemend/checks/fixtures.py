"""Inputs derived from the supplied tables, in Spark and in SQL.

Two copies of a table are made from one table by leaving out and altering some
rows, so that there are differences to find; every derivation covers the whole
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemend.functions.windows import TimeWindow

KEYS = ["o_orderkey"]
PAIR_KEYS = ["user_id", "event_id"]
ORDER_WINDOW = TimeWindow("1997-01-01 00:00:00", "1999-01-01 00:00:00")
EVENT_WINDOW = TimeWindow("2024-01-05 00:00:00", "2024-01-20 00:00:00")
RUN_WINDOW = TimeWindow("2024-01-10 00:00:00", "2024-01-11 00:00:00")
PENDING_SINCE = "1998-01-01 00:00:00"
BATCH = "daily_19990101000000"
EXECUTED_AT = "1999-01-02 07:00:00"

IN_ORDERS = "BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1999-01-01 00:00:00'"
IN_EVENTS = "BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; its footers are read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _seconds(n: int):
    return F.expr(f"INTERVAL '{n}' SECOND")


# Orders as two copies -------------------------------------------------------

SOURCE_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate AS chg_dtm
 FROM orders WHERE o_orderkey % 53 <> 0"""
TARGET_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
 CASE WHEN o_orderkey % 29 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority,
 CASE WHEN o_orderkey % 31 = 0 THEN o_orderdate + INTERVAL 1 SECOND ELSE o_orderdate END AS chg_dtm
 FROM orders WHERE o_orderkey % 47 <> 0"""
DELETES_SQL = "SELECT o_orderkey, 'D' AS op FROM orders WHERE o_orderkey % 93 = 0"
QUEUE_SQL = """SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'Q' AS o_orderstatus, o_totalprice, o_orderpriority,
 CASE o_orderkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'D' ELSE 'U' END AS op,
 o_orderdate + (o_orderkey % 5) * INTERVAL 1000 DAY AS chg_dtm FROM orders"""
COPIES_SQL = f"WITH s AS ({SOURCE_SQL}), t AS ({TARGET_SQL}), d AS ({DELETES_SQL}), q AS ({QUEUE_SQL})"


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 53 <> 0")
    return rows.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.col("o_orderdate").alias("chg_dtm")
    )


def target_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 47 <> 0")
        .select(
            key,
            "o_custkey",
            "o_orderstatus",
            F.when(key % 29 == 0, price + 1).otherwise(price).alias("o_totalprice"),
            "o_orderpriority",
            F.when(key % 31 == 0, day + _seconds(1)).otherwise(day).alias("chg_dtm"),
        )
    )


def delete_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 93 = 0").select("o_orderkey", F.lit("D").alias("op"))


def queued_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    later = F.make_dt_interval(days=((key % 5) * 1000).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key,
        (F.col("o_custkey") + 1).alias("o_custkey"),
        F.lit("Q").alias("o_orderstatus"),
        "o_totalprice",
        "o_orderpriority",
        F.when(key % 3 == 0, "I").when(key % 3 == 1, "D").otherwise("U").alias("op"),
        (F.col("o_orderdate") + later).alias("chg_dtm"),
    )


# Orders with several versions per key --------------------------------------

DUPLICATES_SQL = f"""SELECT * FROM ({SOURCE_SQL}) UNION ALL
 SELECT o_orderkey, o_custkey, 'V', o_totalprice, o_orderpriority, chg_dtm + INTERVAL 1 DAY
 FROM ({SOURCE_SQL}) WHERE o_orderkey % 7 = 0"""


def versioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = source_orders(spark, sf_dir)
    second = first.where("o_orderkey % 7 = 0").withColumns(
        {"o_orderstatus": F.lit("V"), "chg_dtm": F.col("chg_dtm") + _seconds(86400)}
    )
    return first.unionByName(second)


# Orders with creation and change times -------------------------------------

INCREMENTAL_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate AS reg_dtm,
 o_orderdate + (o_orderkey % 3) * INTERVAL 1 DAY AS chg_dtm FROM orders"""


def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.make_dt_interval(days=(F.col("o_orderkey") % 3).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.col("o_orderdate").alias("reg_dtm"),
        (F.col("o_orderdate") + later).alias("chg_dtm"),
    )


# Events as two copies with a two-column key and sub-second times ------------

EVENT_COPIES_SQL = """WITH s AS (SELECT user_id, event_id, ts AS chg_dtm FROM events WHERE event_id % 53 <> 0),
 t AS (SELECT user_id, event_id,
 CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 700 MILLISECOND ELSE ts END AS chg_dtm
 FROM events WHERE event_id % 47 <> 0)"""


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_id % 53 <> 0")
    return rows.select("user_id", "event_id", F.col("ts").alias("chg_dtm"))


def target_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.col("ts") + F.expr("INTERVAL '0.7' SECOND")
    return (
        table(spark, sf_dir, "events")
        .where("event_id % 47 <> 0")
        .select("user_id", "event_id", F.when(F.col("event_id") % 5 == 0, later).otherwise(F.col("ts")).alias("chg_dtm"))
    )


# Job runs -------------------------------------------------------------------

RUNS_SQL = """SELECT event_id, event_type AS pgmid, ts AS starttime,
 ts + (event_id % 120) * INTERVAL 1 SECOND AS endtime,
 CASE WHEN event_type = 'error' THEN 'ER' ELSE 'OK' END AS st,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS jbpmt,
 event_id % 1000 AS readcnt, event_id % 10 AS bycnt, event_id % 3 AS errcnt, event_id % 100 AS updcnt,
 CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id % 200 END AS wrtcnt,
 CASE WHEN event_type = 'error' THEN concat(props, ' ', repeat('x', CAST(event_id % 120 AS INTEGER))) END AS msg
 FROM events"""
_RUN_FIELDS = "pgmid, starttime, endtime, st, jbpmt"
RUN_COPIES_SQL = f"""WITH r AS ({RUNS_SQL}), s AS (SELECT * FROM r WHERE event_id % 41 <> 0),
 t AS (SELECT event_id, {_RUN_FIELDS},
 CASE WHEN event_id % 17 = 0 OR event_id % 23 = 0 THEN readcnt + 1 ELSE readcnt END AS readcnt,
 CASE WHEN event_id % 23 = 0 THEN bycnt + 1 ELSE bycnt END AS bycnt,
 CASE WHEN event_id % 23 = 0 THEN errcnt + 1 ELSE errcnt END AS errcnt,
 CASE WHEN event_id % 23 = 0 THEN updcnt + 1 ELSE updcnt END AS updcnt,
 CASE WHEN event_id % 23 = 0 THEN wrtcnt + 1 ELSE wrtcnt END AS wrtcnt FROM r)"""


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, failed = F.col("event_id"), F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        n,
        F.col("event_type").alias("pgmid"),
        F.col("ts").alias("starttime"),
        (F.col("ts") + F.make_dt_interval(secs=(n % 120).cast("decimal(18,6)"))).alias("endtime"),
        F.when(failed, "ER").otherwise("OK").alias("st"),
        F.when(n % 4 == 0, None).otherwise(F.col("user_id").cast("string")).alias("jbpmt"),
        (n % 1000).alias("readcnt"),
        (n % 10).alias("bycnt"),
        (n % 3).alias("errcnt"),
        (n % 100).alias("updcnt"),
        F.when(n % 50 == 0, None).otherwise(n % 200).alias("wrtcnt"),
        F.when(failed, F.concat("props", F.lit(" "), F.repeat(F.lit("x"), (n % 120).cast("int")))).alias("msg"),
    )


def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_runs(spark, sf_dir).where("event_id % 41 <> 0")


def target_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    every = n % 23 == 0
    runs = job_runs(spark, sf_dir)
    raised = {c: F.when(every, F.col(c) + 1).otherwise(F.col(c)) for c in ("bycnt", "errcnt", "updcnt", "wrtcnt")}
    raised["readcnt"] = F.when(every | (n % 17 == 0), F.col("readcnt") + 1).otherwise(F.col("readcnt"))
    return runs.withColumns(raised)


# Column catalogs: one table per order, one column per line number -----------

_COLUMN = "SELECT DISTINCT 'LOAD' AS schema_name, 'T' || l_orderkey AS table_name, 'C' || l_linenumber AS column_name"
CATALOG_SQL = f"""{_COLUMN}, CAST(l_linenumber AS BIGINT) AS ordinal_position FROM lineitem"""


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return lines.select(
        F.lit("LOAD").alias("schema_name"),
        F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("table_name"),
        F.concat(F.lit("C"), F.col("l_linenumber").cast("string")).alias("column_name"),
        F.col("l_linenumber").cast("long").alias("ordinal_position"),
    )


# Call log and customer grades, from customers -------------------------------

CALL_LOG_SQL = """SELECT concat('  ', lpad(CAST(c_custkey % 86400 AS VARCHAR), 6, '0'), '.123456789') AS proc_time,
 c_mktsegment AS tred, concat('#', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS call_id, c_name AS mesg,
 CASE WHEN c_custkey % 2 = 0 THEN concat('Q', CAST(c_custkey % 600 AS VARCHAR))
  ELSE CAST(c_custkey % 600 AS VARCHAR) END AS q_wait_time,
 concat('s', lpad(CAST(c_nationkey AS VARCHAR), 6, '0')) AS ston,
 concat(CASE WHEN c_custkey % 3 = 0 THEN 'v' ELSE 'w' END, CAST(c_custkey AS VARCHAR)) AS vdn_dial_no,
 concat('u', lpad(CAST(c_custkey AS VARCHAR), 25, '7')) AS ucid,
 concat('t', lpad(CAST(c_custkey AS VARCHAR), 10, '0')) AS in_call_no FROM customer"""


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    wait = (key % 600).cast("string")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("  "), F.lpad((key % 86400).cast("string"), 6, "0"), F.lit(".123456789")).alias("proc_time"),
        F.col("c_mktsegment").alias("tred"),
        F.concat(F.lit("#"), F.lpad(text, 8, "0")).alias("call_id"),
        F.col("c_name").alias("mesg"),
        F.when(key % 2 == 0, F.concat(F.lit("Q"), wait)).otherwise(wait).alias("q_wait_time"),
        F.concat(F.lit("s"), F.lpad(F.col("c_nationkey").cast("string"), 6, "0")).alias("ston"),
        F.concat(F.when(key % 3 == 0, "v").otherwise("w"), text).alias("vdn_dial_no"),
        F.concat(F.lit("u"), F.lpad(text, 25, "7")).alias("ucid"),
        F.concat(F.lit("t"), F.lpad(text, 10, "0")).alias("in_call_no"),
    )


GRADES_SQL = """SELECT c_custkey AS cust_no,
 CASE c_custkey % 10 WHEN 0 THEN 'F' WHEN 1 THEN 'FC' WHEN 2 THEN 'A' WHEN 3 THEN 'M' WHEN 4 THEN 'I'
  WHEN 5 THEN 'L' WHEN 6 THEN 'Y' WHEN 7 THEN 'T' WHEN 8 THEN 'X' ELSE NULL END AS cust_grd_gbcd,
 c_custkey % 7 AS item_eval_cnt, c_custkey % 11 AS rord_cnt, c_acctbal AS rord_amt,
 c_custkey % 5 AS m11_item_eval_cnt, c_custkey % 13 AS m11_rord_cnt, c_acctbal * 2 AS m11_rord_amt,
 c_nationkey AS grd_retn_mths FROM customer"""


def customer_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    letters = F.lit(None).cast("string")
    for digit, letter in enumerate(("F", "FC", "A", "M", "I", "L", "Y", "T", "X")):
        letters = F.when(key % 10 == digit, letter).otherwise(letters)
    return table(spark, sf_dir, "customer").select(
        key.alias("cust_no"),
        letters.alias("cust_grd_gbcd"),
        (key % 7).alias("item_eval_cnt"),
        (key % 11).alias("rord_cnt"),
        F.col("c_acctbal").alias("rord_amt"),
        (key % 5).alias("m11_item_eval_cnt"),
        (key % 13).alias("m11_rord_cnt"),
        (F.col("c_acctbal") * 2).alias("m11_rord_amt"),
        F.col("c_nationkey").alias("grd_retn_mths"),
    )
