"""Windows, predicates and calendar conditions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.checks import fixtures as X
from tablemend.checks.registry import query
from tablemend.functions import predicates as P
from tablemend.functions import windows as W
from tablemend.functions.times import compact_text
from tablemend.functions.windows import make_window, with_offset_windows
from tablemend.operators import convert as C
from tablemend.operators import schemas
from tablemend.plans import recompute
from tablemend.sources import scans

_ORDER_DAYS = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate"


def _order_days(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")


@query(f"{_ORDER_DAYS} {X.IN_ORDERS}")
def window_closed(spark, sf_dir):
    return scans.read_window(_order_days(spark, sf_dir), "o_orderdate", X.ORDER_WINDOW)


@query(f"{_ORDER_DAYS} >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'")
def window_half_open(spark, sf_dir):
    return _order_days(spark, sf_dir).where(P.in_half_open("o_orderdate", X.ORDER_WINDOW))


@query(f"{_ORDER_DAYS} >= TIMESTAMP '1999-06-01'")
def window_open_ended(spark, sf_dir):
    return _order_days(spark, sf_dir).where(P.from_instant("o_orderdate", "1999-06-01 00:00:00"))


@query(f"{_ORDER_DAYS} >= TIMESTAMP '1999-01-01'")
def window_after(spark, sf_dir):
    return scans.read_window(_order_days(spark, sf_dir), "o_orderdate", X.ORDER_WINDOW, "after")


_SHIFTS = {"both": (1, 1), "end": (0, 1), "end_two": (1, 2)}


@query(
    """SELECT 'both' AS shifted, o_orderkey, o_orderdate FROM orders
 WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-02 00:00:00' AND TIMESTAMP '1997-07-01 23:59:59'
 UNION ALL SELECT 'end', o_orderkey, o_orderdate FROM orders
 WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-07-01 23:59:59'
 UNION ALL SELECT 'end_two', o_orderkey, o_orderdate FROM orders
 WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-02 00:00:00' AND TIMESTAMP '1997-07-02 23:59:59'"""
)
def window_shifted(spark, sf_dir):
    days = _order_days(spark, sf_dir)
    parts = []
    for name, (lo, hi) in _SHIFTS.items():
        window = make_window("19970101", "19970630", lo, hi)
        parts.append(days.where(P.in_window("o_orderdate", window)).select(F.lit(name).alias("shifted"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query(
    """SELECT event_id, ts FROM events
 WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-11 05:59:59'"""
)
def window_business_day(spark, sf_dir):
    window = make_window("20240105", "20240110", day_start="06:00:00")
    return X.table(spark, sf_dir, "events").select("event_id", "ts").where(P.in_window("ts", window))


@query(f"SELECT * FROM ({X.INCREMENTAL_SQL}) WHERE chg_dtm {X.IN_ORDERS} OR reg_dtm {X.IN_ORDERS}")
def window_either(spark, sf_dir):
    return X.incremental_orders(spark, sf_dir).where(P.either_in_window(["chg_dtm", "reg_dtm"], X.ORDER_WINDOW))


_TEXT_DAYS = "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS aply_dt FROM orders"


def _text_days(spark, sf_dir):
    return _order_days(spark, sf_dir).select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("aply_dt"))


@query(f"SELECT * FROM ({_TEXT_DAYS}) WHERE aply_dt BETWEEN '19970102' AND '19980101'")
def window_text_date(spark, sf_dir):
    return _text_days(spark, sf_dir).where(P.date_text_in("aply_dt", "19970101", "19971231", 1))


@query(
    """SELECT * FROM (SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS chg_text FROM events)
 WHERE chg_text BETWEEN '20240105000000' AND '20240120000000'"""
)
def window_text_time(spark, sf_dir):
    texts = X.table(spark, sf_dir, "events").select("event_id", compact_text(F.col("ts")).alias("chg_text"))
    return texts.where(P.compact_text_in("chg_text", X.EVENT_WINDOW))


@query(
    """SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'Y' ELSE 'N' END AS trgt_yn,
 strftime(o_orderdate, '%Y%m%d') AS notc_prrg_dt FROM orders)
 WHERE trgt_yn = 'Y' AND notc_prrg_dt BETWEEN '19970102' AND '19980101'"""
)
def window_flagged(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.startswith("o_orderpriority", F.lit("1")), "Y").otherwise("N").alias("trgt_yn"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("notc_prrg_dt"),
    )
    return orders.where(P.flagged_and_due("trgt_yn", "notc_prrg_dt", "19970101", "19971231"))


@query(
    """SELECT event_id, ts FROM events
 WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 23:59:59'"""
)
def window_load_day(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select("event_id", "ts").where(P.loaded_on("ts", "2024-01-10 15:30:00"))


_HOLED = """SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderdate
 FROM orders"""


def _holed(spark, sf_dir):
    key = F.col("o_custkey")
    return X.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 10 == 0, None).otherwise(key).alias("o_custkey"), "o_orderdate"
    )


@query(f"SELECT * FROM ({_HOLED}) WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
def keys_present(spark, sf_dir):
    return _holed(spark, sf_dir).where(P.keys_present(["o_orderkey", "o_custkey"]))


@query(
    f"""SELECT o_orderkey, o_custkey FROM ({_HOLED})
 WHERE o_orderdate {X.IN_ORDERS} AND o_orderkey IS NOT NULL AND o_custkey IS NOT NULL"""
)
def read_required(spark, sf_dir):
    keys = ["o_orderkey", "o_custkey"]
    return scans.read_required(_holed(spark, sf_dir), keys, keys, "o_orderdate", X.ORDER_WINDOW)


_NAMES = """SELECT p_partkey, concat(upper(replace(p_name, ' ', '_')),
 CASE p_partkey % 6 WHEN 0 THEN '_BIN' WHEN 1 THEN '_LOG' WHEN 2 THEN '_TEST' WHEN 3 THEN '_OCI' ELSE '' END)
 AS table_name FROM part"""


def _table_names(spark, sf_dir):
    suffix = F.lit("")
    for digit, text in enumerate(("_BIN", "_LOG", "_TEST", "_OCI")):
        suffix = F.when(F.col("p_partkey") % 6 == digit, text).otherwise(suffix)
    name = F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))), suffix)
    return X.table(spark, sf_dir, "part").select("p_partkey", name.alias("table_name"))


@query(
    f"""SELECT * FROM ({_NAMES}) WHERE table_name LIKE '%RED%' AND table_name NOT LIKE '%BIN'
 AND table_name NOT LIKE '%LOG' AND table_name NOT LIKE '%TEST' AND table_name NOT LIKE '%OCI'"""
)
def catalog_filter(spark, sf_dir):
    return _table_names(spark, sf_dir).where(P.name_selected("table_name", "RED", ["BIN", "LOG", "TEST", "OCI"]))


@query(
    """SELECT 'LOAD' AS schema_name, 'T' || o_orderkey AS table_name FROM orders o
 WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = 3)"""
)
def table_has_column(spark, sf_dir):
    tables = X.table(spark, sf_dir, "orders").select(
        F.lit("LOAD").alias("schema_name"), F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("table_name")
    )
    return schemas.tables_with_column(tables, X.column_catalog(spark, sf_dir), "C3")


@query(
    f"""SELECT CASE WHEN reg_dtm = chg_dtm THEN 'I' ELSE 'U' END AS op, i.*, chg_dtm AS transact_id
 FROM ({X.INCREMENTAL_SQL}) i WHERE chg_dtm >= TIMESTAMP '1997-01-01' AND chg_dtm < TIMESTAMP '1999-01-01'"""
)
def cdc_classify(spark, sf_dir):
    changed = scans.read_window(X.incremental_orders(spark, sf_dir), "chg_dtm", X.ORDER_WINDOW, "half_open")
    return C.classified_changes(changed, "reg_dtm", "chg_dtm")


@query(
    f"""SELECT 'I' AS op, o_orderkey, chg_dtm AS transact_id FROM ({X.INCREMENTAL_SQL}) WHERE reg_dtm = chg_dtm
 UNION ALL SELECT 'U', o_orderkey, chg_dtm FROM ({X.INCREMENTAL_SQL}) WHERE reg_dtm <> chg_dtm"""
)
def cdc_union(spark, sf_dir):
    rows = C.classified_changes(X.incremental_orders(spark, sf_dir), "reg_dtm", "chg_dtm")
    return rows.select("op", "o_orderkey", "transact_id")


@query(f"SELECT event_id, pgmid, jbpmt FROM ({X.RUNS_SQL}) WHERE jbpmt IS NULL UNION ALL "
       f"SELECT event_id, pgmid, jbpmt FROM ({X.RUNS_SQL}) WHERE jbpmt = '42'")
def parameter_match(spark, sf_dir):
    runs = X.job_runs(spark, sf_dir).select("event_id", "pgmid", "jbpmt")
    return runs.where(P.matches_parameter("jbpmt", "")).unionByName(runs.where(P.matches_parameter("jbpmt", "42")))


@query("SELECT event_id, ts, CAST(hour(ts) AS INTEGER) AS slice_hour FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def hourly_slices(spark, sf_dir):
    return scans.hourly_slices(X.table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "2024-01-10 00:00:00")


@query("SELECT user_id, event_id FROM events WHERE user_id > 70 OR (user_id = 70 AND event_id > 100)")
def read_after_key(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").select("user_id", "event_id")
    read_before = events.where("user_id < 70 OR (user_id = 70 AND event_id <= 100)")
    mark = spark.range(1).select(
        F.struct(F.lit(70).cast("long").alias("user_id"), F.lit(100).cast("long").alias("event_id")).alias("mark")
    )
    # The mark is the greatest key read or the given start, whichever is later.
    reached = scans.next_mark(read_before.unionByName(mark.select("mark.*")), X.PAIR_KEYS)
    return scans.read_after_key(events, X.PAIR_KEYS, reached)


@query("SELECT max(user_id) AS user_id, arg_max(event_id, user_id * 1000000000 + event_id) AS event_id FROM events")
def next_mark(spark, sf_dir):
    return scans.next_mark(X.table(spark, sf_dir, "events"), X.PAIR_KEYS).select("mark.*")


@query("SELECT * FROM customer")
def read_full_partitioned(spark, sf_dir):
    return scans.read_full_partitioned(X.table(spark, sf_dir, "customer"))


@query("SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer")
def pick_source(spark, sf_dir):
    files = scans.Route("parquet", {"path": f"{sf_dir}/{{table}}.parquet"})
    opened = {t: scans.pick_source(spark, t, {"orders": files}, files) for t in ("orders", "customer")}
    counts = [df.agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t, df in opened.items()]
    return reduce(DataFrame.unionByName, counts)


_CODED = """SELECT o_orderkey, o_orderstatus, concat(CASE o_orderkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'D' ELSE 'M' END,
 lpad(CAST(o_orderkey % 100 AS VARCHAR), 3, '0')) AS code, o_orderdate AS p_start,
 o_orderdate + INTERVAL 5 DAY AS p_end FROM orders"""
_OFFSET = f"""SELECT o_orderkey, code,
 strftime(p_start - INTERVAL 1 DAY * (o_orderkey % 100), '%Y%m%d') AS v_p_start,
 strftime(p_end - INTERVAL 1 DAY * (CASE WHEN code LIKE 'F%' THEN 0 ELSE o_orderkey % 100 END), '%Y%m%d') AS v_p_end,
 CAST(CASE WHEN code LIKE 'F%' THEN 0 ELSE o_orderkey % 100 END AS INTEGER) AS p_dcyl FROM ({_CODED})"""


@query(_OFFSET)
def offset_windows(spark, sf_dir):
    n = F.col("o_orderkey")
    kind = F.when(n % 3 == 0, "F").when(n % 3 == 1, "D").otherwise("M")
    coded = X.table(spark, sf_dir, "orders").select(
        n,
        F.concat(kind, F.lpad((n % 100).cast("string"), 3, "0")).alias("code"),
        F.col("o_orderdate").alias("p_start"),
        (F.col("o_orderdate") + F.expr("INTERVAL '5' DAY")).alias("p_end"),
    )
    return with_offset_windows(coded, "code", "p_start", "p_end").select(
        n,
        "code",
        F.date_format("window_start", "yyyyMMdd").alias("v_p_start"),
        F.date_format("window_end", "yyyyMMdd").alias("v_p_end"),
        F.col("day_offset").alias("p_dcyl"),
    )


def _windows(spark):
    """Recompute windows of one run: parameters of the job, not data."""
    codes = spark.createDataFrame([("F015",), ("D028",), ("D001",)], "code string")
    days = {"p_start": F.lit("1998-03-02").cast("date"), "p_end": F.lit("1998-03-02").cast("date")}
    return with_offset_windows(codes.withColumns(days), "code", "p_start", "p_end")


_RECOMPUTED = """SELECT w.code, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS smr_dt, o_orderpriority,
 count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DECIMAL(38,6)) AS amt
 FROM orders JOIN (VALUES ('F015', DATE '1998-02-15', DATE '1998-03-02'), ('D028', DATE '1998-02-02', DATE '1998-02-02'),
 ('D001', DATE '1998-03-01', DATE '1998-03-01')) w(code, lo, hi) ON CAST(o_orderdate AS DATE) BETWEEN w.lo AND w.hi
 GROUP BY 1, 2, 3"""


def _daily(spark, sf_dir, windows):
    amount = F.sum(F.col("o_totalprice").cast("decimal(28,6)")).cast("decimal(38,6)")
    return recompute.recompute_windows(
        X.table(spark, sf_dir, "orders"),
        "o_orderdate",
        windows,
        "code",
        ["o_orderpriority"],
        [F.count("*").alias("n"), amount.alias("amt")],
    )


@query(_RECOMPUTED)
def recompute_windows(spark, sf_dir):
    rows = _daily(spark, sf_dir, _windows(spark))
    return rows.select("code", F.date_format("day", "yyyyMMdd").alias("smr_dt"), "o_orderpriority", "n", "amt")


@query(
    """SELECT strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS smr_dt, o_orderpriority, count(*)
 + CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-02-15' AND DATE '1998-03-02'
 OR CAST(o_orderdate AS DATE) = DATE '1998-02-02' THEN 0 ELSE 1 END AS n
 FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderpriority"""
)
def replace_days(spark, sf_dir):
    """A mart whose counts are all one too high, recomputed inside the windows."""
    windows = _windows(spark)
    orders = X.table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    mart = orders.groupBy("day", "o_orderpriority").agg((F.count("*") + 1).alias("n"))
    mended = recompute.replace_days(mart, _daily(spark, sf_dir, windows), windows, "code")
    return mended.select(F.date_format("day", "yyyyMMdd").alias("smr_dt"), "o_orderpriority", "n")


@query(
    """SELECT o_orderkey, CASE WHEN day(o_orderdate) = 1 THEN 'first'
 WHEN month(o_orderdate + INTERVAL 1 DAY) <> month(o_orderdate) THEN 'last' WHEN day(o_orderdate) = 2 THEN 'second'
 WHEN day(o_orderdate) = 3 THEN 'third' WHEN day(o_orderdate) = 14 THEN 'fourteenth' END AS work FROM orders"""
)
def calendar_flag(spark, sf_dir):
    return _order_days(spark, sf_dir).select("o_orderkey", W.calendar_flag(F.col("o_orderdate")).alias("work"))
