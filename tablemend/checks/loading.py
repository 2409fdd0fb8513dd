"""Latest rows, upserts, repair and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.checks import fixtures as X
from tablemend.checks.comparison import LOG_SQL, order_check
from tablemend.checks.registry import query
from tablemend.functions import predicates as P
from tablemend.functions.windows import TimeWindow, make_window
from tablemend.operators import dedupe as D
from tablemend.operators import numbering as N
from tablemend.operators import upsert as U
from tablemend.operators.ledger import max_time
from tablemend.operators.repair import diff_log
from tablemend.plans import export as E
from tablemend.plans import load, verify
from tablemend.session import scratch_path
from tablemend.sinks import files as K

_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "chg_dtm"]
_COLUMNS = ", ".join(_ORDER)


def latest_sql(rows: str) -> str:
    """Latest row per order; equal times fall to the other columns, greatest first."""
    return f"""SELECT {_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY chg_dtm DESC NULLS LAST,
 o_custkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderpriority DESC) AS rn FROM ({rows})) WHERE rn = 1"""


def upsert_sql(target: str, source: str) -> str:
    """All columns from the source where it has the key."""
    return f"""SELECT {_COLUMNS} FROM ({source}) UNION ALL
 SELECT {_COLUMNS} FROM ({target}) a WHERE NOT EXISTS (SELECT 1 FROM ({source}) b WHERE b.o_orderkey = a.o_orderkey)"""


@query(latest_sql(X.DUPLICATES_SQL))
def latest_per_key(spark, sf_dir):
    return D.latest_per_key(X.versioned_orders(spark, sf_dir), X.KEYS, ["chg_dtm"])


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, n FROM (SELECT l_orderkey, l_linenumber, l_shipdate, count(*) AS n,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) AS rn
 FROM lineitem GROUP BY 1, 2, 3) WHERE rn = 1"""
)
def latest_line(spark, sf_dir):
    """Many copies per key: lines counted first, then the last one of each order."""
    lines = X.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_shipdate")
    return D.latest_per_key(lines.agg(F.count("*").alias("n")), ["l_orderkey"], ["l_shipdate"], ["l_linenumber"])


@query(
    f"""WITH v AS (SELECT * FROM ({X.DUPLICATES_SQL})
 WHERE chg_dtm >= TIMESTAMP '1997-01-01' AND chg_dtm < TIMESTAMP '1999-01-01')
 SELECT v.* FROM v WHERE chg_dtm = (SELECT max(m.chg_dtm) FROM v m WHERE m.o_orderkey = v.o_orderkey)"""
)
def latest_in_window(spark, sf_dir):
    return D.latest_in_window(X.versioned_orders(spark, sf_dir), X.KEYS, "chg_dtm", X.ORDER_WINDOW)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem a
 WHERE l_shipdate = (SELECT max(b.l_shipdate) FROM lineitem b WHERE b.l_orderkey = a.l_orderkey)"""
)
def latest_with_ties(spark, sf_dir):
    lines = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    ever = TimeWindow("1900-01-01 00:00:00", "2100-01-01 00:00:00")
    return D.latest_in_window(lines, ["l_orderkey"], "l_shipdate", ever)


@query(
    """SELECT o_orderkey, o_orderdate, row_no FROM (SELECT o_orderkey, o_orderdate,
 row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no FROM orders) WHERE row_no BETWEEN 101 AND 400"""
)
def row_range(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return N.row_range(orders, ["o_orderdate", "o_orderkey"], 101, 400)


@query(
    """SELECT event_type, ts, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_no
 FROM events"""
)
def numbered_groups(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    return N.numbered(events, ["event_type"], ["ts"])


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def sort_result(spark, sf_dir):
    return D.sort_result(X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query("SELECT least(100, count(*)) AS n FROM orders")
def limit_sample(spark, sf_dir):
    return D.limit_sample(X.table(spark, sf_dir, "orders"), 100).agg(F.count("*").alias("n"))


@query(f"{X.COPIES_SQL} SELECT max(chg_dtm) AS max_chg_dtm FROM t")
def latest_change(spark, sf_dir):
    return max_time(X.target_orders(spark, sf_dir), "chg_dtm")


# Upserts --------------------------------------------------------------------


@query(f"{X.COPIES_SQL} {upsert_sql('SELECT * FROM t', 'SELECT * FROM s')}")
def upsert(spark, sf_dir):
    return U.upsert(X.target_orders(spark, sf_dir), X.source_orders(spark, sf_dir), X.KEYS)


@query(
    f"""{X.COPIES_SQL} SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
 CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, t.o_orderpriority,
 CASE WHEN s.o_orderkey IS NULL THEN t.chg_dtm ELSE s.chg_dtm END AS chg_dtm
 FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey"""
)
def upsert_columns(spark, sf_dir):
    """Only listed columns change; the others keep the target's values."""
    listed = ["o_orderkey", "o_totalprice", "chg_dtm"]
    return U.upsert(X.target_orders(spark, sf_dir), X.source_orders(spark, sf_dir), X.KEYS, listed)


@query(f"{X.COPIES_SQL}, v AS ({X.DUPLICATES_SQL}) {upsert_sql('SELECT * FROM t', latest_sql('SELECT * FROM v'))}")
def dedupe_upsert(spark, sf_dir):
    return U.dedupe_upsert(X.target_orders(spark, sf_dir), X.versioned_orders(spark, sf_dir), X.KEYS, ["chg_dtm"])


@query(
    f"""{X.COPIES_SQL}, v AS (SELECT * FROM ({X.DUPLICATES_SQL}) WHERE chg_dtm {X.IN_ORDERS})
 {upsert_sql('SELECT * FROM t', latest_sql('SELECT * FROM v'))}"""
)
def incremental_load(spark, sf_dir):
    target, staged = X.target_orders(spark, sf_dir), X.versioned_orders(spark, sf_dir)
    return load.incremental_load(target, staged, X.KEYS, "chg_dtm", X.ORDER_WINDOW)


@query(
    f"""{X.COPIES_SQL}, c AS (SELECT * FROM s WHERE chg_dtm {X.IN_ORDERS})
 {upsert_sql('SELECT * FROM t', 'SELECT * FROM c')}"""
)
def upsert_partitions(spark, sf_dir):
    """Target in a folder per order month, of which the change set touches some."""
    held = X.table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("ym"))
    target = X.target_orders(spark, sf_dir).join(held, "o_orderkey")
    changes = X.source_orders(spark, sf_dir).where(P.in_window("chg_dtm", X.ORDER_WINDOW)).join(held, "o_orderkey")
    path = scratch_path(spark, "months")
    target.hint("rebalance", "ym").write.partitionBy("ym").parquet(path)
    load.upsert_partitions(spark, path, changes, X.KEYS, "ym", scratch_path(spark, "months-staging"))
    return spark.read.parquet(path).drop("ym")


@query(f"{X.COPIES_SQL} SELECT * FROM t WHERE o_orderkey IN (SELECT o_orderkey FROM s)")
def sync_deletes(spark, sf_dir):
    return U.sync_deletes(X.target_orders(spark, sf_dir), X.source_orders(spark, sf_dir), X.KEYS)


@query(
    f"""{X.COPIES_SQL} SELECT t.* FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM q)
 UNION ALL SELECT {_COLUMNS} FROM q WHERE op <> 'D'"""
)
def apply_changes(spark, sf_dir):
    return U.apply_changes(X.target_orders(spark, sf_dir), X.queued_events(spark, sf_dir), X.KEYS, ["chg_dtm"])


# Repair ---------------------------------------------------------------------

_BAD = f"SELECT o_orderkey FROM ({LOG_SQL}) WHERE kind <> 'target_only'"
_EVENTS = f"""SELECT 'U' AS op, '0' AS transact_id, '0' AS file_name, '0' AS file_offset, o_orderkey AS pk_o_orderkey, s.*
 FROM s WHERE o_orderkey IN ({_BAD})"""


def _queue(spark, sf_dir):
    check, path = order_check(spark, sf_dir), scratch_path(spark, "queue-log")
    verify.write_diff_log(check, X.ORDER_WINDOW, X.BATCH, path)
    return verify.repair_queue(check, spark.read.parquet(path), X.BATCH)


@query(f"{X.COPIES_SQL} {_EVENTS}")
def build_repair_events(spark, sf_dir):
    return _queue(spark, sf_dir)


@query(f"{X.COPIES_SQL} {upsert_sql('SELECT * FROM t', f'SELECT s.* FROM s WHERE o_orderkey IN ({_BAD})')}")
def repaired_target(spark, sf_dir):
    return verify.repaired_target(order_check(spark, sf_dir), _queue(spark, sf_dir))


@query(
    f"""{X.COPIES_SQL} SELECT kind, o_orderkey FROM ({LOG_SQL}) WHERE kind = 'target_only'"""
)
def repair_closes(spark, sf_dir):
    """After the repair only target-only keys are reported: an update cannot remove them."""
    check = order_check(spark, sf_dir)
    mended = verify.repaired_target(check, _queue(spark, sf_dir))
    again = verify.TableCheck("sales", "orders", check.source, mended, X.KEYS, "chg_dtm", check.deletes)
    return verify.verification_log(again, X.ORDER_WINDOW, X.BATCH).select("kind", "o_orderkey")


@query(f"{X.COPIES_SQL} SELECT * FROM ({LOG_SQL})")
def write_diff_log(spark, sf_dir):
    path = scratch_path(spark, "diff-log")
    verify.write_diff_log(order_check(spark, sf_dir), X.ORDER_WINDOW, X.BATCH, path)
    return spark.read.parquet(path)


@query(f"{X.COPIES_SQL} SELECT 'b1' AS batch_id, o_orderkey, '19970101' AS verifi_date FROM s "
       "WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)")
def logged_keys(spark, sf_dir):
    missing = X.source_orders(spark, sf_dir).join(X.target_orders(spark, sf_dir), "o_orderkey", "left_anti")
    return diff_log(missing.select("o_orderkey"), "b1", "19970101")


# Export ---------------------------------------------------------------------

_SHIFTED = "BETWEEN TIMESTAMP '1997-01-02 00:00:00' AND TIMESTAMP '1998-01-01 23:59:59'"


@query(
    f"""{X.COPIES_SQL}, e AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM s WHERE chg_dtm {_SHIFTED})
 SELECT coalesce(t.o_orderkey, e.o_orderkey) AS o_orderkey,
 coalesce(e.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
 CAST(coalesce(e.o_totalprice, t.o_totalprice) AS DECIMAL(38,6)) AS o_totalprice
 FROM t FULL JOIN e ON e.o_orderkey = t.o_orderkey"""
)
def reverse_upsert(spark, sf_dir):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    condition = P.in_window("chg_dtm", make_window("19970101", "19971231", 1, 1))
    target = X.target_orders(spark, sf_dir).select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(38,6)").alias("o_totalprice")
    )
    return E.reverse_upsert(target, X.source_orders(spark, sf_dir), X.KEYS, columns, condition)


@query(
    f"""{X.COPIES_SQL} SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38,6)) AS o_totalprice
 FROM s WHERE chg_dtm {_SHIFTED}"""
)
def stage_reverse(spark, sf_dir):
    path = scratch_path(spark, "staging")
    condition = P.in_window("chg_dtm", make_window("19970101", "19971231", 1, 1))
    E.stage_reverse(X.source_orders(spark, sf_dir), ["o_orderkey", "o_totalprice"], condition, path)
    return spark.read.parquet(path)


_MONTHS = "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS bsic_ym FROM orders"


@query(
    f"""SELECT * FROM ({_MONTHS}) WHERE bsic_ym NOT BETWEEN '199703' AND '199706'
 UNION ALL SELECT o_orderkey, o_totalprice + 1, bsic_ym FROM ({_MONTHS}) WHERE bsic_ym BETWEEN '199704' AND '199706'"""
)
def delete_window_insert(spark, sf_dir):
    months = X.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("bsic_ym")
    )
    fresh = months.where(F.col("bsic_ym").between("199704", "199706"))
    fresh = fresh.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return K.replace_periods(months, fresh, "bsic_ym", "199703", "199706")
