"""Key comparison, pairs and verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemend.checks import fixtures as X
from tablemend.checks.registry import query
from tablemend.functions.times import compact_text, second_index
from tablemend.operators import ledger as L
from tablemend.operators import pairs as P
from tablemend.operators.dedupe import distinct_tables as tables_once
from tablemend.operators.keys import rows_not_in
from tablemend.plans import verify as V

_NEWEST = "(SELECT max(chg_dtm) FROM t)"
_MATCH = "s.o_orderkey = t.o_orderkey"
_CHANGED = f"""SELECT s.o_orderkey, s.chg_dtm AS src_chg_dtm, t.chg_dtm AS tgt_chg_dtm FROM s JOIN t ON {_MATCH}
 WHERE s.chg_dtm {X.IN_ORDERS} AND t.chg_dtm {X.IN_ORDERS} AND date_diff('second', t.chg_dtm, s.chg_dtm) <> 0
 AND s.chg_dtm <= {_NEWEST} AND NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = s.o_orderkey)"""
_SOURCE_ONLY = f"""SELECT s.o_orderkey, s.chg_dtm AS src_chg_dtm FROM s WHERE s.chg_dtm {X.IN_ORDERS}
 AND s.o_orderkey NOT IN (SELECT o_orderkey FROM t WHERE chg_dtm {X.IN_ORDERS}) AND s.chg_dtm < {_NEWEST}"""
_TARGET_ONLY = f"""SELECT t.o_orderkey, t.chg_dtm AS tgt_chg_dtm FROM t WHERE t.chg_dtm {X.IN_ORDERS}
 AND t.o_orderkey NOT IN (SELECT o_orderkey FROM s WHERE chg_dtm {X.IN_ORDERS})
 AND t.o_orderkey NOT IN (SELECT o_orderkey FROM s WHERE chg_dtm >= TIMESTAMP '1999-01-01')"""
_KINDS = f"""SELECT 'changed' AS kind, o_orderkey, src_chg_dtm, tgt_chg_dtm FROM ({_CHANGED})
 UNION ALL SELECT 'source_only', o_orderkey, src_chg_dtm, NULL FROM ({_SOURCE_ONLY})
 UNION ALL SELECT 'target_only', o_orderkey, NULL, tgt_chg_dtm FROM ({_TARGET_ONLY})"""
LOG_SQL = f"""SELECT '{X.BATCH}' AS batch_id, k.*, '1997-01-01 00:00:00' AS verifi_date FROM ({_KINDS}) k"""


def _copies(spark, sf_dir):
    return X.source_orders(spark, sf_dir), X.target_orders(spark, sf_dir)


def order_check(spark, sf_dir):
    source, target = _copies(spark, sf_dir)
    return V.TableCheck("sales", "orders", source, target, X.KEYS, "chg_dtm", X.delete_events(spark, sf_dir))


@query(f"{X.COPIES_SQL} {_CHANGED}")
def diff_changed(spark, sf_dir):
    return L.diff_changed(*_copies(spark, sf_dir), X.KEYS, "chg_dtm", X.ORDER_WINDOW, X.delete_events(spark, sf_dir))


@query(f"{X.COPIES_SQL} {_SOURCE_ONLY}")
def source_only(spark, sf_dir):
    return L.source_only(*_copies(spark, sf_dir), X.KEYS, "chg_dtm", X.ORDER_WINDOW)


@query(f"{X.COPIES_SQL} {_TARGET_ONLY}")
def target_only(spark, sf_dir):
    return L.target_only(*_copies(spark, sf_dir), X.KEYS, "chg_dtm", X.ORDER_WINDOW)


_SINCE = f">= TIMESTAMP '{X.PENDING_SINCE}'"


@query(
    f"""{X.COPIES_SQL} SELECT s.o_orderkey, s.chg_dtm AS src_chg_dtm, t.chg_dtm AS tgt_chg_dtm FROM s JOIN t ON {_MATCH}
 WHERE s.chg_dtm {_SINCE} AND t.chg_dtm {_SINCE} AND date_diff('second', t.chg_dtm, s.chg_dtm) <> 0
 AND s.chg_dtm <= {_NEWEST} AND NOT EXISTS (SELECT 1 FROM q WHERE q.o_orderkey = s.o_orderkey AND q.op = 'D'
 AND q.chg_dtm > {_NEWEST})"""
)
def diff_changed_pending(spark, sf_dir):
    events = X.queued_events(spark, sf_dir)
    return L.diff_changed_pending(*_copies(spark, sf_dir), X.KEYS, "chg_dtm", X.PENDING_SINCE, events)


@query(
    f"""{X.COPIES_SQL} SELECT s.o_orderkey, s.chg_dtm AS src_chg_dtm FROM s WHERE s.chg_dtm {_SINCE}
 AND s.o_orderkey NOT IN (SELECT o_orderkey FROM t) AND s.chg_dtm < (SELECT max(chg_dtm) FROM q)
 AND NOT EXISTS (SELECT 1 FROM q WHERE q.o_orderkey = s.o_orderkey AND q.op = 'I' AND q.chg_dtm >= {_NEWEST})"""
)
def source_only_pending(spark, sf_dir):
    events = X.queued_events(spark, sf_dir)
    return L.source_only_pending(*_copies(spark, sf_dir), X.KEYS, "chg_dtm", X.PENDING_SINCE, events)


@query(
    f"""{X.COPIES_SQL} SELECT t.o_orderkey, t.chg_dtm AS tgt_chg_dtm FROM t WHERE t.chg_dtm {_SINCE}
 AND t.o_orderkey NOT IN (SELECT o_orderkey FROM s WHERE chg_dtm {_SINCE})
 AND NOT EXISTS (SELECT 1 FROM q WHERE q.o_orderkey = t.o_orderkey AND q.op = 'D' AND q.chg_dtm >= {_NEWEST})"""
)
def target_only_pending(spark, sf_dir):
    events = X.queued_events(spark, sf_dir)
    return L.target_only_pending(*_copies(spark, sf_dir), X.KEYS, "chg_dtm", X.PENDING_SINCE, events)


@query(
    f"""{X.EVENT_COPIES_SQL} SELECT s.user_id, s.event_id, date_trunc('second', s.chg_dtm) AS src_chg_dtm,
 t.chg_dtm AS tgt_chg_dtm FROM s JOIN t ON s.user_id = t.user_id AND s.event_id = t.event_id
 WHERE s.chg_dtm {X.IN_EVENTS} AND t.chg_dtm {X.IN_EVENTS} AND date_diff('second', s.chg_dtm, t.chg_dtm) <> 0
 AND date_trunc('second', s.chg_dtm) <= (SELECT max(chg_dtm) FROM t)"""
)
def diff_changed_composite(spark, sf_dir):
    """Two-column key; 0.7 s counts only where it crosses a second boundary."""
    source, target = X.source_events(spark, sf_dir), X.target_events(spark, sf_dir)
    return L.diff_changed(source, target, X.PAIR_KEYS, "chg_dtm", X.EVENT_WINDOW)


@query(
    f"""{X.EVENT_COPIES_SQL} SELECT user_id, event_id, date_trunc('second', chg_dtm) AS src_chg_dtm FROM s
 WHERE chg_dtm {X.IN_EVENTS} AND NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id AND t.event_id = s.event_id
 AND t.chg_dtm {X.IN_EVENTS}) AND date_trunc('second', chg_dtm) < (SELECT max(chg_dtm) FROM t)"""
)
def source_only_composite(spark, sf_dir):
    source, target = X.source_events(spark, sf_dir), X.target_events(spark, sf_dir)
    return L.source_only(source, target, X.PAIR_KEYS, "chg_dtm", X.EVENT_WINDOW)


@query(f"{X.COPIES_SQL} {_KINDS}")
def all_differences(spark, sf_dir):
    check = order_check(spark, sf_dir)
    return L.all_differences(check.source, check.target, X.KEYS, "chg_dtm", X.ORDER_WINDOW, check.deletes)


def _summary_sql(table_name: str) -> str:
    return f"""SELECT '{X.BATCH}' AS batch_id, '{table_name}' AS table_nm, 'sales' AS schema_name,
 TIMESTAMP '1997-01-01 00:00:00' AS verifi_date,
 (SELECT count(*) FROM s WHERE chg_dtm {X.IN_ORDERS}) AS source_total_count,
 (SELECT count(*) FROM t WHERE chg_dtm {X.IN_ORDERS}) AS target_total_count,
 (SELECT count(*) FROM ({_CHANGED})) AS chg_dtm_diff_count,
 (SELECT count(*) FROM ({_SOURCE_ONLY})) AS source_only_count,
 (SELECT count(*) FROM ({_TARGET_ONLY})) AS target_only_count,
 TIMESTAMP '{X.EXECUTED_AT}' AS execute_dtm,
 (SELECT max(chg_dtm) FROM s WHERE chg_dtm {X.IN_ORDERS}) AS temp_max_chg_dtm"""


@query(f"{X.COPIES_SQL} {_summary_sql('orders')}")
def verification_summary(spark, sf_dir):
    return V.verification_summary(order_check(spark, sf_dir), X.ORDER_WINDOW, X.BATCH, X.EXECUTED_AT)


def line_check(spark, sf_dir):
    """Shipping state per order: the latest line of each order against the order dates."""
    lines = X.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    shipped = lines.agg(F.max("l_shipdate").alias("chg_dtm"))
    return V.TableCheck("sales", "shipments", shipped, X.target_orders(spark, sf_dir), X.KEYS, "chg_dtm")


_SHIPPED = "SELECT l_orderkey AS o_orderkey, max(l_shipdate) AS chg_dtm FROM lineitem GROUP BY l_orderkey"


@query(
    f"""SELECT * FROM ({X.COPIES_SQL} {_summary_sql('orders')}) UNION ALL
 SELECT * FROM (WITH s AS ({_SHIPPED}), t AS ({X.TARGET_SQL}), d AS (SELECT -1 AS o_orderkey)
 {_summary_sql('shipments')})"""
)
def verify_tables(spark, sf_dir):
    checks = [order_check(spark, sf_dir), line_check(spark, sf_dir)]
    return V.verify_tables(checks, X.ORDER_WINDOW, X.BATCH, X.EXECUTED_AT)


@query(f"{X.COPIES_SQL} {LOG_SQL}")
def verification_log(spark, sf_dir):
    return V.verification_log(order_check(spark, sf_dir), X.ORDER_WINDOW, X.BATCH)


# Pairs ----------------------------------------------------------------------


@query(
    f"""{X.COPIES_SQL} SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.chg_dtm, t.chg_dtm) AS chg_dtm,
 CAST(CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS left_rows,
 CAST(CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS right_rows,
 CASE WHEN t.o_orderkey IS NULL THEN 'left_only' WHEN s.o_orderkey IS NULL THEN 'right_only' ELSE 'both' END AS side
 FROM s FULL JOIN t ON {_MATCH} AND s.chg_dtm = t.chg_dtm"""
)
def outer_indicator(spark, sf_dir):
    return P.outer_indicator(*_copies(spark, sf_dir), ["o_orderkey", "chg_dtm"])


@query(
    f"""{X.EVENT_COPIES_SQL} SELECT concat(coalesce(s.user_id, t.user_id), ',', coalesce(s.event_id, t.event_id)) AS keys,
 coalesce(s.chg_dtm, t.chg_dtm) AS chg_dtm, CASE WHEN t.event_id IS NULL THEN 'Y' ELSE 'N' END AS source_yn
 FROM s FULL JOIN t ON s.user_id = t.user_id AND s.event_id = t.event_id AND s.chg_dtm = t.chg_dtm
 WHERE s.event_id IS NULL OR t.event_id IS NULL"""
)
def one_sided_rows(spark, sf_dir):
    return P.one_sided_rows(X.source_events(spark, sf_dir), X.target_events(spark, sf_dir), X.PAIR_KEYS, "chg_dtm")


@query(
    f"""{X.COPIES_SQL} SELECT o_orderkey, chg_dtm, 'n' AS target_yn, 'y' AS source_yn FROM s
 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t) UNION ALL
 SELECT o_orderkey, chg_dtm, 'y', 'n' FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)"""
)
def key_set_diff(spark, sf_dir):
    return P.key_set_diff(*_copies(spark, sf_dir), X.KEYS, ["chg_dtm"])


@query(f"{X.COPIES_SQL} SELECT o_orderkey FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def deleted_keys(spark, sf_dir):
    return P.deleted_keys(*_copies(spark, sf_dir), X.KEYS)


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE (o_orderkey, o_custkey) NOT IN
 (SELECT l_orderkey, l_suppkey FROM lineitem)"""
)
def keys_not_in(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = X.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey")
    )
    return rows_not_in(orders, lines, ["o_orderkey", "o_custkey"])


def _log(spark, sf_dir):
    return V.verification_log(order_check(spark, sf_dir), X.ORDER_WINDOW, X.BATCH)


@query(
    f"""{X.COPIES_SQL} SELECT l.* FROM ({LOG_SQL}) l WHERE kind = 'source_only'
 AND NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = l.o_orderkey)"""
)
def still_missing(spark, sf_dir):
    log = _log(spark, sf_dir).where(F.col("kind") == "source_only")
    return P.still_missing(log, X.target_orders(spark, sf_dir), X.KEYS, X.BATCH)


@query(
    f"""{X.COPIES_SQL} SELECT l.* FROM ({LOG_SQL}) l WHERE kind = 'target_only'
 AND EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = l.o_orderkey)"""
)
def still_present(spark, sf_dir):
    log = _log(spark, sf_dir).where(F.col("kind") == "target_only")
    return P.still_present(log, X.target_orders(spark, sf_dir), X.KEYS, X.BATCH)


_BAD = f"SELECT o_orderkey FROM ({_CHANGED}) UNION SELECT o_orderkey FROM ({_SOURCE_ONLY})"


@query(f"{X.COPIES_SQL} {_BAD}")
def merged_keys(spark, sf_dir):
    log = _log(spark, sf_dir)
    changed, missing = (log.where(F.col("kind") == kind) for kind in ("changed", "source_only"))
    return P.merged_keys(changed, missing, X.KEYS)


@query(f"{X.COPIES_SQL} SELECT * FROM s WHERE o_orderkey IN ({_BAD})")
def rows_for_keys(spark, sf_dir):
    wanted = _log(spark, sf_dir).where(F.col("kind") != "target_only")
    return P.rows_for_keys(X.source_orders(spark, sf_dir), wanted, X.KEYS)


def _table_log(spark, sf_dir):
    key = F.col("o_orderkey")
    counted = X.table(spark, sf_dir, "orders").groupBy("o_orderpriority", key).agg(
        F.count_if(key % 31 == 0).alias("chg_dtm_diff_count"), F.count_if(key % 47 == 0).alias("source_only_count")
    )
    return counted.select(
        F.lit(X.BATCH).alias("batch_id"),
        F.concat(F.lit("T"), key.cast("string")).alias("table_nm"),
        "chg_dtm_diff_count",
        "source_only_count",
    )


@query(
    """SELECT 'T' || o_orderkey AS table_nm, o_orderstatus AS table_schema FROM orders
 WHERE o_orderkey % 31 = 0 OR o_orderkey % 47 = 0"""
)
def tables_to_repair(spark, sf_dir):
    catalog = X.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("table_schema"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("table_name"),
    )
    return P.tables_to_repair(_table_log(spark, sf_dir), catalog, X.BATCH)


@query(
    """SELECT 'T' || o_orderkey AS table_nm, o_orderstatus AS table_schema FROM orders WHERE o_orderkey % 31 = 0"""
)
def tables_to_repair_changed(spark, sf_dir):
    catalog = X.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("table_schema"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("table_name"),
    )
    return P.tables_to_repair(_table_log(spark, sf_dir), catalog, X.BATCH, with_source_only=False)


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_tables(spark, sf_dir):
    return tables_once(X.table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def set_difference(spark, sf_dir):
    ordered = X.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return P.set_difference(ordered, X.table(spark, sf_dir, "customer").where("c_nationkey < 5"), ["c_custkey"])


@query(
    """SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS chg_text,
 date_diff('second', TIMESTAMP '0001-01-01 00:00:00', ts) AS seconds FROM events"""
)
def second_boundaries(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select(
        "event_id", compact_text(F.col("ts")).alias("chg_text"), second_index(F.col("ts")).alias("seconds")
    )
