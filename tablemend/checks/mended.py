"""Rows at the edges of rules, and whole flows over several tables."""

from __future__ import annotations

import time
import uuid
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemend.checks import fixtures as X
from tablemend.checks.counting import _SUMS
from tablemend.checks.loading import latest_sql, upsert_sql
from tablemend.checks.registry import query
from tablemend.functions.windows import TimeWindow
from tablemend.operators import convert as O
from tablemend.operators import counts as C
from tablemend.operators import ledger as L
from tablemend.plans import catalog as G
from tablemend.plans import load, recompute, verify
from tablemend.session import scratch_path
from tablemend.sinks import files as K
from tablemend.sources import files as S
from tablemend.sources import scans

_HALF_DAY = TimeWindow("1997-06-01 00:00:00", "1997-06-01 12:00:00")


# Sums, days, slices and keys ---------------------------------------------------


@query(
    """SELECT 'lineitem' AS table_name, count(*) AS row_count, 'tiny' AS column_name,
 CAST(round(sum(CAST(l_quantity AS DECIMAL(18,2))) / 100000000, 6) AS DECIMAL(38,6)) AS total FROM lineitem
 UNION ALL SELECT 'lineitem', count(*), 'fine',
 CAST(round(sum(CAST(l_quantity AS DECIMAL(18,2))) / 1000000000, 6) AS DECIMAL(38,6)) FROM lineitem"""
)
def small_sums(spark, sf_dir):
    """Doubles and decimals that are all below a millionth."""
    quantity = F.col("l_quantity")
    fine = quantity.cast("decimal(18,2)") * F.lit("0.000000001").cast("decimal(10,9)")
    rows = X.table(spark, sf_dir, "lineitem").select((quantity / 1e8).alias("tiny"), fine.alias("fine"))
    return C.count_and_sums(rows, "lineitem", ["tiny", "fine"])


@query(
    """SELECT event_id, moved AS ts, CAST(hour(moved) AS INTEGER) AS slice_hour FROM (
 SELECT event_id, CASE WHEN event_id % 7 = 0 THEN date_trunc('day', ts) + INTERVAL 86399500 MILLISECOND ELSE ts END AS moved
 FROM events) WHERE CAST(moved AS DATE) = DATE '2024-01-10'"""
)
def last_second_slices(spark, sf_dir):
    """A seventh of the rows lies half a second before midnight."""
    late = F.date_trunc("day", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz")
    late = late + F.make_dt_interval(secs=F.lit("86399.5").cast("decimal(18,6)"))
    rows = X.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 0, late).otherwise(F.col("ts")).alias("ts")
    )
    return scans.hourly_slices(rows, "ts", "2024-01-10 00:00:00")


@query(
    """SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders"""
)
def replace_days_rows(spark, sf_dir):
    """Equal rows of a mart stay as many as they are, also where two windows share a day."""
    orders = X.table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    windows = spark.sql(
        """SELECT * FROM VALUES ('a', DATE '1997-01-01', DATE '1997-06-30'), ('b', DATE '1997-05-01', DATE '1997-12-31')
 AS w(code, window_start, window_end)"""
    )
    fresh = orders.join(recompute.window_days(windows, "code"), "day")
    stale = orders.withColumn("o_orderpriority", F.lit("old")).where("day BETWEEN '1997-01-01' AND '1997-12-31'")
    rest = orders.where("day NOT BETWEEN '1997-01-01' AND '1997-12-31'")
    return recompute.replace_days(rest.unionByName(stale), fresh, windows, "code")


@query(
    f"""WITH s AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey END AS k, o_orderdate AS c FROM orders
 WHERE o_orderkey % 53 <> 0), t AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey END AS k,
 o_orderdate AS c FROM orders WHERE o_orderkey % 47 <> 0),
 ws AS (SELECT * FROM s WHERE c {X.IN_ORDERS}), wt AS (SELECT * FROM t WHERE c {X.IN_ORDERS})
 SELECT (SELECT count(*) FROM ws) AS source_total_count, (SELECT count(*) FROM wt) AS target_total_count,
 CAST(0 AS BIGINT) AS chg_dtm_diff_count,
 (SELECT count(*) FROM ws WHERE NOT EXISTS (SELECT 1 FROM wt WHERE wt.k = ws.k)
  AND date_trunc('second', c) < (SELECT max(c) FROM t)) AS source_only_count,
 (SELECT count(*) FROM wt WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = wt.k
  AND s.c >= TIMESTAMP '1997-01-01 00:00:00')) AS target_only_count,
 (SELECT max(date_trunc('second', c)) FROM ws) AS temp_max_chg_dtm"""
)
def null_key_differences(spark, sf_dir):
    """A tenth of the rows of both copies has no key; each of them counts."""

    def copy(rest: int):
        key = F.col("o_orderkey")
        rows = X.table(spark, sf_dir, "orders").where(key % rest != 0)
        return rows.select(F.when(key % 10 != 0, key).alias("k"), F.col("o_orderdate").alias("chg_dtm"))

    return L.difference_counts(copy(53), copy(47), ["k"], "chg_dtm", X.ORDER_WINDOW)


# Upserts -----------------------------------------------------------------------


@query(
    f"""{X.COPIES_SQL}, v AS (SELECT * FROM ({X.DUPLICATES_SQL})
 WHERE chg_dtm BETWEEN TIMESTAMP '1997-06-01 00:00:00' AND TIMESTAMP '1997-06-01 12:00:00')
 {upsert_sql('SELECT * FROM t', latest_sql('SELECT * FROM v'))}"""
)
def upsert_day_window(spark, sf_dir):
    """Half a day of changes out of all of them."""
    target, staged = X.target_orders(spark, sf_dir), X.versioned_orders(spark, sf_dir)
    return load.incremental_load(target, staged, X.KEYS, "chg_dtm", _HALF_DAY)


@query(
    f"""{X.COPIES_SQL}, c AS (SELECT * FROM s WHERE chg_dtm {X.IN_ORDERS})
 {upsert_sql('SELECT * FROM t', 'SELECT * FROM c')}"""
)
def upsert_null_partition(spark, sf_dir):
    """A quarter of the rows belongs to no month; changes find them by their key."""
    month = F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "yyyyMM")).alias("ym")
    held = X.table(spark, sf_dir, "orders").select("o_orderkey", month)
    target = X.target_orders(spark, sf_dir).join(held, "o_orderkey")
    changes = X.source_orders(spark, sf_dir).where(X.ORDER_WINDOW.holds(F.col("chg_dtm"))).join(held, "o_orderkey")
    path = scratch_path(spark, "months")
    target.hint("rebalance", "ym").write.partitionBy("ym").parquet(path)
    load.upsert_partitions(spark, path, changes, X.KEYS, "ym", scratch_path(spark, "months-staging"))
    return spark.read.parquet(path).select(*target.columns).drop("ym")


# Files and tables --------------------------------------------------------------


@query(
    """SELECT c_custkey, c_name || chr(10) || c_mktsegment AS c_label, c_nationkey FROM customer WHERE c_custkey % 5 <> 0"""
)
def csv_quoted_breaks(spark, sf_dir):
    """Every quoted label holds a line break; every fifth record has a field too many."""
    label = F.concat(F.lit('"'), "c_name", F.lit("\n"), "c_mktsegment", F.lit('"'))
    more = F.when(F.col("c_custkey") % 5 == 0, ",more").otherwise("")
    record = F.concat(F.concat_ws(",", "c_custkey", label, "c_nationkey"), more)
    path = scratch_path(spark, "breaks")
    X.table(spark, sf_dir, "customer").select(record.alias("value")).write.text(path)
    schema = T._parse_datatype_string("c_custkey long, c_label string, c_nationkey int")
    return S.read_csv_skip_bad(spark, f"{path}/*.txt", schema, breaks=True)


_LEGACY = "가나다"


@query(f"SELECT c_custkey, '{_LEGACY}' || c_name AS c_name FROM customer")
def decode_legacy(spark, sf_dir):
    """Names as bytes, one half UTF-8, the other EUC-KR."""
    name = F.concat(F.lit(_LEGACY), "c_name")
    # EUC-KR of the fixed prefix; the rest is ASCII and the same in both.
    legacy = F.concat(F.unhex(F.lit(_LEGACY.encode("euc-kr").hex())), F.col("c_name").cast("binary"))
    raw = F.when(F.col("c_custkey") % 2 == 0, name.cast("binary")).otherwise(legacy)
    return X.table(spark, sf_dir, "customer").select("c_custkey", S.decode_with_fallback(raw).alias("c_name"))


@query("SELECT count(*) AS n, true AS bounded, count(*) > 2000 AS several FROM orders")
def chunk_sizes(spark, sf_dir):
    """No file holds more rows than asked for."""
    path = scratch_path(spark, "chunks")
    K.write_chunks(X.table(spark, sf_dir, "orders"), path, 2000)
    files = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("rows"))
    return files.agg(
        F.sum("rows").alias("n"), (F.max("rows") <= 2000).alias("bounded"), (F.count("*") > 1).alias("several")
    )


@query(
    """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 'X' ELSE event_type END AS event_type, ts,
 CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events"""
)
def landing_days(spark, sf_dir):
    """A folder for every day, some of them written twice."""
    base = scratch_path(spark, "days")
    rows = X.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    K.write_landing_by_day(rows, base, "app", "events", "ts")
    again = rows.where("ts >= TIMESTAMP_NTZ '2024-01-20'").withColumn("event_type", F.lit("X"))
    return spark.read.parquet(K.write_landing_by_day(again, base, "app", "events", "ts"))


_MONTHS = "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS bsic_ym FROM orders"


@query(
    f"""SELECT * FROM ({_MONTHS}) WHERE bsic_ym NOT BETWEEN '199703' AND '199706'
 UNION ALL SELECT o_orderkey, o_totalprice + 1, bsic_ym FROM ({_MONTHS}) WHERE bsic_ym BETWEEN '199704' AND '199706'"""
)
def delete_window_table(spark, sf_dir):
    """A table partitioned by month: a range of months is deleted, some of them are loaded again."""
    months = X.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("bsic_ym")
    )
    table = f"months_{uuid.uuid4().hex}"
    months.hint("rebalance", "bsic_ym").write.partitionBy("bsic_ym").format("parquet").option(
        "path", scratch_path(spark, "months-table")
    ).saveAsTable(table)
    fresh = months.where(F.col("bsic_ym").between("199704", "199706"))
    fresh = fresh.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    K.delete_window_insert(spark, table, fresh, "bsic_ym", "199703", "199706")
    return spark.table(table)


# Catalogs ----------------------------------------------------------------------


def _opener(spark, sf_dir):
    def customers(rest: int):
        key = F.col("c_custkey")
        day = F.lit("1998-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(key % 200).cast("int"))
        rows = X.table(spark, sf_dir, "customer").where(key % rest != 0)
        return rows.select("c_custkey", "c_name", day.alias("chg_dtm"))

    copies = {
        "sales.orders": (X.source_orders(spark, sf_dir), X.target_orders(spark, sf_dir)),
        "sales.customer": (customers(13), customers(11)),
        "app.events": (X.source_events(spark, sf_dir), X.target_events(spark, sf_dir)),
    }

    def open_table(name: str, keys: list[str]) -> verify.TableCheck:
        source, target = copies[name]
        return verify.TableCheck(*name.split("."), source, target, keys, "chg_dtm")

    return open_table


def _keys(spark):
    return spark.createDataFrame(
        [
            ("sales", "orders", "o_orderkey", 1, "Y"),
            ("sales", "customer", "c_custkey", 1, "Y"),
            ("app", "events", "user_id", 1, "Y"),
            ("app", "events", "event_id", 2, "Y"),
            ("app", "gone", "id", 1, "Y"),
            ("app", "skipped", "id", 1, "N"),
        ],
        "owner string, table_name string, column_name string, ordinal_position int, verification_yn string",
    )


_EVER = TimeWindow("1990-01-01 00:00:00", "2030-01-01 00:00:00")


def _only_sql(name: str, source: str, target: str, keys: list[str], target_only: bool) -> str:
    """Kinds and numbers of the differences of one table over all times."""
    match = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    newest = f"(SELECT max(chg_dtm) FROM ({target}))"
    parts = [
        f"""SELECT '{name}' AS table_nm, 'target_only' AS kind, count(*) AS n FROM ({target}) t
 WHERE NOT EXISTS (SELECT 1 FROM ({source}) s WHERE {match})"""
    ]
    if not target_only:
        parts += [
            f"""SELECT '{name}', 'source_only', count(*) FROM ({source}) s WHERE NOT EXISTS (SELECT 1 FROM ({target}) t
 WHERE {match}) AND date_trunc('second', s.chg_dtm) < {newest}""",
            f"""SELECT '{name}', 'changed', count(*) FROM ({source}) s JOIN ({target}) t ON {match}
 WHERE date_trunc('second', s.chg_dtm) <> date_trunc('second', t.chg_dtm) AND date_trunc('second', s.chg_dtm) <= {newest}""",
        ]
    return " UNION ALL ".join(parts)


def _customer_sql(rest: int) -> str:
    return f"""SELECT c_custkey, TIMESTAMP '1998-01-01' + (c_custkey % 200) * INTERVAL 1 DAY AS chg_dtm
 FROM customer WHERE c_custkey % {rest} <> 0"""


_EVENT_SOURCE = "SELECT user_id, event_id, ts AS chg_dtm FROM events WHERE event_id % 53 <> 0"
_EVENT_TARGET = """SELECT user_id, event_id, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 700 MILLISECOND ELSE ts END
 AS chg_dtm FROM events WHERE event_id % 47 <> 0"""


def _catalog_sql(target_only: bool) -> str:
    tables = [
        ("sales.orders", X.SOURCE_SQL, X.TARGET_SQL, ["o_orderkey"]),
        ("sales.customer", _customer_sql(13), _customer_sql(11), ["c_custkey"]),
        ("app.events", _EVENT_SOURCE, _EVENT_TARGET, ["user_id", "event_id"]),
    ]
    union = " UNION ALL ".join(_only_sql(*t, target_only) for t in tables)
    return f"SELECT * FROM ({union}) WHERE n > 0"


def _logged(spark, sf_dir, open_table, batch: str):
    path = scratch_path(spark, "catalog-log")
    status = G.check_all(spark, _keys(spark), open_table, _EVER, batch, path)
    return status, path


@query(
    f"""{_catalog_sql(False)}
 UNION ALL SELECT 'app.gone', 'failed', 1"""
)
def verify_catalog(spark, sf_dir):
    """Three tables with different keys; a fourth cannot be opened and is reported."""
    status, path = _logged(spark, sf_dir, _opener(spark, sf_dir), "b1")
    found = G.read_log(spark, path, "b1").groupBy("table_nm", "kind").agg(F.count("*").alias("n"))
    failed = status.where("status = 'failed'").select("table_nm", "status", F.lit(1).cast("long"))
    return found.union(failed)


_SLOW_SECONDS, _LIMIT_SECONDS = 90, 30


def _slow(rows):
    """The rows, by a single task that takes far longer than any limit."""

    def wait(batches):
        time.sleep(_SLOW_SECONDS)
        yield from batches

    return rows.coalesce(1).mapInArrow(wait, rows.schema)


@query(
    f"""{_catalog_sql(False)}
 UNION ALL SELECT 'app.gone', 'failed', 1 UNION ALL SELECT 'app.slow', 'timed out', 1"""
)
def verify_catalog_pools(spark, sf_dir):
    """Two schemas side by side: a table that cannot be opened and one that takes too long are reported, the rest completes."""
    opened = _opener(spark, sf_dir)

    def open_table(name, keys):
        if name != "app.slow":
            return opened(name, keys)
        check = opened("app.events", ["user_id", "event_id"])
        return replace(check, source=_slow(check.source))

    catalog = _keys(spark).union(spark.createDataFrame([("app", "slow", "event_id", 1, "Y")], _keys(spark).schema))
    path = scratch_path(spark, "pools-log")
    status = G.check_all(spark, catalog, open_table, _EVER, "b4", path, side_by_side=2, seconds=_LIMIT_SECONDS)
    found = G.read_log(spark, path, "b4").groupBy("table_nm", "kind").agg(F.count("*").alias("n"))
    return found.union(status.where("status <> 'done'").select("table_nm", "status", F.lit(1).cast("long")))


@query(_catalog_sql(True))
def repair_catalog(spark, sf_dir):
    """After the repair of all tables only keys of the target alone are left."""
    open_table = _opener(spark, sf_dir)
    _, log_path = _logged(spark, sf_dir, open_table, "b2")
    path = scratch_path(spark, "catalog-repaired")
    G.repair_all(spark, log_path, _keys(spark), open_table, "b2", path)
    again, log_path = _logged(
        spark, sf_dir, lambda name, keys: G.repaired(spark, open_table(name, keys), name, path), "b3"
    )
    return G.read_log(spark, log_path, "b3").groupBy("table_nm", "kind").agg(F.count("*").alias("n"))


_CHECKS = [("mart", "lineitem"), ("mart", "orders"), ("mart", "customer")]


def _log_profiles(spark, sf_dir):
    counted = spark.createDataFrame(
        [(*t, "Y", "N") for t in _CHECKS] + [("mart", "part", "N", "N")],
        "schema_name string, table_name string, verification_yn string, etl_dtm_exist_yn string",
    )
    summed = spark.createDataFrame(
        [("mart", "lineitem", c, "Y", "N") for c in _SUMS] + [("mart", "orders", "o_totalprice", "Y", "N")],
        "schema_name string, table_name string, column_name string, sum_check_yn string, etl_dtm_exist_yn string",
    )
    catalog = C.check_catalog(counted, summed, "N")
    lines, customer = X.table(spark, sf_dir, "lineitem"), X.table(spark, sf_dir, "customer")
    source = {"lineitem": lines, "orders": X.source_orders(spark, sf_dir), "customer": customer}
    target = {
        "lineitem": lines.where("l_returnflag <> 'R'"),
        "orders": X.target_orders(spark, sf_dir),
        "customer": customer.where("c_nationkey <> 3"),
    }
    return [C.catalog_profiles(catalog, lambda name, t=t: t[name.split(".")[1]]) for t in (source, target)]


_PAIRS = [
    ("lineitem", "SELECT * FROM lineitem", "SELECT * FROM lineitem WHERE l_returnflag <> 'R'", _SUMS),
    ("orders", X.SOURCE_SQL, X.TARGET_SQL, ["o_totalprice"]),
    ("customer", "SELECT * FROM customer", "SELECT * FROM customer WHERE c_nationkey <> 3", []),
]
_HEAD = "SELECT '20240201' AS verify_date, 'DW' AS database_name, 'mart' AS schema_name"


@query(
    " UNION ALL ".join(
        f"""{_HEAD}, '{name}' AS table_name, 'N' AS etl_dtm_exist_yn, (SELECT count(*) FROM ({a})) AS source_cnt,
 (SELECT count(*) FROM ({b})) AS target_cnt,
 (SELECT count(*) FROM ({a})) - (SELECT count(*) FROM ({b})) AS source_minus_target_cnt"""
        for name, a, b, _ in _PAIRS
    )
)
def count_log(spark, sf_dir):
    return C.count_log(*_log_profiles(spark, sf_dir), "20240201", "DW", "N")


def _sum_sql(rows: str, column: str) -> str:
    return f"(SELECT CAST(round(sum(CAST({column} AS DECIMAL(28,6))), 3) AS DECIMAL(38,3)) FROM ({rows}))"


@query(
    " UNION ALL ".join(
        f"""{_HEAD}, '{name}' AS table_name, '{c}' AS column_name, 'N' AS etl_dtm_exist_yn,
 {_sum_sql(a, c)} AS source_sum, {_sum_sql(b, c)} AS target_sum,
 CAST({_sum_sql(a, c)} - {_sum_sql(b, c)} AS DECIMAL(38,3)) AS source_minus_target_sum"""
        for name, a, b, columns in _PAIRS
        for c in columns
    )
)
def sum_log(spark, sf_dir):
    return C.sum_log(*_log_profiles(spark, sf_dir), "20240201", "DW", "N")


@query(
    f"""SELECT site, call_id, mesg, q_wait_time, n FROM (
 SELECT CASE c_custkey % 2 WHEN 0 THEN 'A' ELSE 'B' END AS site, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS long_id,
 '{_LEGACY}' || c_name AS mesg, CAST(c_custkey % 600 AS VARCHAR) AS q_wait_time, CAST(2 AS BIGINT) AS n,
 substr(concat('#', lpad(CAST(c_custkey AS VARCHAR), 8, '0')), 2, 5) AS call_id FROM customer WHERE c_custkey % 5 <> 0)"""
)
def call_log_load(spark, sf_dir):
    """Logs of two sites in two encodings, with bad lines and three columns too many, loaded twice."""
    base = scratch_path(spark, "calls")
    log = X.call_log(spark, sf_dir).withColumn("mesg", F.concat(F.lit(_LEGACY), "mesg"))
    number = F.substring("call_id", 2, 8).cast("long")
    surplus = F.when(number % 5 == 0, ",x,y,z,one more").otherwise(",x,y,z")
    line = F.concat(F.concat_ws(",", *O.CALL_LOG_COLUMNS), surplus).alias("value")
    log.where(number % 2 == 0).select(line).write.text(f"{base}/A")
    log.where(number % 2 == 1).select(line).write.option("encoding", "EUC-KR").text(f"{base}/B")
    fields = T._parse_datatype_string(", ".join(f"{c} string" for c in [*O.CALL_LOG_COLUMNS, "x", "y", "z"]))
    sites = {s: O.drop_trailing(S.read_log_csv(spark, f"{base}/{s}", fields), 3, list(O.CALL_LOG_COLUMNS)) for s in "AB"}
    loaded = O.site_logs(sites, "240201", "20240201070000")
    target = scratch_path(spark, "calls-loaded")
    K.append_batches(loaded, target)
    K.append_batches(loaded, target)
    rows = spark.read.parquet(target).groupBy(F.col("acd").alias("site"), "call_id", "mesg", "q_wait_time")
    return rows.agg(F.count("*").alias("n"))



# Files, layers -----------------------------------------------------------------


@query(
    """SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS files_cnt,
 (SELECT count(*) FROM orders WHERE o_orderkey % 53 <> 0) AS source_cnt,
 (SELECT count(*) FROM orders WHERE o_orderkey % 47 <> 0) AS target_cnt,
 (SELECT count(*) FROM orders) - (SELECT count(*) FROM orders WHERE o_orderkey % 53 <> 0) AS files_minus_source_cnt,
 (SELECT count(*) FROM orders WHERE o_orderkey % 53 <> 0) - (SELECT count(*) FROM orders WHERE o_orderkey % 47 <> 0)
 AS source_minus_target_cnt,
 (SELECT count(*) FROM orders) - (SELECT count(*) FROM orders WHERE o_orderkey % 47 <> 0) AS files_minus_target_cnt
 UNION ALL SELECT 'customer', count(*), count(*), count(*), 0, 0, 0 FROM customer"""
)
def compare_with_files(spark, sf_dir):
    """Landing files of two runs are counted by their footers and compared with both copies."""
    path = scratch_path(spark, "landed-orders")
    orders = X.table(spark, sf_dir, "orders")
    K.replace_prefix(orders.where("o_orderkey % 2 = 0"), f"{path}/2024/01/01")
    K.replace_prefix(orders.where("o_orderkey % 2 = 1"), f"{path}/2024/01/02")
    customer, customer_path = X.table(spark, sf_dir, "customer"), scratch_path(spark, "landed-customer")
    K.replace_prefix(customer, f"{customer_path}/2024/01/01")
    files = S.count_files(spark, path, "orders").unionByName(S.count_files(spark, customer_path, "customer"))
    source = C.table_profiles({"orders": X.source_orders(spark, sf_dir), "customer": customer})
    target = C.table_profiles({"orders": X.target_orders(spark, sf_dir), "customer": customer})
    return C.compare_three(files, source, target)


_LOAD_DAY = "ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-10 23:59:59'"
_LAYERS = [
    ("events", f"SELECT * FROM events WHERE {_LOAD_DAY}", f"SELECT * FROM events WHERE event_id % 47 <> 0 AND {_LOAD_DAY}", "value"),
    ("orders", X.SOURCE_SQL, X.TARGET_SQL, "o_totalprice"),
]


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name, {_sum_sql(a, c)} AS source_sum, {_sum_sql(b, c)} AS target_sum,
 CAST({_sum_sql(a, c)} - {_sum_sql(b, c)} AS DECIMAL(38,3)) AS source_minus_target_sum"""
        for name, a, b, c in _LAYERS
    )
)
def compare_layer_sums(spark, sf_dir):
    """Sums of two layers: one table as a whole, of the other the rows of a load day."""
    events = X.table(spark, sf_dir, "events")
    layers = [
        {"events": events, "orders": X.source_orders(spark, sf_dir)},
        {"events": events.where("event_id % 47 <> 0"), "orders": X.target_orders(spark, sf_dir)},
    ]
    sums = {"events": ["value"], "orders": ["o_totalprice"]}
    profiles = [C.table_profiles(t, sums, {"events": "ts"}, "2024-01-10 07:00:00") for t in layers]
    return C.compare_sums(*profiles)
