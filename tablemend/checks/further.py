"""Streams that keep state, split records, digests, ranges, sums by file, partial events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablemend.checks import fixtures as X
from tablemend.checks.comparison import order_check
from tablemend.checks.loading import latest_sql, upsert_sql
from tablemend.checks.registry import ORACLES, query
from tablemend.operators import counts as C
from tablemend.operators import digests as D
from tablemend.operators import upsert as U
from tablemend.operators.dedupe import latest_per_key
from tablemend.session import materialize, scratch_path
from tablemend.sinks import files as K
from tablemend.sources import files as S
from tablemend.sources import ranges as R
from tablemend.streaming import jobs


@query(f"{X.COPIES_SQL}, v AS ({X.DUPLICATES_SQL}) {upsert_sql('SELECT * FROM t', latest_sql('SELECT * FROM v'))}")
def stream_out_of_order(spark, sf_dir):
    """Newer versions are streamed and folded into a new target; older ones that come afterwards undo none of them."""
    staged = X.versioned_orders(spark, sf_dir)
    landed, changes, state, folder = (scratch_path(spark, n) for n in ("landed", "changes", "newest-state", "folded"))
    target, last = X.target_orders(spark, sf_dir), None
    for version in ("o_orderstatus = 'V'", "o_orderstatus <> 'V'"):
        staged.where(version).repartition(2).write.mode("append").parquet(landed)
        landing = jobs.landing_stream(spark, landed, staged.schema, files_per_batch=1)
        jobs.stream_newest(landing, X.KEYS, ["chg_dtm"], changes, state).awaitTermination()
        if last is None:
            last = jobs.compact_changes(target, spark.read.parquet(changes), X.KEYS, ["chg_dtm"], folder)
            target = spark.read.schema(target.schema).parquet(folder)
    return jobs.current_table(target, jobs.changes_after(spark.read.parquet(changes), last), X.KEYS, ["chg_dtm"])


@query(
    f"""WITH f AS (SELECT event_id, pgmid, time_bucket(INTERVAL 10 MINUTE, endtime) AS w, endtime FROM ({X.RUNS_SQL}) WHERE st = 'ER'),
 mark AS (SELECT max(endtime) - INTERVAL 1 DAY AS m FROM f WHERE event_id % 2 = 0),
 told AS (SELECT f.*, event_id % 2 = 1 AND w + INTERVAL 10 MINUTE <= m AS late FROM f, mark)
 SELECT CASE WHEN late THEN 'late' ELSE 'counted' END AS kind, w AS window_start, pgmid, count(*) AS n FROM told GROUP BY ALL"""
)
def stream_late_log(spark, sf_dir):
    """Half of the runs arrive after the others; what is more than a day late is kept apart, and nothing is lost."""
    runs = X.job_runs(spark, sf_dir).select("event_id", "pgmid", "endtime", "st")
    landed, folder, state = (scratch_path(spark, n) for n in ("late-runs", "late-log", "log-state"))
    for half in (0, 1):
        runs.where(f"event_id % 2 = {half}").repartition(1).write.mode("append").parquet(landed)
        landing = jobs.landing_stream(spark, landed, runs.schema, files_per_batch=1)
        jobs.stream_late_log(landing, "endtime", "10 minutes", "1 day", folder, state).awaitTermination()
    counted = jobs.counted_windows(spark.read.parquet(f"{folder}/counts"))
    late = jobs.error_counts(spark.read.parquet(f"{folder}/late"), "endtime", "10 minutes")
    both = [
        rows.select(F.lit(kind).alias("kind"), "window_start", "pgmid", F.col("error_count").alias("n"))
        for kind, rows in (("counted", counted), ("late", late))
    ]
    return both[0].unionByName(both[1])


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || chr(10) || 'said "' || c_mktsegment || '",' || chr(10) || chr(10) || 'end'
 ELSE c_name END AS c_name, c_nationkey FROM customer WHERE c_custkey % 50 <> 7"""
)
def csv_split_breaks(spark, sf_dir):
    """One file read in several tasks: every third name spans four lines, one record in fifty has a quote never closed."""
    customers = X.table(spark, sf_dir, "customer")
    inside = F.concat("c_name", F.lit('\nsaid ""'), "c_mktsegment", F.lit('"",\n\nend'))
    name = (
        F.when(F.col("c_custkey") % 50 == 7, F.concat(F.lit('"'), "c_name"))
        .when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('"'), inside, F.lit('"')))
        .otherwise(F.col("c_name"))
    )
    path = scratch_path(spark, "one-file")
    lines = customers.select(F.concat_ws(",", "c_custkey", name, "c_nationkey").alias("value"))
    lines.coalesce(1).write.text(path)
    schema = customers.select("c_custkey", "c_name", "c_nationkey").schema
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        return materialize(S.read_csv_skip_bad(spark, path, schema, breaks=True), "records")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query(ORACLES["all_differences"])
def digest_differences(spark, sf_dir):
    check = order_check(spark, sf_dir)
    return D.digest_differences(check.source, check.target, X.KEYS, "chg_dtm", X.ORDER_WINDOW, check.deletes)


@query("SELECT count(*) AS n_rows, count(*) AS in_one_range, true AS even FROM lineitem")
def equal_ranges(spark, sf_dir):
    """Sixteen ranges of a skewed key, null in one row of sixteen: each row in one range, none twice the mean."""
    key = F.when(F.col("l_orderkey") % 16 != 0, F.pow(F.col("l_orderkey"), F.lit(3.0)) * F.col("l_linenumber")).alias("k")
    rows = X.table(spark, sf_dir, "lineitem").select(key)
    ranges = R.key_ranges(rows, "k", 16)
    matched = sum((F.when(F.expr(r), 1).otherwise(0) for r in ranges), F.lit(0))
    number = F.coalesce(*[F.when(F.expr(r), i) for i, r in enumerate(ranges)])
    counted = rows.select(matched.alias("matched"), number.alias("number")).groupBy("number").agg(
        F.count("*").alias("n"), F.count_if(F.col("matched") == 1).alias("once")
    )
    return counted.agg(
        F.sum("n").alias("n_rows"),
        F.sum("once").alias("in_one_range"),
        (F.max("n") <= 2 * F.sum("n") / F.lit(len(ranges))).alias("even"),
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 3")
def stream_after_key(spark, sf_dir):
    """Three runs of one stream, with rows of greater keys added before each."""
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").where("o_orderkey % 7 <> 3")
    top = orders.agg(F.max("o_orderkey")).first()[0] or 0
    landed, out, state = (scratch_path(spark, n) for n in ("by-key", "after-key", "key-state"))
    for third in range(3):
        low, high = top * third // 3 - (third == 0), top * (third + 1) // 3
        part = orders.where((F.col("o_orderkey") > low) & (F.col("o_orderkey") <= high))
        part.repartition(3).write.mode("append").parquet(landed)
        rows = R.stream_after_key(spark, landed, orders.schema, "o_orderkey")
        writer = rows.writeStream.format("parquet").option("checkpointLocation", state)
        writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(orders.schema).parquet(out)


@query(
    """SELECT 'orders' AS table_name, count(*) AS row_count,
 sum(CAST(CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18, 6))) AS sum_o_totalprice
 FROM orders WHERE o_orderkey % 4 <> 0"""
)
def incremental_sums(spark, sf_dir):
    """Sums kept by file over two runs, between which files are added, replaced and emptied."""
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "summed")

    def put(rest: int, rows) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/part{rest}")

    for rest in (0, 1, 2):
        put(rest, orders.where(f"o_orderkey % 4 = {rest}"))
    known = materialize(C.refreshed_file_sums(spark, path, ["o_totalprice"]), "file-sums")
    put(0, orders.limit(0))
    put(1, orders.where("o_orderkey % 4 = 1").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    put(3, orders.where("o_orderkey % 4 = 3"))
    return C.total_of_files(C.refreshed_file_sums(spark, path, ["o_totalprice"], known), "orders")


@query(f"{X.COPIES_SQL}, v AS ({X.DUPLICATES_SQL}) {upsert_sql('SELECT * FROM t', latest_sql('SELECT * FROM v'))}")
def upsert_bucketed(spark, sf_dir):
    """Latest versions into a target of sixteen buckets."""
    table = f"bucketed_{uuid.uuid4().hex}"
    K.write_bucketed(X.target_orders(spark, sf_dir), table, X.KEYS, 16, scratch_path(spark, "bucketed"))
    changes = latest_per_key(X.versioned_orders(spark, sf_dir), X.KEYS, ["chg_dtm"])
    return U.upsert_bucketed(spark.table(table), changes, X.KEYS)


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def appended_runs(spark, sf_dir):
    """Two runs, the first of them repeated."""
    path = scratch_path(spark, "runs-appended")
    rows = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for run, part in (("a", rows.limit(10)), ("b", rows.where("o_orderstatus = 'F'")), ("a", rows)):
        K.append_run(part, path, run)
    return spark.read.parquet(path).drop("run")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def resumed_load(spark, sf_dir):
    """A load in eight key ranges that was cut off after three of them and is taken up again."""
    rows = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path, ranges = scratch_path(spark, "resumed"), R.key_ranges(rows, "o_orderkey", 8)
    K.load_missing(rows, ranges[:3], path)
    if K.load_missing(rows, ranges, path) != list(range(3, len(ranges))):
        raise ValueError("complete ranges were loaded again")
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


_PARTIAL_SQL = f"""{X.COPIES_SQL}, k AS (SELECT o_orderkey, o_orderkey % 3 = 0 AS d, o_orderkey % 2 = 0 AS e1,
 o_orderkey % 5 = 0 AS e3, o_orderkey % 7 = 0 AS e4 FROM orders)
 SELECT k.o_orderkey, CASE WHEN NOT d THEN t.o_custkey END AS o_custkey,
 CASE WHEN e4 THEN 'N' WHEN NOT d THEN t.o_orderstatus END AS o_orderstatus,
 CASE WHEN e3 THEN 1 WHEN NOT d THEN t.o_totalprice END AS o_totalprice,
 CASE WHEN e4 OR d THEN NULL WHEN e1 THEN 'P1' ELSE t.o_orderpriority END AS o_orderpriority,
 CASE WHEN NOT d THEN t.chg_dtm END AS chg_dtm
 FROM k LEFT JOIN t ON t.o_orderkey = k.o_orderkey
 WHERE e3 OR e4 OR (NOT d AND (e1 OR t.o_orderkey IS NOT NULL))"""


@query(_PARTIAL_SQL)
def apply_partial_events(spark, sf_dir):
    """An update, a delete, another update and an insert of a key, each of some keys and with some columns."""
    orders = X.table(spark, sf_dir, "orders")
    none = F.lit(None).cast("string")

    def events(rest: int, place: int, op: str, sets: list[str], status=none, price=None, priority=none):
        return orders.where(F.col("o_orderkey") % rest == 0).select(
            "o_orderkey",
            F.lit(place).alias("place"),
            F.lit(op).alias("op"),
            F.array(*map(F.lit, sets)).cast("array<string>").alias("sets"),
            status.alias("o_orderstatus"),
            F.lit(price).cast(orders.schema["o_totalprice"].dataType).alias("o_totalprice"),
            priority.alias("o_orderpriority"),
        )

    queue = (
        events(2, 1, "U", ["o_orderpriority"], priority=F.lit("P1"))
        .union(events(3, 2, "D", []))
        .union(events(5, 3, "U", ["o_totalprice"], price=1))
        .union(events(7, 4, "I", ["o_orderstatus", "o_orderpriority"], status=F.lit("N")))
    )
    columns = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    return U.apply_partial_events(X.target_orders(spark, sf_dir), queue, X.KEYS, ["place"], columns)
