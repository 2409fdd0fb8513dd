"""Split records, late versions, digests, ranges, sums by file, partial events, catalogs side by side."""

import csv
import io
import random
import re
import time

import pytest
from frames import at, rows
from pyspark.sql import functions as F

from tablemend.functions.windows import TimeWindow
from tablemend.operators import counts, digests, ledger, upsert
from tablemend.plans import catalog
from tablemend.plans.verify import TableCheck
from tablemend.session import materialize, scratch_path
from tablemend.sources import files, ranges, records
from tablemend.streaming import jobs

EVER = TimeWindow("1990-01-01 00:00:00", "2030-01-01 00:00:00")


def written(spark, text, split):
    """Records of one file read in splits of some bytes."""
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for n in before:
            spark.conf.set(n, str(split))
        return [r.value for r in records.csv_records(spark, path).collect()]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


@pytest.mark.parametrize(("seed", "split"), [(1, 40), (2, 150), (3, 10**6)])
def test_split_records_against_a_plain_reader(spark, seed, split):
    rng = random.Random(seed)
    table = []
    for i in range(120):
        cell = "".join(rng.choice(["a", "b", ",", "\n", '"', " "]) for _ in range(rng.randint(0, 12)))
        table.append([str(i), cell, rng.choice(["x", "y\nz", ""])])
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(table)
    found = written(spark, out.getvalue().rstrip("\n"), split)
    parsed = sorted((next(csv.reader(io.StringIO(r, newline=""))) for r in found if r), key=lambda r: int(r[0]))
    assert parsed == table


@pytest.mark.parametrize("split", [12, 30, 10**6])
def test_an_open_quote_costs_its_own_record(spark, split):
    text = '1,"ab,5\n2,"c\nd",6\n3,e,7\n4,"f,8\n5,g,9\n6,"h""i",1\n7,"j\n\n"",k",2\n8,"l,3'
    assert sorted(r for r in written(spark, text, split) if r) == [
        '2,"c\nd",6', "3,e,7", "5,g,9", '6,"h""i",1', '7,"j\n\n"",k",2',
    ]


def test_records_of_a_file_come_from_several_tasks(spark):
    path = scratch_path(spark, "split")
    spark.range(4000).selectExpr("concat(id, ',\"a\nb\"') AS value").coalesce(1).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        got = files.read_csv_skip_bad(spark, path, spark.range(0).selectExpr("id AS k", "'' AS v").schema, True)
        assert got.where("v = 'a\nb'").count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_late_older_version_undoes_nothing(spark):
    schema = "k long, v string, t timestamp_ntz"
    land, changes, state, folder = (scratch_path(spark, n) for n in ("o-land", "o-changes", "o-state", "o-folded"))
    target = spark.createDataFrame([(1, "old", at("2024-01-01"))], schema)

    def stream(values):
        spark.createDataFrame(values, schema).write.mode("append").parquet(land)
        jobs.stream_newest(jobs.landing_stream(spark, land, target.schema), ["k"], ["t"], changes, state).awaitTermination()

    stream([(1, "new", at("2024-01-09")), (2, None, None), (None, "no key", at("2024-01-02"))])
    last = jobs.compact_changes(target, spark.read.parquet(changes), ["k"], ["t"], folder)
    stream([(1, "stale", at("2024-01-05")), (2, "timed", at("2020-01-01")), (3, "c", None)])
    folded = spark.read.schema(target.schema).parquet(folder)
    got = jobs.current_table(folded, jobs.changes_after(spark.read.parquet(changes), last), ["k"], ["t"])
    assert rows(got, "k", "v") == sorted([(1, "new"), (2, "timed"), (3, "c"), (None, "no key")], key=repr)


def test_late_rows_are_kept_apart_when_a_batch_runs_again(spark):
    schema = "pgmid string, endtime timestamp_ntz, st string"
    land, folder, state = (scratch_path(spark, n) for n in ("l-land", "l-folder", "l-state"))
    parts = [[("P", "2024-01-02 00:05:00"), ("P", "2024-01-04 00:00:00")], [("P", "2024-01-02 00:01:00"), ("Q", None)]]
    for part in parts:
        values = [(p, t and at(t), "ER") for p, t in part]
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(land)
        stream = jobs.landing_stream(spark, land, spark.createDataFrame([], schema).schema)
        jobs.stream_late_log(stream, "endtime", "10 minutes", "1 day", folder, state).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/late"), "pgmid", "endtime") == sorted(
        [("P", at("2024-01-02 00:01:00")), ("Q", None)], key=repr
    )
    assert rows(jobs.counted_windows(spark.read.parquet(f"{folder}/counts")), "error_count") == [(1,), (1,)]


def copies(spark):
    def side(n, late, missing):
        base = spark.range(n).where(f"id % 1000 <> {missing}")
        time_ = F.expr(f"TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, IF(id % 1500 = {late}, 1, 0))")
        return base.select((F.col("id") % 77).alias("a"), F.col("id").alias("b"), time_.alias("t"))

    holes = spark.createDataFrame([(None, 1, at("2024-01-01")), (1, None, at("2023-01-01"))], "a long, b long, t timestamp_ntz")
    return side(20_000, 3, 5).unionByName(holes), side(20_000, 4, 6).unionByName(holes)


@pytest.mark.parametrize("levels", [(8, 14), (1,), (2, 4, 20)])
def test_digests_find_all_differences(spark, levels):
    source, target = (materialize(c, "copy") for c in copies(spark))
    want = rows(ledger.all_differences(source, target, ["a", "b"], "t", EVER))
    assert len(want) > 50
    assert rows(digests.digest_differences(source, target, ["a", "b"], "t", EVER, levels=levels)) == want


def test_equal_copies_shuffle_buckets_only(spark):
    source = materialize(copies(spark)[0].where("a IS NOT NULL AND b IS NOT NULL"), "copy")
    assert digests.digest_differences(source, source, ["a", "b"], "t", EVER).count() == 0
    sums = digests._digests(source, ["a", "b"], "t", 8, "source").groupBy("__bucket").agg(F.sum("n").alias("n"))
    assert sums.count() == 256
    assert digests.digest_differences(source.limit(0), source.limit(0), ["a", "b"], "t", EVER).count() == 0


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp_ntz"])
def test_each_row_is_in_one_range(spark, kind):
    value = {
        "long": "CAST(POW(id, 2) AS LONG)",
        "double": "POW(id, 1.7) - 3",
        "date": "date_add(DATE '2020-01-01', CAST(id AS INT))",
        "timestamp_ntz": "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT), 0)",
    }[kind]
    df = spark.range(5000).selectExpr(f"IF(id % 20 = 7, NULL, {value}) AS k")
    found = ranges.key_ranges(df, "k", 10)
    sizes = [df.where(r).count() for r in found]
    assert sum(sizes) == 5000 and max(sizes) <= 2 * 5000 / len(found) and sizes[-1] == 250
    assert df.where(" AND ".join(f"NOT coalesce({r}, false)" for r in found)).count() == 0
    assert ranges.key_ranges(df.limit(0), "k", 10) == ["true"]
    assert sum(df.where(r).count() for r in ranges.key_ranges(df, "k", 1)) == 5000


def test_unchanged_files_are_not_read_again(spark):
    path = scratch_path(spark, "by-file")
    for part in range(3):
        spark.range(10).selectExpr(f"id + {part} AS v", "CAST(NULL AS INT) AS w").coalesce(1).write.parquet(f"{path}/p{part}")
    first = materialize(counts.refreshed_file_sums(spark, path, ["v", "w"]), "sums")
    same = counts.refreshed_file_sums(spark, path, ["v", "w"], first)
    assert not re.search(r"FileScan parquet[^\n]*by-file", same._jdf.queryExecution().executedPlan().toString())
    assert rows(same) == rows(first) and same.count() == 3
    spark.range(5).selectExpr("id AS v", "1 AS w").coalesce(1).write.mode("overwrite").parquet(f"{path}/p1")
    again = counts.refreshed_file_sums(spark, path, ["v", "w"], first)
    total = counts.total_of_files(again, "t").first()
    assert (total.row_count, int(total.sum_v), int(total.sum_w)) == (25, 45 + 65 + 10, 5)


def test_partial_events_in_order(spark):
    target = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (None, "n", "n")], "k long, x string, y string")
    values = [
        (1, 1, "U", ["x"], "x1", None), (1, 2, "U", ["y"], None, None), (1, 3, "U", ["x"], "x3", "no"),
        (2, 1, "U", ["x"], "gone", None), (2, 2, "D", [], None, None), (2, 3, "I", ["y"], None, "y3"),
        (3, 1, "I", ["x"], "new", None), (4, 1, "I", ["x"], "z", None), (4, 2, "D", [], None, None),
        (None, 1, "I", ["x"], "no key", None), (1, 9, "?", ["x"], "no op", None),
    ]
    events = spark.createDataFrame(values, "k long, place int, op string, sets array<string>, x string, y string")
    want = sorted([(1, "x3", None), (2, None, "y3"), (3, "new", None), (None, "n", "n")], key=repr)
    assert rows(upsert.apply_partial_events(target, events, ["k"], ["place"], ["x", "y"])) == want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows(upsert.apply_partial_events(target, events, ["k"], ["place"], ["x", "y"])) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def keys_of(spark, names):
    values = [(*n.split("."), "k", 1, "Y") for n in names]
    return spark.createDataFrame(
        values, "owner string, table_name string, column_name string, ordinal_position int, verification_yn string"
    )


def small_check(spark, name, n=3, slow=False):
    schema = "k long, t timestamp_ntz"
    source = spark.createDataFrame([(i, at("2024-01-02")) for i in range(n)], schema)
    target = spark.createDataFrame([(i, at("2024-01-03")) for i in range(n)], schema)
    if slow:

        def wait(batches):
            time.sleep(60)
            yield from batches

        source = source.coalesce(1).mapInArrow(wait, source.schema)
    schema_name, table = name.split(".")
    return TableCheck(schema_name, table, source, target, ["k"], "t")


def test_a_slow_table_is_reported_and_the_others_complete(spark):
    path = scratch_path(spark, "pools")
    names = ["a.fast", "b.slow", "c.fast"]
    began = time.time()
    status = catalog.check_all(
        spark, keys_of(spark, names), lambda n, k: small_check(spark, n, slow="slow" in n), EVER, "b1", path, 3, 12
    )
    assert time.time() - began < 50
    assert rows(status, "table_nm", "status") == [("a.fast", "done"), ("b.slow", "timed out"), ("c.fast", "done")]
    assert catalog.read_log(spark, path, "b1").select("table_nm").distinct().count() == 2


def test_a_batch_run_again_keeps_no_old_log(spark):
    path = scratch_path(spark, "reruns")
    catalog.check_all(spark, keys_of(spark, ["a.x", "a.y", "a.z"]), lambda n, k: small_check(spark, n), EVER, "b", path)

    def failing(name, keys):
        if name == "a.y":
            raise OSError("disk gone")
        return small_check(spark, name)

    status = catalog.check_all(spark, keys_of(spark, ["a.x", "a.y"]), failing, EVER, "b", path)
    assert rows(status, "table_nm", "status") == [("a.x", "done"), ("a.y", "failed")]
    assert rows(catalog.read_log(spark, path, "b").select("table_nm").distinct()) == [("a.x",)]
    repaired = catalog.repair_all(
        spark, path, keys_of(spark, ["a.x", "a.y"]), lambda n, k: small_check(spark, n), "b", scratch_path(spark, "fixed")
    )
    assert [m for _, _, m in rows(repaired)] == ["repaired", "not in the log"]


def test_plan_of_numbering_writes_once(spark, monkeypatch):
    from tablemend.operators import numbering

    written_ = []
    monkeypatch.setattr(numbering, "materialize", lambda df, label: written_.append(label) or materialize(df, label))
    df = spark.range(1000).selectExpr("id % 3 AS g", "id % 10 AS t")
    got = numbering.numbered(df, ["g"], ["t"], partitions=5)
    assert len(written_) == 1 and not re.search("rand", got._jdf.queryExecution().toString())
    assert sorted(r.row_no for r in got.where("g = 1").collect()) == list(range(1, 334))


def test_merges_leave_the_buckets_of_the_target(spark):
    from tablemend.operators import pairs
    from tablemend.sinks import files as sinks

    df = spark.range(3000).selectExpr("id AS k", "id % 7 AS v")
    table = "bucketed_target"
    sinks.write_bucketed(df.unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS k, 1L AS v")), table, ["k"], 16, scratch_path(spark, "b"))
    source = spark.range(2000, 4000).selectExpr("id AS k", "-1L AS v").unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS k, 2L AS v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        target = spark.table(table)
        merged = upsert.upsert_bucketed(target, source, ["k"])
        assert rows(merged) == rows(upsert.upsert(target, source, ["k"]))
        for found in (merged, upsert.sync_deletes(target, source, ["k"]), pairs.still_missing(source.withColumn("batch_id", F.lit("b")), target, ["k"], "b")):
            plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE {table}")


def test_ranges_that_were_cut_off_are_loaded_again(spark):
    from tablemend.session import exists, remove
    from tablemend.sinks import files as sinks

    df, path = spark.range(100), scratch_path(spark, "cut-off")
    found = ["id < 50", "id >= 50"]
    assert sinks.load_missing(df, found, path) == [0, 1]
    remove(spark, f"{path}/range=1/_SUCCESS")
    assert not exists(spark, f"{path}/range=1/_SUCCESS")
    assert sinks.load_missing(df, found, path) == [1] and spark.read.schema(df.schema).parquet(path).count() == 100
