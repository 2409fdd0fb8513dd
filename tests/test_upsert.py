"""Upserts on both join paths, and the latest row per key."""

import pytest
from frames import at, rows

from tablemend.functions.windows import TimeWindow
from tablemend.operators import dedupe as D
from tablemend.operators import upsert as U
from tablemend.operators.keys import rows_with_key, rows_without_key
from tablemend.plans import load

SCHEMA = "k long, a string, b string"


@pytest.fixture(params=["broadcast", "shuffle"])
def path(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100MB" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def frame(spark, *data):
    return spark.createDataFrame(data, SCHEMA)


def test_update_insert_and_untouched_columns(spark, path):
    target = frame(spark, (1, "a", "x"), (2, "b", "y"), (None, "n", "z"))
    source = frame(spark, (2, None, "no"), (3, "c", "no"), (None, "m", "no"))
    got = U.upsert(target, source, ["k"], ["k", "a"])
    # A matched row takes the null of the source; null keys match nothing.
    assert rows(got) == sorted(
        [(1, "a", "x"), (2, None, "y"), (3, "c", None), (None, "n", "z"), (None, "m", None)], key=repr
    )


def test_twice_is_once(spark, path):
    target, source = frame(spark, (1, "a", "x"), (2, "b", "y")), frame(spark, (2, "c", "q"), (5, "d", "w"))
    once = U.upsert(target, source, ["k"])
    assert rows(U.upsert(once, source, ["k"])) == rows(once)


def test_paths_are_the_ones_meant(spark, path):
    target, source = spark.range(100).selectExpr("id as k", "'a' as a"), spark.range(9).selectExpr("id as k", "'b' as a")
    plan = U.upsert(target, source, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert ("FullOuter" in plan) == (path == "shuffle")


def test_sync_deletes_keeps_rows_without_key(spark):
    target = frame(spark, (1, "a", "x"), (2, "b", "y"), (None, "n", "z"))
    assert rows(U.sync_deletes(target, frame(spark, (1, "q", "q")), ["k"]), "k") == [(1,), (None,)]


def test_last_event_decides(spark, path):
    target = frame(spark, (1, "a", "x"), (2, "b", "y"))
    events = spark.createDataFrame(
        [
            ("U", 1, 1, "u", "u"),
            ("D", 2, 1, None, None),
            ("D", 1, 2, None, None),
            ("I", 2, 2, "back", "back"),
            ("I", 1, 3, "new", "new"),
            ("D", 2, 3, None, None),
            ("D", 1, 9, None, None),
            ("U", 1, None, "lost", "lost"),
        ],
        "op string, n int, k long, a string, b string",
    )
    assert rows(U.apply_changes(target, events, ["k"], ["n"])) == [(2, "back", "back")]


def test_latest_per_key_is_stable_and_orders_missing_times(spark):
    data = [(1, at("2024-01-01"), "a"), (1, at("2024-01-01"), "b"), (1, None, "c"), (2, None, "d")]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, v string")
    assert rows(D.latest_per_key(df, ["k"], ["t"]), "k", "v") == [(1, "b"), (2, "d")]
    assert rows(D.latest_per_key(df, ["k"], ["t"], missing_first=True), "k", "v") == [(1, "c"), (2, "d")]


def test_latest_per_key_thins_copies_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as t")
    plan = D.latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[-1] and "WindowGroupLimit" in plan


def test_latest_in_window_keeps_ties_and_skips_the_end(spark):
    data = [(1, at("2024-01-05"), "a"), (1, at("2024-01-05"), "b"), (1, at("2024-01-04"), "c"), (1, at("2024-02-01"), "d")]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, v string")
    window = TimeWindow("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert rows(D.latest_in_window(df, ["k"], "t", window), "v") == [("a",), ("b",)]


def test_key_types_may_differ(spark, path):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert rows(U.upsert(target, source, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(rows_with_key(target, source, ["k"])) == [(2, "b")]
    assert rows(rows_without_key(target, source, ["k"])) == [(1, "a")]


def test_keys_do_not_move_between_partitions(spark, tmp_path):
    held = spark.createDataFrame([(1, "a", "d1"), (2, "b", None)], "k int, v string, d string")
    held.write.partitionBy("d").parquet(f"{tmp_path}/t")
    moving = spark.createDataFrame([(1, "A", "d2")], "k int, v string, d string")
    with pytest.raises(ValueError, match="another partition"):
        load.upsert_partitions(spark, f"{tmp_path}/t", moving, ["k"], "d", f"{tmp_path}/s1")
    staying = spark.createDataFrame([(2, "B", None), (3, "C", "d1")], "k int, v string, d string")
    load.upsert_partitions(spark, f"{tmp_path}/t", staying, ["k"], "d", f"{tmp_path}/s2")
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "k", "v", "d") == [(1, "a", "d1"), (2, "B", None), (3, "C", "d1")]


def test_strict_upserts_refuse_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(ValueError, match="more than once"):
        U.upsert(target, twice, ["k"], strict=True)
