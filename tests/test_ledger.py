"""Edge cases of the key comparison."""

import itertools

import pytest
from frames import at, rows

from tablemend.functions.windows import TimeWindow
from tablemend.operators import ledger as L
from tablemend.operators.keys import rows_not_in

SCHEMA = "k long, chg_dtm timestamp_ntz"
WINDOW = TimeWindow("2024-01-01 00:00:00", "2024-01-31 00:00:00")


def frame(spark, *pairs):
    return spark.createDataFrame([(k, None if t is None else at(t)) for k, t in pairs], SCHEMA)


def test_changed_needs_both_sides_and_another_second(spark):
    source = frame(spark, (1, "2024-01-02"), (2, "2024-01-02 00:00:00.900000"), (3, "2024-01-02"), (4, "2024-01-02"))
    target = frame(
        spark, (1, "2024-01-03"), (2, "2024-01-02 00:00:01.100000"), (3, "2024-01-02 00:00:00.700000"), (9, "2024-01-30")
    )
    assert rows(L.diff_changed(source, target, ["k"], "chg_dtm", WINDOW), "k") == [(1,), (2,)]


def test_source_newer_than_the_whole_target_is_not_reported(spark):
    source = frame(spark, (1, "2024-01-10"), (2, "2024-01-12"), (3, "2024-01-11"))
    target = frame(spark, (1, "2024-01-05"), (9, "2024-01-11"))
    assert rows(L.diff_changed(source, target, ["k"], "chg_dtm", WINDOW), "k") == [(1,)]
    # Equal to the newest time is allowed for changed rows and not for missing ones.
    assert rows(L.source_only(source, target, ["k"], "chg_dtm", WINDOW), "k") == []
    later = target.union(frame(spark, (8, "2024-02-20")))
    assert rows(L.source_only(source, later, ["k"], "chg_dtm", WINDOW), "k") == [(2,), (3,)]


def test_window_end_belongs_to_both_sides(spark):
    newest = (9, "2024-03-01")
    source = frame(spark, (1, "2024-01-31"), (2, "2024-02-01"), (3, "2024-01-01"))
    target = frame(spark, (1, "2024-01-30"), (2, "2024-01-30"), (3, "2024-02-02"), (4, "2024-01-31"), newest)
    args = (source, target, ["k"], "chg_dtm", WINDOW)
    assert rows(L.diff_changed(*args), "k") == [(1,)]
    # A target row whose time left the window makes the source row one-sided.
    assert rows(L.source_only(*args), "k") == [(3,)]
    # A key changed after the window is not target-only.
    assert rows(L.target_only(*args), "k") == [(4,)]


def test_deleted_keys_are_not_changed(spark):
    source, target = frame(spark, (1, "2024-01-02"), (2, "2024-01-02")), frame(spark, (1, "2024-01-03"), (2, "2024-01-03"))
    deletes = spark.createDataFrame([(1, "D"), (1, "D"), (2, "U"), (5, "D")], "k long, op string")
    assert rows(L.diff_changed(source, target, ["k"], "chg_dtm", WINDOW, deletes), "k") == [(2,)]


def test_null_keys_match_nothing(spark):
    source = frame(spark, (None, "2024-01-02"), (1, "2024-01-02"))
    target = frame(spark, (None, "2024-01-03"), (1, "2024-01-02"), (9, "2024-02-20"))
    args = (source, target, ["k"], "chg_dtm", WINDOW)
    assert rows(L.diff_changed(*args)) == []
    assert rows(L.source_only(*args), "k") == [(None,)]
    assert rows(L.target_only(*args), "k") == [(None,)]


def test_empty_sides(spark):
    some, none = frame(spark, (1, "2024-01-02")), frame(spark)
    assert rows(L.source_only(some, none, ["k"], "chg_dtm", WINDOW)) == []
    assert rows(L.target_only(none, some, ["k"], "chg_dtm", WINDOW), "k") == [(1,)]
    counts = L.difference_counts(none, none, ["k"], "chg_dtm", WINDOW).collect()[0]
    assert tuple(counts) == (0, 0, 0, 0, 0, None)


def test_parts_sum_to_the_union_of_keys(spark):
    source = frame(spark, *[(k, "2024-01-02") for k in range(0, 20)])
    target = frame(spark, *[(k, "2024-01-03" if k % 3 else "2024-01-02") for k in range(10, 30)], (99, "2024-02-20"))
    found = L.all_differences(source, target, ["k"], "chg_dtm", WINDOW)
    kinds = {kind: n for kind, n in rows(found.groupBy("kind").count())}
    same = sum(1 for k in range(10, 20) if k % 3 == 0)
    assert sum(kinds.values()) + same == 30
    assert kinds == {"changed": 10 - same, "source_only": 10, "target_only": 10}


def test_pending_events_explain_differences(spark):
    since = "2024-01-01 00:00:00"
    source = frame(spark, (1, "2024-01-02"), (2, "2024-01-02"), (3, "2024-01-02"), (4, "2024-01-02"))
    target = frame(spark, (1, "2024-01-03"), (2, "2024-01-04"), (7, "2024-01-04"), (8, "2024-01-04"))
    events = spark.createDataFrame(
        [
            ("D", 1, at("2024-01-05")),
            ("D", 2, at("2024-01-04")),
            ("I", 3, at("2024-01-04")),
            ("I", 4, at("2024-01-03")),
            ("D", 7, at("2024-01-04")),
            ("D", 8, at("2024-01-03")),
        ],
        "op string, k long, chg_dtm timestamp_ntz",
    )
    args = (source, target, ["k"], "chg_dtm", since, events)
    assert rows(L.diff_changed_pending(*args), "k") == [(2,)]
    assert rows(L.source_only_pending(*args), "k") == [(4,)]
    assert rows(L.target_only_pending(*args), "k") == [(8,)]


@pytest.mark.parametrize("known", [[], [(1, 1)], [(1, None)], [(None, 2)], [(None, None)], [(1, 1), (2, None), (None, 3)]])
def test_not_in_follows_three_valued_logic(spark, known):
    values = (None, 1, 2, 3)
    left = list(itertools.product(values, values))

    def could_equal(a, b):
        return all(x is None or y is None or x == y for x, y in zip(a, b))

    want = sorted((a for a in left if not any(could_equal(a, b) for b in known)), key=repr)
    schema = "a int, b int"
    got = rows_not_in(spark.createDataFrame(left, schema), spark.createDataFrame(known, schema), ["a", "b"])
    assert rows(got) == want


def test_null_aware_form_suppresses_what_a_null_could_match(spark):
    source = frame(spark, (1, "2024-01-02"), (2, "2024-01-02"))
    target = frame(spark, (None, "2024-01-03"), (1, "2024-01-02"), (7, "2024-01-04"), (9, "2024-02-20"))
    args = (source, target, ["k"], "chg_dtm", WINDOW)
    assert rows(L.source_only(*args, null_aware=True)) == []
    assert rows(L.target_only(*args, null_aware=True), "k") == [(7,)]
    assert rows(L.source_only(*args), "k") == [(2,)]
