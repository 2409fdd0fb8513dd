"""Random frames against plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest
from frames import rows

from tablemend.functions.windows import TimeWindow
from tablemend.operators import ledger as L
from tablemend.operators.numbering import numbered
from tablemend.operators.pairs import deleted_keys, key_set_diff, outer_indicator
from tablemend.operators.upsert import apply_changes, upsert
from tablemend.plans import verify

SCHEMA = "a int, b string, chg_dtm timestamp_ntz, v int"
KEYS = ["a", "b"]
START = dt.datetime(2024, 1, 1)
WINDOW = TimeWindow("2024-01-01 00:00:10", "2024-01-01 00:00:40")
LO, HI = START + dt.timedelta(seconds=10), START + dt.timedelta(seconds=40)


def random_table(rng, share=0.6):
    """Unique two-part keys with times around the window, some on its edges, some with fractions."""
    table = {}
    for a in range(12):
        for b in "xyz":
            if rng.random() < share:
                seconds = rng.choice([9, 10, 11, 20, 20.4, 20.9, 39.9, 40, 41, rng.uniform(0, 60)])
                table[(a, b)] = (START + dt.timedelta(seconds=round(seconds, 3)), rng.randrange(5))
    return table


def frame(spark, table):
    return spark.createDataFrame([(*k, t, v) for k, (t, v) in table.items()], SCHEMA)


def cut(t):
    return t.replace(microsecond=0)


def brute(source, target, deleted):
    newest = max((t for t, _ in target.values()), default=None)
    inside = lambda t: LO <= t <= HI
    window = {k: cut(t) for k, (t, _) in source.items() if inside(t)}
    after = {k for k, (t, _) in source.items() if t >= HI}
    held = {k: t for k, (t, _) in target.items() if inside(t)}
    changed = {k for k in window.keys() & held if window[k] != cut(held[k]) and window[k] <= newest and k not in deleted}
    source_only = {k for k in window if k not in held and newest is not None and window[k] < newest}
    return changed, source_only, {k for k in held if k not in window and k not in after}


@pytest.mark.parametrize("seed", range(6))
def test_differences(spark, seed):
    rng = random.Random(seed)
    source, target = random_table(rng), random_table(rng, 0.6 if seed else 0)
    deleted = {k for k in source if rng.random() < 0.2}
    deletes = spark.createDataFrame([(*k, "D") for k in deleted], "a int, b string, op string")
    changed, source_only, target_only = brute(source, target, deleted)
    found = L.all_differences(frame(spark, source), frame(spark, target), KEYS, "chg_dtm", WINDOW, deletes)
    got = {}
    for kind, a, b in rows(found, "kind", *KEYS):
        got.setdefault(kind, set()).add((a, b))
    want = {"changed": changed, "source_only": source_only, "target_only": target_only}
    assert got == {kind: keys for kind, keys in want.items() if keys}
    counts = L.difference_counts(frame(spark, source), frame(spark, target), KEYS, "chg_dtm", WINDOW, deletes).first()
    assert tuple(counts)[2:5] == (len(changed), len(source_only), len(target_only))


@pytest.mark.parametrize("seed", range(3))
def test_repair_leaves_nothing_to_repair(spark, seed):
    rng = random.Random(seed)
    source, target = random_table(rng), random_table(rng)
    check = verify.TableCheck("s", "t", frame(spark, source), frame(spark, target), KEYS, "chg_dtm")
    log = verify.verification_log(check, WINDOW, "b")
    mended = verify.repaired_target(check, verify.repair_queue(check, log, "b"))
    again = verify.TableCheck("s", "t", check.source, mended, KEYS, "chg_dtm")
    left = verify.verification_log(again, WINDOW, "b").where("kind <> 'target_only'")
    assert rows(left) == []


@pytest.mark.parametrize("limit", ["-1", "100MB"])
def test_upsert_and_events(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        rng = random.Random(11)
        target, source = random_table(rng), random_table(rng)
        got = upsert(frame(spark, target), frame(spark, source), KEYS)
        assert rows(got) == rows(frame(spark, {**target, **source}))
        events, state = [], dict(target)
        for n in range(150):
            key, op = (rng.randrange(12), rng.choice("xyz")), rng.choice("IUD")
            value = (START + dt.timedelta(seconds=n), n)
            events.append((n, op, *key, *value))
            if op == "D":
                state.pop(key, None)
            else:
                state[key] = value
        queue = spark.createDataFrame(events, "n int, op string, " + SCHEMA)
        assert rows(apply_changes(frame(spark, target), queue, KEYS, ["n"])) == rows(frame(spark, state))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_copies_and_missing_values_are_counted(spark):
    rng = random.Random(5)
    values = [None, float("nan"), 0.0, 1.5]
    left = [(rng.choice([None, 1, 2]), rng.choice(values)) for _ in range(60)]
    right = [(rng.choice([None, 1, 2]), rng.choice(values)) for _ in range(20)]

    def norm(row):
        return (row[0], "nan" if row[1] is not None and row[1] != row[1] else row[1])

    a, b = Counter(map(norm, left)), Counter(map(norm, right))
    schema = "k int, x double"
    got = outer_indicator(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k", "x"])
    assert {norm(r): (r["left_rows"], r["right_rows"]) for r in got.collect()} == {
        k: (a[k], b[k]) for k in a.keys() | b.keys()
    }


def test_key_sets(spark):
    rng = random.Random(3)
    source, target = random_table(rng), random_table(rng)
    got = rows(key_set_diff(frame(spark, source), frame(spark, target), KEYS, ["v"]), *KEYS, "v", "source_yn")
    want = [(*k, v, "y") for k, (_, v) in source.items() if k not in target]
    want += [(*k, v, "n") for k, (_, v) in target.items() if k not in source]
    assert got == sorted(want, key=repr)
    gone = rows(deleted_keys(frame(spark, source), frame(spark, target), KEYS))
    assert gone == sorted(target.keys() - source.keys())


def test_many_copies_of_a_row_are_numbered(spark):
    df = spark.range(2000).selectExpr("CASE WHEN id % 2 = 0 THEN 1 ELSE 2 END AS g", "CASE WHEN id < 1500 THEN 5 ELSE id END AS t")
    got = numbered(df, ["g"], ["t"], partitions=6)
    for g in (1, 2):
        assert sorted(r["row_no"] for r in got.where(f"g = {g}").collect()) == list(range(1, 1001))
    assert sorted(r["row_no"] for r in numbered(df, [], ["t"], partitions=6).collect()) == list(range(1, 2001))
