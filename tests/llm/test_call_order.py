"""Order of calls: chains of any length, also beside a cycle of another conversation."""

import random

import pytest

from tablemend.llm import toolcalls

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, uses array<string>"
RESULTS = "conv_id long, call_id string, turn long, content string"


def test_long_chain_beside_a_cycle(spark):
    """Each of 36 calls uses the next; a cycle and a call that waits for it stand in another conversation."""
    n = 36
    rows = [(1, f"c{i}", i, "f", "{}", [f"c{i + 1}"] if i + 1 < n else []) for i in range(n)]
    rows += [(2, "a", 1, "f", "{}", ["b"]), (2, "b", 2, "f", "{}", ["a"]), (2, "d", 3, "f", "{}", ["a", "gone"])]
    rows += [(2, "e", 4, "f", "{}", [])]
    links = toolcalls.linked(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS))
    got = {(r.conv_id, r.call_id): r for r in toolcalls.ordered(links).collect()}
    # The last call keeps its turn and each one before it comes one place later.
    assert [got[1, f"c{i}"].place for i in range(n)] == [n - 1 + n - 1 - i for i in range(n)]
    assert {got[1, f"c{i}"].order for i in range(n - 1)} == {"moved"}
    assert [got[2, c].order for c in "abde"] == ["cycle", "cycle", "cycle", "as_given"]


def test_a_chain_of_a_thousand_calls_takes_few_rounds(spark, monkeypatch):
    written = []
    keep = toolcalls.materialize
    monkeypatch.setattr(toolcalls, "materialize", lambda df, label: written.append(label) or keep(df, label))
    rows = [(1, f"c{i}", i, "f", "{}", [f"c{i + 1}"] if i < 999 else []) for i in range(1000)]
    links = toolcalls.linked(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS))
    got = {r.call_id: r.place for r in toolcalls.ordered(links).collect()}
    assert [got[f"c{i}"] for i in range(1000)] == [999 + 999 - i for i in range(1000)]
    assert written.count("hops") + written.count("waiting") <= 12


def plain(calls):
    """Places by peeling: a call once all it uses is placed, no earlier than its turn."""
    turn = {c: t for c, t, _ in calls}
    uses = {c: {u for u in used if u in turn} for c, _, used in calls}
    place = {}
    while ready := [c for c in turn if c not in place and uses[c] <= place.keys()]:
        for c in ready:
            place[c] = max([turn[c], *(place[u] + 1 for u in uses[c])])
    return {c: (place.get(c, turn[c]), c not in place) for c in turn}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_against_peeling(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for conv in range(30):
        n = rng.randint(1, 25)
        ids = [f"c{i}" for i in range(n)]
        calls = []
        for i, c in enumerate(ids):
            pool = ids if rng.random() < 0.1 else ids[i + 1 :]
            k = rng.choice([0, 1, 1, 1, 2, 3])
            calls.append((c, rng.randint(0, 30), rng.sample(pool, min(k, len(pool))) + (["gone"] if rng.random() < 0.1 else [])))
        rows += [(conv, c, t, "f", "{}", used) for c, t, used in calls]
        want |= {(conv, c): v for c, v in plain(calls).items()}
    links = toolcalls.linked(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS))
    got = {(r.conv_id, r.call_id): (r.place, r.order == "cycle") for r in toolcalls.ordered(links).collect()}
    assert got == want
