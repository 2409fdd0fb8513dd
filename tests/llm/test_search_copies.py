"""Blocks of queries sent to many shards, one copy at a time."""

import numpy as np

from tablemend.llm import search


def test_no_copies_held_at_once(spark):
    """No explode of packed vectors: it holds all copies of a row, as many as shards, and no executor has room for them."""
    rows = [(i, [i % 7, i % 5]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, weights array<long>")
    found = search.top_k(frame, frame, k=2, shard_rows=8, block_rows=8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_numbers_of_all_sizes_and_many_blocks(spark):
    """Against all products, with vectors of one, two, four and eight bytes a number, and blocks in more than one part."""
    rng = np.random.default_rng(9)
    most = [100, 30_000, 2_000_000_000, 2_000_000_000_000]
    rows = [(i, [int(x) for x in rng.integers(-most[i % 4], most[i % 4] + 1, 1 + i % 6)]) for i in range(120)]
    rows += [(i, [int(x) for x in rng.integers(-128, 128, 6)]) for i in range(120, 180)]
    wanted = []
    for q, v in rows:
        if q % 4 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in rows if i != q)[:3]
            wanted += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    # Small numbers of their own, so that some groups are packed in one byte.
    for chosen in (rows, rows[120:]):
        frame = spark.createDataFrame(chosen, "vec_id long, weights array<long>")
        queries = frame.where("vec_id % 4 = 0")
        got = [sorted(tuple(r) for r in search.top_k(frame, queries, 3, shard_rows=s, block_rows=5).collect()) for s in (16, 500)]
        assert got[0] == got[1]
        if chosen is rows:
            assert got[0] == sorted(wanted)
