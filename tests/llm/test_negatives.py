"""Hard negatives against SQL, against all scores, and on odd rows."""

import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tablemend.llm import negatives

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, n=5, percent=80):
    """Every score, then the rules one by one."""
    found = []
    for key, label, vector in rows:
        if key % 100:
            continue
        scores = sorted((-int(np.dot(vector, v)), k, b) for k, b, v in rows if k != key)
        for minus, positive, _ in [s for s in scores if s[2] == label][:n]:
            inside = [s for s in scores if s[2] != label and -percent * minus <= -100 * s[0] <= -100 * minus]
            found += [(key, positive, i, k, -minus, -s) for i, (s, k, _) in enumerate(inside[:n], 1)]
    return sorted(found)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    assert compare(spark, duck(sf_dir), sf_dir, queries()["op13_hard_negatives"], oracle_sql()["op13_hard_negatives"]) > 50


@pytest.mark.parametrize(("spread", "shard", "block"), [(2, 64, 3), (2, 10_000, 1000), (60, 50, 4)])
def test_clustered_vectors_against_all_scores(spark, spread, shard, block):
    """Tight clusters, where bounds decide, and ties."""
    rng = np.random.default_rng(spread)
    centre = rng.integers(-50, 50, (6, 8))
    rows = [(i, int(rng.integers(0, 3)), (centre[i % 6] + rng.integers(-spread, spread + 1, 8)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, label int, weights array<long>")
    got = negatives.mine(df, F.col("vec_id") % 100 == 0, shard_rows=shard, block_rows=block)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == plain(rows)


def test_bounds_spare_scores():
    """In tight clusters most candidates are never scored, and bounds hold everywhere."""
    rng = np.random.default_rng(5)
    centre = rng.integers(-4000, 4000, (8, 16))
    vectors = (centre[np.arange(4000) % 8] + rng.integers(-9, 10, (4000, 16))).astype(float)
    shard = negatives.Rows(np.arange(4000), np.arange(4000) % 5, vectors)
    anchors = negatives.Rows(np.arange(0, 4000, 40), np.arange(0, 4000, 40) % 5, vectors[::40])
    walk = negatives.Walk(shard, anchors)
    for at, low, high in walk:
        exact = vectors @ anchors.vectors[at]
        assert ((low <= exact) & (exact <= high)).all()
        places, score = walk.score(high >= np.partition(low, -20)[-20])
        assert (score == exact[places]).all()
    assert walk.scored < 0.4 * 4000 * len(anchors.keys)


def test_spanning_tree_is_shortest():
    vectors = np.random.default_rng(3).normal(size=(40, 3))
    tree = negatives.spanning_tree(vectors)
    edges = sorted((float(np.linalg.norm(vectors[i] - vectors[j])), i, j) for i in range(40) for j in range(i))
    group, total = list(range(40)), 0.0
    for length, i, j in edges:
        if group[i] != group[j]:
            total += length
            group = [group[i] if g == group[j] else g for g in group]
    assert sum(length for _, _, length in tree) == pytest.approx(total)
    assert sorted(at for at, _, _ in tree) == list(range(40))


def test_odd_rows(spark):
    rows = [
        (0, 1, [3, 4]), (0, 1, [3, 4]), (0, 2, [9, 9]), (1, 1, [3, 3]), (2, 2, [3, 3]), (3, 2, [3, 3]), (None, 1, [9, 9]),
        (4, None, [9, 9]), (5, 2, None), (6, 2, [3, None]), (7, 2, []), (8, 2, [3]), (200, 9, [1, 1]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, weights array<long>").withColumn("anchor", F.lit(1))
    df = df.withColumn("key", F.lit("x"))
    got = negatives.mine(df, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == [(0, 1, 1, 2, 21, 21), (0, 1, 2, 3, 21, 21)]
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(df, F.lit(False)).count() == 0
    with pytest.raises(Exception, match="too large"):
        negatives.mine(df.withColumn("weights", F.array(F.lit(2**40))), F.lit(True)).count()
