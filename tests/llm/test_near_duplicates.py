"""The near-duplicate stage against all pairs of fingerprints."""

import numpy as np

from tablemend.llm import simhash


def plain(texts, bits=3):
    """The smallest id of every component of the graph of close fingerprints."""
    codes = {d: simhash.fingerprint(t, 3) for d, t in texts.items()}
    root = {d: d for d in texts}
    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and (codes[a] ^ codes[b]).bit_count() <= bits and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return sorted(set(root.values()))


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, kept string")
    return [tuple(r) for r in simhash.one_of_each(df).collect()]


def test_edited_copies_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    texts = {}
    for i in range(60):
        words = [f"v{x}" for x in rng.integers(0, 10**6, int(rng.integers(1, 400)))]
        for _ in range(int(rng.integers(1, 6))):
            texts[len(texts)] = " ".join(words)
            words[int(rng.integers(0, len(words)))] = "changed"
    texts[len(texts)] = ""
    want = plain(texts)
    assert 60 < len(want) < len(texts) - 20
    assert sorted(r[0] for r in got(spark, [(d, t, 0, "x") for d, t in texts.items()])) == want


def test_null_and_repeated_keys(spark):
    rows = [(None, "a b c d", 1, "x"), (7, "a b c d", 1, "y"), (7, "a b c d", 1, "y"), (None, "only here", 2, None)]
    rows += [(3, None, 0, "n"), (4, "", 0, "e")]
    assert set(got(spark, rows)) == {(3, None, 0, "n"), (7, "a b c d", 1, "y"), (None, "only here", 2, None)}
