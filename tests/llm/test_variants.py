"""Spelling variants against all pairs of words, the query against plain Python, and odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tablemend.llm import variants

UPPER = {c: c + 32 for c in range(65, 91)}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_pairs(words):
    """By the texts left when a letter is taken out."""
    near = set()
    shorter = {}
    for w in words:
        for i in range(len(w)):
            shorter.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    for short, longer in shorter.items():
        if short in words:
            near |= {(short, w) for w in longer} | {(w, short) for w in longer}
        near |= {(a, b) for a in longer for b in longer if a != b and one_apart(a, b)}
    return near


def plain_variants(counts, ratio=5):
    near = {w: [] for w in counts}
    for a, b in plain_pairs(set(counts)):
        near[a].append(b)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, n, len(near[w]), form[w], form[w] and counts[form[w]], root))
    return sorted(rows, key=repr)


def got(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_words_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abé"[: 2 + seed % 2], k=rng.randint(1, 7))) for _ in range(250)}
    words |= {"x" * n for n in range(1, 9)} | {"y" * 700 + c for c in ("", "a", "b", "ab")}
    counts = {w: rng.choice([1, 2, 5, 11, 60, 400]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(variants.variants(df)) == plain_variants(counts)
    pairs = {(r.word, r.near) for r in variants.near_words(df).collect()}
    assert pairs == {(a, b) for a in words for b in words if one_apart(a, b)}


def test_query_against_plain_python(spark):
    sf_dir = "/root/testdata/sf0.01"
    counts = Counter()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert len(counts) > 5000
    assert got(queries()["op12_spelling"](spark, sf_dir)) == plain_variants(counts)


def test_odd_rows(spark):
    rows = [(None, 5), ("", 9), ("alpha", 1), ("alpha", 30), ("alphas", 2), ("alphas", 2), ("alphass", None), ("b", 3), ("c", 15)]
    df = spark.createDataFrame(rows, "word string, n long")
    df = df.select("*", *[F.lit(0).alias(c) for c in ("near", "node", "path", "form", "root")])
    assert got(variants.variants(df)) == sorted(
        [
            ("alpha", 30, 1, None, None, "alpha"),
            ("alphas", 2, 1, "alpha", 30, "alpha"),
            ("b", 3, 1, "c", 15, "c"),
            ("c", 15, 1, None, None, "c"),
        ],
        key=repr,
    )
    assert variants.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="outnumber"):
        variants.variants(df, ratio=1)
