"""The pipeline's stages one after another, each held against a plain version on its own input."""

import math

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tablemend.llm import simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input of the first stage and output of every stage."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": rows.toPandas()}
    for name, stage in corpus_pipeline.STAGES:
        rows = spark.createDataFrame(stage(spark, rows, SF_DIR).toPandas())
        found[name] = rows.toPandas()
    return found


def test_toxic_documents_go(spark, steps):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    before = steps["documents"]
    clean = {d for d, t in zip(before.doc_id, before.text, strict=True) if model.score(t) < 0.3}
    assert set(steps["toxicity"].doc_id) == clean


def test_repeated_lines_go(steps):
    rows = steps["toxicity"].sort_values("doc_id")
    seen, want = set(), {}
    for d, text in zip(rows.doc_id, rows.text, strict=True):
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            run = tuple(lines[i : i + 3])
            if "".join(run).strip(" "):
                if run in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(run)
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        if not gone or kept.strip():
            want[d] = kept
    got = steps["line_dedup"]
    assert dict(zip(got.doc_id, got.text, strict=True)) == want
    assert list(got.n_chars) == [len(t) for t in got.text]


def test_one_of_each_group_stays(steps):
    before, after = steps["line_dedup"], set(steps["near_dedup"].doc_id)
    codes = np.array([simhash.fingerprint(t, 3) for t in before.text], dtype=np.uint64)
    least = before.doc_id.to_numpy()
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3
    for _ in range(len(codes)):
        least = np.array([least[n].min() for n in near])
    assert after == set(least)


def test_sources_meet_their_weights(steps):
    before, after = steps["near_dedup"], steps["mixing"]
    size = {d: len(t.split()) for d, t in zip(before.doc_id, before.text, strict=True)}
    totals = before.assign(n=before.doc_id.map(size)).groupby("source").n.sum()
    low, high = 0.0, 1.0
    for _ in range(42):
        middle = (low + high) / 2
        fits = (totals.min() / totals.max()) ** (middle - 1) <= 2
        low, high = (low, middle) if fits else (middle, high)
    taken = after.assign(n=after.doc_id.map(size)).groupby("source").n.sum()
    for source, total in totals.items():
        longest = max(size[d] for d in before.doc_id[before.source == source])
        over = taken[source] - total * (total / totals.max()) ** (high - 1)
        assert -1e-6 <= over <= longest
    assert set(after.doc_id) == set(before.doc_id)


def test_all_ids_are_packed(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs, got = steps["mixing"], steps["packing"]
    want = sorted(
        np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4").tobytes() for t in docs.text
    )
    # Copies of a document are told apart by the pieces that follow each other in number.
    first = got[got.start == 0]
    assert sorted(first.doc_tokens) == sorted(len(w) // 4 for w in want)
    assert got.length.sum() == sum(len(w) for w in want) // 4
    whole = sorted(bytes(p) for p, n, t in zip(got.ids, got.length, got.doc_tokens, strict=True) if n == t)
    assert whole == [w for w in want if len(w) <= 4 * 2048]
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert math.isclose(got.length.sum() / (2048 * got.sequence_id.nunique()), 1, abs_tol=0.03)
