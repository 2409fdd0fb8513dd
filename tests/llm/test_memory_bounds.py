"""Bounds on what a worker holds change no result."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tablemend.llm import packing, toxicity


def test_packing_in_small_parts(spark):
    rows = [(i, f"some words of text {i} " * (i % 40)) for i in range(60)] + [(60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, small = (packing.pack(docs, path, **more).collect() for more in ({}, {"part_bytes": 300}))
    assert sorted(map(repr, whole)) == sorted(map(repr, small))


def test_remembered_word_weights_are_bounded():
    """200,000 words a worker at most: 600,000 were part of what took an executor beyond its memory."""
    known = toxicity.WordWeights({"abc": 1.0})
    for i in range(250_000):
        known[f"w{i}"]
    assert len(known) <= 200_000 and known["abc"] == 1.0


def test_ids_are_put_together_without_a_place_each():
    """Ids of known words come from their Arrow array: the rest takes a few bytes an id, and the ids are the tokenizer's."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.WordIds(path)
    texts = ["", "\n", "Ab, qzxjvkwpfhq çé.", *["qzxjvkwpfhqzxjvbnmqwzrtpsdfghjklyxcv" * 4 + " a"] * 20_000, ""]
    encoder.encode(pa.array(texts, pa.string()))
    tracemalloc.start()
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids) > 400_000 and peak < 8 * len(ids)
    plain = Tokenizer.from_file(path)
    want = {t: plain.encode(t, add_special_tokens=False).ids for t in set(texts)}
    assert ids.tolist() == [i for t in texts for i in want[t]] and sizes.tolist() == [len(want[t]) for t in texts]
    assert encoder.encode(pa.array(["", "\n"], pa.string()))[1].tolist() == [0, 0]
