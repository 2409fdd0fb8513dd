"""Mixed scores against a plain version that codes one decision after another, and the base score against counts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tablemend.llm import lm

UPPER = {c: c + 32 for c in range(65, 91)}
M32 = 2**32 - 1


def words_of(text):
    return (text or "").translate(UPPER).encode().split()


def plain_decisions(lexicon, text, bits):
    """(bit, spelled, slots) one after another, from the words of a text."""
    mix, stir = int(lm._MIX), int(lm._STIR)
    codes, found, one, two, ending = lexicon.codes, [], 1, 2, 1

    def code(symbol, contexts, spelled):
        for i in range(codes.first[symbol], codes.first[symbol + 1]):
            node = int(codes.node[i]) * mix & M32
            slots = [((c ^ node) * stir & M32) >> (32 - bits) for c in contexts]
            found.append((int(codes.bit[i]), spelled, slots))

    for place, w in enumerate([*words_of(text), b" "]):
        contexts = [0, ending * stir & M32, ((one * mix & M32) ^ two) * stir & M32]
        one, two = zlib.crc32(w), one if place else 2
        ending = zlib.crc32(w[-2:])
        if w in lexicon.numbers:
            code(lexicon.numbers[w], contexts, 0)
            continue
        code(lexicon.escape, contexts, 0)
        begun = 0
        for i, b in enumerate([*w, 256]):
            back = [w[i - j] if i >= j else 0 for j in (1, 2, 3, 4)]
            near = back[0] | back[1] << 8
            inner = [near, near | back[2] << 16 | back[3] << 24, begun]
            code(lexicon.byte + b, [(c + k) * stir & M32 for k, c in enumerate(inner)], 1)
            begun = begun + (b + 1) * pow(mix, i + 1, 2**32) & M32
    return found


def plain_cost(decisions, counts, mixer):
    """Bits of a text, its weights and map learning after every step of decisions."""
    weights, refined, total = mixer.weights[0].astype(float).copy(), mixer.refined[0].astype(float).copy(), 0.0
    for first in range(0, len(decisions), lm._STEP):
        slope, seen, ones = np.zeros_like(weights), np.zeros_like(refined), np.zeros_like(refined)
        for bit, spelled, slots in decisions[first : first + lm._STEP]:
            n = [(counts[k, s, 0], counts[k, s, 1]) for k, s in enumerate(slots)]
            odds = np.array([math.log((b + lm._PRIOR) / (a + lm._PRIOR)) for a, b in n])
            level = [0 if a + b == 0 else 1 if a + b <= 3 else 2 for a, b in n]
            gate = (3 * spelled + level[1]) * 3 + level[2]
            mixed = min(max(float(weights[gate] @ odds), -lm._SPAN + 0.01), lm._SPAN - 0.01)
            chance = 1 / (1 + math.exp(-mixed))
            share, low = math.modf((mixed + lm._SPAN) * (lm._BINS - 1) / (2 * lm._SPAN))
            low = int(low)
            final = (chance + refined[spelled][low] * (1 - share) + refined[spelled][low + 1] * share) / 2
            final = min(max(final, lm._LEAST), 1 - lm._LEAST)
            total += math.log2(final if bit else 1 - final)
            slope[gate] += (bit - chance) * lm._RATE * odds
            seen[spelled][low + (share >= 0.5)] += 1
            ones[spelled][low + (share >= 0.5)] += bit
        weights += slope
        refined = (refined * lm._HELD + ones) / (lm._HELD + seen)
    return total


@pytest.fixture(scope="module")
def few(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    return [(r.doc_id, r.text) for r in rows.limit(40).collect()]


def test_scores_against_one_decision_after_another(spark, few):
    shape = lm.Shape(lexicon=300, bits=16, tuned_rows=0)
    held = {d for d, _ in few if d % 5 == 0}
    df = spark.createDataFrame(few, "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score(df, F.col("doc_id") % 5 != 0, shape).collect()}
    texts = [t for d, t in few if d not in held]
    all_words = Counter(w for t in texts for w in words_of(t))
    top = sorted((-n, w) for w, n in all_words.items() if n >= 2)[:300]
    n_tokens = sum(all_words.values()) + len(texts)
    rest = n_tokens - len(texts) + sum(n for n, _ in top)
    lexicon = lm.Lexicon([w for _, w in top], [-n for n, _ in top], len(texts), rest)
    counts = defaultdict(int)
    for t in texts:
        for bit, _, slots in plain_decisions(lexicon, t, 16):
            for k, s in enumerate(slots):
                counts[k, s, bit] += 1
    # As few levels as the states hold.
    value = lambda n: n if n <= 64 else 64 * lm._GROWTH ** round(math.log(n / 64) / math.log(lm._GROWTH))
    counts = defaultdict(int, {c: value(n) for c, n in counts.items()})
    start = lm.Mixer.new()
    for d, t in few:
        r, tokens = got[d], words_of(t)
        bits = plain_cost(plain_decisions(lexicon, t, 16), counts, start)
        assert r.score == pytest.approx(bits * math.log10(2), rel=1e-4)
        known = sum(w in all_words for w in tokens) + 1
        base = sum(math.log10(all_words[w] + 0.1) for w in tokens) + math.log10(len(texts) + 0.1)
        base -= (len(tokens) + 1) * math.log10(n_tokens + 0.1 * (len(all_words) + 2))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d in held, len(tokens) + 1, known, n_tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.bits_per_byte == pytest.approx(-bits / len(b" ".join(tokens)), rel=1e-4)


def test_own_counts_are_left_out(few):
    """First weights come from states as if the text had not been counted."""
    lexicon = lm.Lexicon([b"the", b"of"], [9, 4], 3, 50)
    texts = [t.encode() for _, t in few[:6]]

    def states(chosen):
        counts = np.zeros((lm._CONTEXTS, 2 << 14), dtype=np.int64)
        for t in chosen:
            reading = lm.Reading(lexicon, [t])
            found = reading.decisions(np.arange(len(reading.words)), 14)
            for k, s in enumerate(found.slots):
                counts[k] += np.bincount(s << np.uint32(1) | found.bit, minlength=2 << 14)
        zeros, ones = np.minimum(counts, lm._EXACT).reshape(lm._CONTEXTS, -1, 2).transpose(2, 0, 1)
        return (zeros << 8 | ones).astype("<u2").tobytes()

    reading = lm.Reading(lexicon, texts[:1])
    found = reading.decisions(np.arange(len(reading.words)), 14)
    own = [np.unique(s << np.uint32(1) | found.bit, return_counts=True) for s in found.slots]
    few_each = [lm.Model(lexicon, states(texts[a:2]), 14) for a in (0, 1)]
    odds, gate = few_each[0]._inputs(found, own)
    want, want_gate = few_each[1]._inputs(found)
    # Slots beyond the exact levels keep their own counts.
    table = np.frombuffer(few_each[0].states, dtype="<u2").reshape(lm._CONTEXTS, -1)
    held = np.stack([table[k][s] for k, s in enumerate(found.slots)])
    exact = ((held >> 8 < lm._EXACT) & (held & 255 < lm._EXACT)).all(axis=0)
    assert exact.sum() > 1000 and (gate == want_gate)[exact].all()
    assert np.abs(odds - want)[:, exact].max() < 1e-6


def test_prefix_codes_are_complete():
    rng = np.random.default_rng(1)
    weights = rng.integers(1, 1000, 500).tolist()
    codes = lm.huffman(weights)
    length = np.diff(codes.first)
    assert sum(2.0**-length) == pytest.approx(1)
    entropy = -sum(w / sum(weights) * math.log2(w / sum(weights)) for w in weights)
    assert entropy <= (length * weights).sum() / sum(weights) < entropy + 1
    paths = {tuple(codes.bit[a:b]) for a, b in zip(codes.first[:-1], codes.first[1:], strict=True)}
    assert len(paths) == 500


def test_long_texts_in_segments_cost_the_same(monkeypatch):
    text = " ".join(f"word{i % 97} x{i % 13}" for i in range(3000)).encode()
    lexicon = lm.Lexicon([b"word1", b"x1"], [50, 40], 1, 900)
    model = lm.Model(lexicon, bytes(2 * lm._CONTEXTS << 12), 12)
    whole = model.score([text, b"", None])[1]
    monkeypatch.setattr(lm, "_SEGMENT", 512)
    parts = model.score([text, b"", None])[1]
    assert parts[0] == pytest.approx(whole[0], rel=0.02) and list(parts[1:]) == list(whole[1:])


def test_held_out_documents_gain(spark):
    got = queries()["op11_mixed_scores"](spark, "/root/testdata/sf0.01").toPandas()
    assert list(got.held_out) == [zlib.crc32(str(d).encode()) % 10 == 0 for d in got.doc_id]
    held = got[got.held_out & (got.n_tokens > 100)]
    assert (got.score <= 0).all() and len(held) > 20
    assert held.score.sum() > held.base_score.sum()


def test_odd_rows(spark):
    rows = [(None, "a b", 1), (1, None, 1), (2, "", 1), (3, "A b c İ\n\t", 1), (3, "A b c İ\n\t", 1), (4, "x" * 100_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int").withColumn("training", F.lit("x"))
    shape = lm.Shape(bits=12)
    got = lm.score(df, F.col("row") == 1, shape).toPandas()
    assert len(got) == 6 and list(got[got.doc_id == 3].n_tokens) == [4, 4]
    # Words a, b, A = a, b with a no-break space, the dotted I.
    assert set(got.train_tokens) == {2 + 6 + 5} and set(got[got.doc_id.isin([1, 2])].n_known) == {1}
    assert got[got.doc_id.isin([1, 2])].bits_per_byte.isna().all() and (got.score < 0).all()
    nothing = lm.score(df, F.lit(None).cast("boolean"), shape).toPandas()
    assert set(nothing.train_tokens) == {0} and (nothing.base_score.abs() < 1e-6).all() and set(nothing.n_known) == {0}
    assert lm.score(df.limit(0), F.lit(True), shape).count() == 0


def test_first_weights_come_from_all_training_texts(spark, few, monkeypatch):
    """Fitted in Spark and one text after another alike, and the held-out texts gain by it."""
    few_texts = [t.encode() for _, t in few]
    lexicon = lm.Lexicon([b"the", b"of"], [9, 4], 3, 50)
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(few_texts)], "key long, text string").repartition(3)
    model = lm.Model(lexicon, lm._states(df, lexicon, 14), 14)
    size = len(lm._grades()[1])
    counts = np.zeros(4 * size**3, dtype=np.int64)
    for text in few_texts:
        reading = lm.Reading(lexicon, [text])
        found = reading.decisions(np.arange(len(reading.words)), 14)
        own = [np.unique(s << np.uint32(1) | found.bit, return_counts=True) for s in found.slots]
        odds, gate = model._inputs(found, own)
        cells = np.concatenate(list(model.graded([text])))
        _, value, seen = lm._grades()
        spelled, bit, *grades = np.unravel_index(cells, (2, 2, size, size, size))
        assert (bit == found.bit).all() and (gate == (spelled * 3 + seen[grades[1]]) * 3 + seen[grades[2]]).all()
        assert max(np.abs(np.clip(odds[k], -8, 8) - value[g]).max() for k, g in enumerate(grades)) <= 0.25
        counts += np.bincount(cells, minlength=len(counts))
        # A long text is read in parts, with the same result.
        with monkeypatch.context() as m:
            m.setattr(lm, "_SEGMENT", 16)
            parts = np.concatenate(list(model.graded([text])))
        assert (parts == cells).all()
    assert (np.sort(np.concatenate(list(model.graded(few_texts)))) == np.repeat(np.arange(len(counts)), counts)).all()
    want = lm.Mixer.fitted(counts.reshape(2, 2, -1))
    got = lm._first_mixer(df, spark.sparkContext.broadcast(model), None)
    assert np.array_equal(got.weights, want.weights) and np.array_equal(got.refined, want.refined)
    fewer = lm._first_mixer(df, spark.sparkContext.broadcast(model), 3)
    assert not np.array_equal(fewer.weights, want.weights)


def test_no_training_text_is_left_out_of_the_first_weights(spark):
    """More than the 400 texts of 2 MB that they once came from: those at the end change them too."""
    common = [(i, f"alpha beta gamma delta number{i % 7}") for i in range(600)]
    weights = []
    for more in ([], [(600 + i, "omega " * 50 + "psi " * i) for i in range(40)]):
        df = spark.createDataFrame(common + more, "key long, text string")
        model = lm.Model(lm.Lexicon([b"alpha", b"omega"], [9, 9], 9, 9), bytes(2 * lm._CONTEXTS << 12), 12)
        weights.append(lm._first_mixer(df, spark.sparkContext.broadcast(model), None).refined)
    assert not np.array_equal(*weights)
    long = spark.createDataFrame([(0, "alpha omega other " * 150_000)], "key long, text string")
    assert not np.array_equal(lm._first_mixer(long, spark.sparkContext.broadcast(model), None).refined, lm.Mixer.new().refined)
