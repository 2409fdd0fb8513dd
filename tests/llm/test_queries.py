"""Every operator's query over small tables: its SQL where there is one, a plain version elsewhere."""

import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from oracle import compare, duck
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["op1_line_dedup", "op7_url_lists", "op9_tool_calls", "op10_maxscore"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF_DIR), SF_DIR, queries()[name], oracle_sql()[name])


@pytest.mark.parametrize("number", range(1, 14))
def test_one_query_for_each_operator(number):
    assert len([n for n in queries() if n.startswith(f"op{number}_")]) == 1


def test_packed_ids_are_the_tokenizers(spark, docs):
    got = queries()["op3_packing"](spark, SF_DIR).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(got.doc_id) == set(docs.doc_id)
    text = docs.set_index("doc_id").text
    for doc, pieces in got.groupby("doc_id"):
        ids = [*tokenizer.encode(text[doc] or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in pieces.sort_values("start").itertuples():
            part = np.array(ids[at : at + p.length], dtype="<u4")
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += p.length
        assert at == len(ids)
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        ends = pieces.length.cumsum()
        assert list(pieces.offset) == [0, *ends[:-1]]
        assert ends.iloc[-1] <= 2048
    assert got.length.sum() / (2048 * got.sequence_id.nunique()) > 0.97


def test_passages_hold_and_long_copies_are_found(spark, docs):
    from tablemend.llm import passages as p

    got = p.shared_passages(spark.createDataFrame(docs)).toPandas()
    words = {d: p.split_words(t) for d, t in zip(docs.doc_id, docs.text, strict=True)}
    covered = defaultdict(set)
    for r in got.itertuples():
        here, there = words[r.doc_id][r.start : r.stop], words[r.first_doc_id][r.first_start : r.first_stop]
        assert b" ".join(here).decode() == r.passage
        assert p.common_words(here, there) == r.common >= 0.8 * max(len(here), len(there))
        assert (r.first_doc_id, r.first_start) < (r.doc_id, r.start)
        covered[r.doc_id] |= set(range(r.start, r.stop))
    seen, missed, runs = {}, 0, 0
    for d in docs.doc_id:
        for i in range(len(words[d]) - 49):
            first = seen.setdefault(tuple(words[d][i : i + 50]), (d, i))
            if first != (d, i):
                runs += 1
                missed += len(set(range(i, i + 50)) - covered[d]) > 5
    assert runs > 100
    assert missed == 0


def test_imatch_contract(spark, docs):
    got = queries()["op5_imatch"](spark, SF_DIR).toPandas().sort_values("doc_id").reset_index(drop=True)
    texts = [t or "" for t in docs.text]
    for i, text in enumerate(texts):
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[(i + 1) % len(texts)][:half]
        row = got.iloc[i]
        assert (row.doc_id, row.n_chars) == (docs.doc_id[i], len(text))
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got.assign(text=texts).groupby("text").fingerprint.nunique().max() == 1
    assert got[["near_edited", "near_next"]].stack().between(0, 1).all()
    assert got.near_edited.mean() > 3 * got.near_next.mean()


def test_imatch_against_plain_python(spark, docs):
    """Both fingerprints of the query from plain sets: distinct words in the band, sorted, hashed by subset."""
    import regex

    from tablemend.llm import fingerprints as fp

    lexicons = fp.Lexicons()
    got = queries()["op5_imatch"](spark, SF_DIR).toPandas().set_index("doc_id")

    def signed(x):
        return x - 2**64 if x >> 63 else x

    def chain(values, seed=42):
        for v in values:
            seed = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), seed)
        return seed

    def words(text):
        return {signed(xxhash.xxh64_intdigest(w, 42)) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}

    counts = defaultdict(int)
    texts = [t or "" for t in docs.text]
    for text in texts:
        for t in words(text):
            counts[t] += 1
    most = max(int(len(texts) * np.exp(-lexicons.least_idf)), lexicons.least_documents)

    def plain(text):
        found = words(text)
        least = min(max(int(np.ceil(np.log2(max(len(found), 1) / lexicons.terms))), 1), lexicons.levels)
        kept = sorted(t for t in found if lexicons.least_documents <= counts[t] <= most)
        parts = []
        for group in range(lexicons.groups):
            start = xxhash.xxh64_intdigest(group.to_bytes(4, "little"), 42)
            level = {t: (h & -h).bit_length() - 1 for t in kept for h in [chain([t], start) or 2**63]}
            for k in range(1, lexicons.levels + 1):
                chosen = [t for t in kept if level[t] >= k] if k >= least else []
                parts.append(f"{chain(chosen):016x}"[:8] if chosen else "")
        return "-".join(parts) if any(parts) else "="

    for i, d in enumerate(docs.doc_id):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[(i + 1) % len(texts)][:half]
        for name, text in (("fingerprint", texts[i]), ("edited_fingerprint", edited)):
            want, have = plain(text), got[name][d]
            assert (have[:1] if want == "=" else have) == want


def test_simhash_components_against_all_pairs(spark, docs):
    got = queries()["op6_simhash"](spark, SF_DIR).toPandas().set_index("doc_id")
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    codes = {}
    for d, text in zip(docs.doc_id, docs.text, strict=True):
        words = (text or "").encode().translate(lower).split()
        runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in runs]
        codes[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got.fingerprint[d] == f"{codes[d]:016x}"
    ids = sorted(codes)
    value = np.array([codes[d] for d in ids], dtype=np.uint64)
    label = np.array(ids)
    near = np.bitwise_count(value[:, None] ^ value[None, :]) <= 3
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    assert list(got.component_id[ids]) == list(label)


def test_toxicity_learns_from_its_fold_only(spark, docs):
    sf_dir = "/root/testdata/sf0.1"
    got = queries()["op8_toxicity"](spark, sf_dir).toPandas()
    assert got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    assert list(got.held_out) == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.94
    assert held[held.toxic == 1].predicted.mean() > 0.7
    assert held[held.toxic == 0].predicted.mean() < 0.04


def test_mixing_meets_its_budgets(spark, docs):
    from tablemend.llm import mixing

    got = queries()["op2_mixing"](spark, SF_DIR).toPandas()
    size = docs.assign(n=[len((t or "").split()) for t in docs.text]).set_index("doc_id")
    totals = size.groupby("source").n.sum()
    low, high = 0.0, 1.0
    for _ in range(42):
        middle = (low + high) / 2
        low, high = (low, middle) if (totals.min() / totals.max()) ** (middle - 1) <= 2 else (middle, high)
    taken = got.assign(n=size.n[got.doc_id].to_numpy()).groupby("source").n.sum()
    for source, total in totals.items():
        budget = total * (total / totals.max()) ** (high - 1)
        assert 0 <= taken[source] - budget <= size.n[size.source == source].max() + 1e-6
    assert set(got.doc_id) == set(docs.doc_id)
    assert not got.duplicated(["doc_id", "round"]).any()
    assert got["round"].max() <= 1
    assert json.dumps(mixing.shares_entropy([0.5, 0.5]))[:6] == "0.6931"
