"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import datetime as dt
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablemend.llm import fingerprints, lines, mixing, packing, passages, search, simhash, toolcalls, toxicity, urls
from tablemend.llm.components import components

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
THREE = "one line\nanother line\na third line"
# Extra columns take names that the operators use themselves.
CLASH = ["row", "doc", "mark", "found", "drawn", "ids", "length", "code", "place", "part", "Lines", "component", "hit"]
ROWS = [
    (None, "no key here", "s1"),
    (1, None, "s1"),
    (2, "", None),
    (3, THREE, "s2"),
    (4, "before\n" + THREE + "\nafter", "s2"),
    (4, "before\n" + THREE + "\nafter", "s2"),
    (5, LONG, "s1"),
    (5, "another text of the same key", "s1"),
    (6, LONG, "s3"),
    (7, " \n\t ", "s1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    base = base.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    return base.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_packing(spark, docs, empty):
    got = packing.pack(docs, VOCABULARY).toPandas()
    assert packing.pack(empty, VOCABULARY).count() == 0
    assert (got[got.doc_id == 2].doc_tokens == 1).all() and (got[got.doc_id == 1].ids.map(bytes) == b"\1\0\0\0").all()
    # Repeated rows are packed each on their own, and a null key is a document too.
    assert len(got[(got.doc_id == 4) & (got.start == 0)]) == 2
    assert got.doc_id.isna().sum() == 1
    assert got.length.sum() == got[got.start == 0].doc_tokens.sum()
    assert sorted(set(got.sequence_id)) == list(range(got.sequence_id.nunique()))


@pytest.mark.parametrize("seed", range(8))
def test_closest_filling_against_all_multisets(seed):
    rng = np.random.default_rng(seed)
    counts = {int(s): int(n) for s, n in zip(rng.choice(np.arange(1, 30), 6, False), rng.integers(1, 5, 6), strict=True)}
    room = int(rng.integers(5, 60))
    totals = {0}
    for size, n in counts.items():
        totals = {t + size * i for t in totals for i in range(n + 1) if t + size * i <= room}
    chosen = packing.closest_filling(room, counts, sorted(counts, reverse=True))
    assert sum(s * n for s, n in chosen.items()) == max(totals)
    assert all(n <= counts[s] for s, n in chosen.items())
    used = {}
    for pattern in packing.plan_windows(counts, 64):
        assert sum(s * n for s, n in pattern.counts) <= 64
        for s, n in pattern.counts:
            used[s] = used.get(s, 0) + n * pattern.windows
    assert used == counts


def test_lines(spark, docs, empty):
    got = lines.dedupe_lines(docs)
    assert got.columns == [*docs.columns, "found_"]
    got = got.select("doc_id", "text", "found_.*").toPandas()
    four = got[got.doc_id == 4]
    assert list(four.text) == ["before\nafter"] * 2 and list(four.removed_lines) == [3, 3]
    assert got[got.doc_id == 3].text.item() == THREE
    assert got[got.doc_id == 1].text.item() is None and got[got.doc_id == 1].n_lines.item() == 0
    assert sorted(got[got.doc_id == 5].text) == sorted([LONG, "another text of the same key"])
    assert lines.dedupe_lines(empty).count() == 0


def test_lines_merge_overlapping_runs(spark):
    body = "\n".join(f"line {i}" for i in range(40))
    twice = f"x\n{body}\ny\n{body}\nz"
    blank = "\n\n\n\n"
    rows = spark.createDataFrame([(1, twice), (2, blank), (3, blank), (4, body)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedupe_lines(rows).collect()}
    assert got == {1: f"x\n{body}\ny\nz", 2: blank, 3: blank, 4: ""}


def test_mixing(spark, docs, empty):
    got = mixing.mix(docs, most=3.0)
    assert got.columns == [*docs.columns, "drawn_"]
    rows = got.select("doc_id", "text", "source", "drawn_.*").toPandas()
    first = rows[rows["round"] == 0]
    assert len(first) == len(ROWS)
    assert rows["round"].max() <= 3
    assert mixing.mix(empty).count() == 0
    # A source without tokens comes once.
    assert len(rows[rows.source.isna()]) == 1


def test_mixing_exponent(spark):
    totals = spark.createDataFrame([(100, 100), (50, 100), (10, 100), (0, 100)], "n long, largest long")
    power = mixing.exponent(totals, most=2.0)
    assert math.isclose(0.1 ** (power - 1), 2.0, rel_tol=1e-9)
    power = mixing.exponent(totals, entropy=1.0)
    raw = np.array([1.0, 0.5, 0.1]) ** power
    assert math.isclose(mixing.shares_entropy(list(raw / raw.sum())), 1.0, rel_tol=1e-9)
    assert mixing.exponent(totals, most=1.0) == 1.0
    assert mixing.exponent(totals, entropy=9.0) == 0.0


def test_simhash(spark, docs, empty):
    got = simhash.near_duplicates(docs).toPandas()
    assert len(got) == len(ROWS) and list(got.columns) == ["doc_id", "fingerprint", "component"]
    assert set(got[got.doc_id.isin([1, 2, 7])].fingerprint) == {0}
    assert set(got[got.doc_id.isin([1, 2, 7])].component) == {1}
    assert set(got[got.doc_id == 4].component) == {4}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # One of the copies of the long text stays, the other text of its key too, and the row without a key.
    assert kept.where(F.col("text") == LONG).count() == 1
    assert sorted(r[0] or 0 for r in kept.select("doc_id").collect()) == [0, 1, 3, 4, 5, 5]
    assert simhash.one_of_each(empty).count() == 0


@pytest.mark.parametrize(("bits", "largest"), [(3, 4096), (3, 2), (7, 40)])
def test_links_of_dense_and_divided_groups(spark, bits, largest):
    """Groups larger than allowed are divided without losing a link."""
    rng = np.random.default_rng(bits)
    codes = np.repeat(rng.integers(0, 2**63, 12, dtype=np.uint64), 25)
    for _ in range(bits):
        codes ^= np.uint64(1) << rng.integers(0, 64, len(codes), dtype=np.uint64)
    codes = np.unique(codes)
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    got = {r.node: r.component for r in components(simhash.linked(frame, bits, largest)).collect()}
    label = codes.view(np.int64).copy()
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= bits
    while not (label == (new := np.array([label[n].min() for n in near]))).all():
        label = new
    assert [got.get(c, c) for c in codes.view(np.int64).tolist()] == label.tolist()


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(7000, 7000), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0}
    assert {got[i] for i in range(1000, 1100)} == {1000}
    assert got[7000] == 7000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_toxicity(spark, docs, empty):
    bad = [(i, f"some calm words here. you vile creature {i}.", 1) for i in range(100, 130)]
    good = [(i, f"some calm words here. a kind creature {i}. and more.", 0) for i in range(200, 260)]
    rows = spark.createDataFrame([(i, t) for i, t, _ in bad + good], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in bad + good] + [(None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.fit(rows, labels)
    scores = {r.doc_id: r.s for r in rows.select("doc_id", toxicity.score(model, "text").alias("s")).collect()}
    assert min(scores[i] for i, *_ in bad) > 0.5 > 0.2 > max(scores[i] for i, *_ in good)
    found = toxicity.offending_sentences(rows, model).toPandas()
    assert set(found.doc_id) == {i for i, *_ in bad}
    assert found.sentence.str.contains("vile").all()
    text = dict((i, t) for i, t, _ in bad)
    assert all(text[r.doc_id][r.start : r.stop] == r.sentence for r in found.itertuples())
    edge = docs.select("doc_id", "text", toxicity.score(model, "text").alias("s")).toPandas()
    assert edge.s.between(0, 1).all()
    assert edge[edge.doc_id.isin([1, 2, 7])].s.nunique() == 1
    assert empty.select(toxicity.score(model, "text")).count() == 0
    # No labels at all: nothing is toxic. One label only: everything is like it.
    assert toxicity.fit(rows, labels.limit(0)).score("vile") == 0
    assert toxicity.fit(rows, labels.where("toxic = 1")).score("anything") > 0.99


def test_imatch(spark, docs, empty):
    pairs = fingerprints.with_next(docs, parts=3).toPandas()
    assert len(pairs) == len(ROWS) and pairs.place.is_unique
    after = pairs.set_index("place")
    # Following `next_place` goes round all rows, in the order of the keys.
    at = pairs[pairs.doc_id.isna()].place.item()
    keys = []
    for _ in ROWS:
        keys.append(after.doc_id[at])
        assert after.next_text[at] == after.text[after.next_place[at]]
        at = after.next_place[at]
    assert keys[1:] == sorted(keys[1:]) and at == pairs[pairs.doc_id.isna()].place.item()
    assert fingerprints.with_next(empty).count() == 0
    assert fingerprints.with_next(docs.where("doc_id = 3")).first().next_text == THREE
    one, other = F.lit("aa--bb-"), F.lit("aa-cc-dd-")
    assert spark.range(1).select(fingerprints.likeness(one, other)).first()[0] == 1 / 3
    assert spark.range(1).select(fingerprints.likeness(F.lit("=a"), F.lit("=b"))).first()[0] == 0


def test_passages(spark, docs, empty):
    got = passages.shared_passages(docs).toPandas()
    pair = got[(got.doc_id == 6) & (got.first_doc_id == 5)]
    assert len(pair) == 1 and pair.common.item() == 30_000
    assert set(got.doc_id) <= {5, 6}
    assert passages.shared_passages(empty).count() == 0


def test_fuzzy_passage_is_chained(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 400)]
    copy = words[100:300].copy()
    for i in range(12, 200, 30):
        copy[i] = "other"
    del copy[75], copy[120:122]
    around = [f"v{i}" for i in rng.integers(0, 10**6, 100)]
    rows = [(1, " ".join(words)), (2, " ".join(around[:50] + copy + around[50:])), (3, " ".join(around[:45]))]
    got = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(2, 1), (3, 2)}
    long = next(r for r in got if r.doc_id == 2)
    assert abs(long.start - 50) <= 3 and abs(long.stop - 247) <= 3
    assert abs(long.first_start - 100) <= 3 and abs(long.first_stop - 300) <= 3


def test_passage_in_many_documents_stays_linear(spark):
    body = " ".join(f"t{i}" for i in range(120))
    rows = spark.createDataFrame([(i, f"a{i} {body} b{i}") for i in range(300)], "doc_id long, text string")
    got = passages.shared_passages(rows)
    assert got.where("first_doc_id = 0").count() == got.count() == 299


def test_fenwick_against_a_plain_maximum():
    rng = np.random.default_rng(1)
    tree, plain = passages.Fenwick(50), {}
    for owner in range(300):
        place, value, below = int(rng.integers(0, 50)), float(rng.normal()), int(rng.integers(0, 51))
        tree.put(place, value, owner)
        plain.setdefault(place, []).append(value)
        values = [v for p, vs in plain.items() if p < below for v in vs]
        assert tree.best(below)[0] == (max(values) if values else 0.0)


def test_common_words_against_the_table():
    rng = np.random.default_rng(2)
    for _ in range(60):
        one, other = ([b"%d" % x for x in rng.integers(0, 5, rng.integers(0, 25))] for _ in range(2))
        table = np.zeros((len(one) + 1, len(other) + 1), dtype=int)
        for i, a in enumerate(one):
            for j, b in enumerate(other):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        assert passages.common_words(one, other) == table[-1, -1]


def test_search(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [int(x) for x in rng.integers(-9, 10, 6)]) for i in range(200)]
    rows += [(50, rows[50][1]), (300, None), (301, [1, None]), (None, [1, 2]), (302, []), (303, [0] * 6), (304, [5])]
    frame = spark.createDataFrame(rows, "vec_id long, weights array<long>").withColumn("score", F.lit(1))
    queries = frame.where("vec_id in (0, 50, 100, 300, 303)")
    got = search.top_k(frame, queries, k=5, shard_rows=32, block_rows=2).collect()
    whole = [(i, w + [0] * (6 - len(w))) for i, w in rows if i is not None and w is not None and None not in w]
    want = []
    for q, v in [r for r in whole if r[0] in (0, 50, 100, 303)]:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    # A repeated query is one query.
    assert sorted(tuple(r) for r in got) == sorted(set(want))
    assert search.top_k(frame.limit(0), queries).count() == 0
    assert search.top_k(frame, queries.limit(0)).count() == 0
    few = search.top_k(frame.where("vec_id < 3"), frame.where("vec_id = 0"))
    assert few.count() == 2


def test_urls(spark):
    day = [dt.datetime(2024, 1, d) for d in range(1, 20)]
    entries = spark.createDataFrame(
        [
            ("a", "bad.org", "add", day[2]),
            ("a", "bad.org", "add", day[3]),
            ("a", "bad.org", "remove", day[5]),
            ("a", "bad.org", "add", day[9]),
            ("b", "Good.net:8080/X/y/", "add", day[0]),
            ("c", "Gone.ORG", "add", day[0]),
            ("c", "http://gone.org/", "remove", day[3]),
            ("c", "/nothing", "add", day[0]),
            ("b", "tie.com", "add", day[0]),
            ("b", "tie.com", "remove", day[0]),
            ("b", None, "add", day[0]),
            ("b", "odd.com", "other", day[0]),
        ],
        "list string, pattern string, action string, dated timestamp_ntz",
    )
    rows = [
        (1, "http://www.BAD.org/x", day[1]),
        (2, "http://www.bad.org:80/x", day[2]),
        (3, "https://u@bad.org", day[4]),
        (4, "https://notbad.org/", day[4]),
        (5, "https://bad.org/", day[5]),
        (6, "https://bad.org/", day[18]),
        (7, "https://good.net/X/y/z?q=1", day[1]),
        (8, "https://good.net/X/yy", day[1]),
        (13, "https://good.net/x/y", day[1]),
        (14, "gone.org:80/a", day[2]),
        (15, "https://gone.org/a", day[4]),
        (9, None, day[1]),
        (10, "https://bad.org/", None),
        (None, "https://bad.org/", day[4]),
        (6, "https://bad.org/", day[18]),
        (11, "", day[4]),
        (12, "https://tie.com/", day[4]),
    ]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp_ntz").withColumn("hit", F.lit(0))
    got = urls.judge(captures, entries).toPandas()
    assert len(got) == len(rows)
    blocked = sorted(got[got.blocked].page_id.fillna(0))
    assert blocked == [0, 2, 3, 6, 6, 7, 14]
    assert urls.listed_at_fetch(captures, entries).columns[-1] == "hit_"
    assert urls.judge(captures.limit(0), entries).count() == 0
    assert not urls.judge(captures, entries.limit(0)).where("blocked").count()


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "f", '{"y": 2, "x": "q"}', ["b"]),
            (1, "b", 3, "f", '{"x": 1}', []),
            (1, "a", 9, "f", "{}", []),
            (1, "c", 5, "g", "{}", None),
            (1, "d", 7, None, None, ["zz", None]),
            (2, "p", 1, "f", '{"x":"s","y":null}', ["q"]),
            (2, "q", 2, "f", '{"x":"s","y":"t","k":1}', ["p"]),
            (None, "a", 1, "f", "{}", []),
            (3, None, 1, "f", "{}", []),
        ],
        "conv_id long, call_id string, turn long, name string, arguments string, uses array<string>",
    )
    results = spark.createDataFrame(
        [(1, "a", 4, "one"), (1, "a", 2, 'the "first"'), (1, "x", 6, "lost"), (2, "p", 3, None)],
        "conv_id long, call_id string, turn long, content string",
    )
    schemas = spark.createDataFrame(
        [("f", "x", "string", True), ("f", "y", "integer", False)], "tool string, field string, kind string, required boolean"
    )
    links = toolcalls.validated(toolcalls.ordered(toolcalls.linked(calls, results), rounds=4), schemas)
    got = {(r.conv_id, r.call_id): r for r in links.collect()}
    assert got[1, "a"].repeats == 2 and got[1, "a"].content == 'the "first"'
    assert (got[1, "a"].order, got[1, "a"].place) == ("moved", 4)
    assert {k: r.status for k, r in got.items()} == {
        (1, "a"): "linked",
        (1, "b"): "no_result",
        (1, "c"): "no_result",
        (1, "d"): "no_result",
        (1, "x"): "no_call",
        (2, "p"): "linked",
        (2, "q"): "no_result",
    }
    assert got[1, "d"].order == "missing" and got[2, "p"].order == got[2, "q"].order == "cycle"
    assert got[1, "a"].problems == []
    assert got[1, "b"].problems == ["kind:x"]
    assert got[1, "c"].problems == ["unknown_tool"]
    assert got[2, "p"].problems == []
    assert got[2, "q"].problems == ["kind:y", "unknown:k"]
    lines_ = {(r.conv_id, r.call_id, r.part): r.line for r in toolcalls.messages(links).collect()}
    assert lines_[1, "a", 0] == '{"arguments":{"x":"q","y":2},"call_id":"a","name":"f","role":"assistant"}'
    assert lines_[1, "a", 1] == '{"call_id":"a","content":"the \\"first\\"","role":"tool"}'
    assert lines_[2, "p", 1] == '{"call_id":"p","content":"","role":"tool"}'
    assert len(lines_) == 6 + 3
    none = toolcalls.validated(toolcalls.ordered(toolcalls.linked(calls.limit(0), results.limit(0))), schemas.limit(0))
    assert toolcalls.messages(none).count() == 0
    turns = spark.createDataFrame([(1, 0, "system", LONG), (1, 1, None, None)], "conv_id long, turn int, role string, text string")
    plain = {r.place: r.line for r in toolcalls.plain_messages(turns.withColumn("line", F.lit(0))).collect()}
    assert plain == {0: f'{{"content":"{LONG}","role":"system"}}', 1: '{"content":"","role":""}'}


def test_pipeline_stages_on_odd_rows(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(1, 0), (3, 0), (4, 0)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, empty):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            before = rows
            rows = stage(spark, rows, str(tmp_path))
            if name != "packing":
                assert rows.columns == before.columns, name
        rows.collect()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
