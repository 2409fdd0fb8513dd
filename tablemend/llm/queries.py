"""One query per operator, each over a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.llm import (
    fingerprints,
    lines,
    lm,
    mixing,
    negatives,
    packing,
    passages,
    search,
    simhash,
    toolcalls,
    toxicity,
    urls,
    variants,
)
from tablemend.llm.registry import ORACLES, QUERIES, query, table
from tablemend.session import materialize

__all__ = ["ORACLES", "QUERIES"]

VOCABULARY = "word_bpe_49k.json"
TOXIC = 0.3


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return packing.pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(VOCABULARY),
        measures={"ids_crc32": F.crc32("ids")},
        keep_ids=False,
    )


def in_fold(key: str = "doc_id") -> Column:
    """Whether the fixed rule holds a row out: its key's checksum leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~in_fold()))
    scored = docs.select("doc_id", in_fold().alias("held_out"), toxicity.score(model, "text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= TOXIC, 1).otherwise(0))


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents over three-word shingles and the components at three bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=3)
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), F.col("component").alias("component_id"))


@query(lines.OP1_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents before and after repeated runs of three are gone."""
    found = lines.dedupe_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "found.n_lines", "found.removed_lines", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


@query()
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as often as sources mixed to at most two rounds ask for."""
    found = mixing.mix(table(spark, sf_dir, "documents"), most=2.0)
    return found.select("doc_id", "source", F.col("drawn.round").alias("round"), F.col("drawn.place").alias("block_rank"))


OP10_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_sum(list_transform(list_zip(q.w, v.w), lambda p: p[1] * p[2])) AS score
  FROM whole q JOIN whole v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 5
"""


@query(OP10_SQL)
def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    whole = table(spark, sf_dir, "embeddings").where(
        F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    )
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    vectors = whole.select("vec_id", scaled.alias("weights"))
    return search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query()
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, and how like they are to those of half-edited texts and of the next documents."""
    lexicons = fingerprints.Lexicons()
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = fingerprints.with_next(table(spark, sf_dir, "documents"), parts=min(1000, 4 * shuffles))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    digest = lambda text: F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0"))
    words = texts.withColumn("edited", edited).withColumns(
        {"terms_0": fingerprints.terms("text"), "terms_1": fingerprints.terms("edited")}
    )
    rows = materialize(
        words.select(
            "doc_id",
            "place",
            "next_place",
            n.cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            F.size("terms_0").alias("n_words_0"),
            F.size("terms_1").alias("n_words_1"),
            F.concat(*[fingerprints.entries(f"terms_{i}", i, lexicons) for i in (0, 1)]).alias("entries"),
            digest("text").alias("text_hash"),
            digest("edited").alias("edited_hash"),
        ),
        "entries",
    )
    listed = table(spark, sf_dir, "documents").select(fingerprints.terms("text").alias("terms"))
    lexicon = fingerprints.band(listed, lexicons)
    versions = {"fingerprint": "text_hash", "edited_fingerprint": "edited_hash"}
    found = materialize(fingerprints.fingerprints(rows, versions, "place", lexicon, lexicons), "imatch")
    following = found.select(F.col("place").alias("at"), F.col("fingerprint").alias("next_fingerprint"))
    return found.join(following, F.col("next_place") == F.col("at")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


@query()
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and links by passages of at least 40 words that some earlier document, or the same
    one before, has alike, and how many of its words are in these."""
    docs = table(spark, sf_dir, "documents")
    return passages.linked_documents(docs, passages.shared_passages(docs))


# Tools that the calls of op9 name, a row for each field.
TOOL_FIELDS = [
    ("search", "query", "string", True),
    ("search", "limit", "integer", True),
    ("translate", "text", "string", True),
    ("translate", "target", "string", True),
    ("lookup", "key", "string", True),
    ("lookup", "exact", "boolean", False),
]

OP9_SQL = """
WITH calls AS (
  SELECT conv_id, 'c' || turn AS call_id, turn, length(text) AS n, text,
    CAST(to_json(text) AS VARCHAR) AS head, (turn // 2) % 3 AS kind
  FROM conversations WHERE role = 'assistant'),
given AS (
  SELECT *, CASE n % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'translate' WHEN 2 THEN 'lookup' ELSE 'mystery' END AS name,
    CASE WHEN kind = 0 THEN ['c' || (turn + 2)] WHEN kind = 2 THEN ['c' || (turn - 2)] ELSE [] END AS uses FROM calls),
argued AS (
  SELECT *,
    CASE WHEN n % 11 = 0 THEN CAST(to_json('oops ' || text) AS VARCHAR)
      WHEN name = 'search' AND n % 7 = 0 THEN '{"limit":"many","query":' || head || '}'
      WHEN name = 'search' THEN '{"limit":' || n || ',"query":' || head || '}'
      WHEN name = 'translate' AND n % 5 = 0 THEN '{"text":' || head || '}'
      WHEN name = 'translate' THEN '{"target":"en","text":' || head || '}'
      WHEN name = 'lookup' AND n % 3 = 0 THEN '{"exact":true,"fuzzy":1.5,"key":' || head || '}'
      WHEN name = 'lookup' THEN '{"exact":false,"key":' || head || '}'
      ELSE '{"text":' || head || '}' END AS arguments,
    CASE WHEN name = 'mystery' THEN 'unknown_tool'
      WHEN n % 11 = 0 THEN 'not_json'
      WHEN name = 'search' AND n % 7 = 0 THEN 'kind:limit'
      WHEN name = 'translate' AND n % 5 = 0 THEN 'missing:target'
      WHEN name = 'lookup' AND n % 3 = 0 THEN 'unknown:fuzzy'
      ELSE '' END AS problems
  FROM given),
results AS (
  SELECT conv_id, 'c' || (turn - 1) AS call_id, turn AS result_turn, text AS content
  FROM conversations WHERE role = 'user' AND turn > 0),
used AS (
  SELECT a.*, b.turn AS used_turn, b.uses AS used_uses
  FROM argued a LEFT JOIN argued b ON b.conv_id = a.conv_id AND b.call_id = a.uses[1]),
placed AS (
  SELECT *, CASE WHEN used_turn >= turn THEN used_turn + 1 ELSE turn END AS first_place FROM used),
twice AS (
  SELECT p.*, CASE WHEN q.first_place >= p.first_place THEN q.first_place + 1 ELSE p.first_place END AS place
  FROM placed p LEFT JOIN placed q ON q.conv_id = p.conv_id AND q.call_id = p.uses[1]),
joined AS (
  SELECT coalesce(t.conv_id, r.conv_id) AS conv_id, coalesce(t.call_id, r.call_id) AS call_id, t.name, t.arguments,
    r.content, coalesce(t.place, r.result_turn) AS place,
    CASE WHEN t.call_id IS NULL THEN 'no_call' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    CASE WHEN len(t.uses) > 0 AND t.used_turn IS NULL THEN 'missing'
      WHEN t.place > t.turn THEN 'moved' ELSE 'as_given' END AS sequence,
    coalesce(t.problems, '') AS problems
  FROM twice t FULL JOIN results r ON r.conv_id = t.conv_id AND r.call_id = t.call_id)
SELECT conv_id, CAST(place AS BIGINT) AS place, 0 AS part, call_id, status, sequence, problems,
  '{"arguments":' || arguments || ',"call_id":"' || call_id || '","name":"' || name || '","role":"assistant"}' AS line
FROM joined WHERE status <> 'no_call'
UNION ALL
SELECT conv_id, CAST(place AS BIGINT), 1, call_id, status, sequence, problems,
  '{"call_id":"' || call_id || '","content":' || CAST(to_json(content) AS VARCHAR) || ',"role":"tool"}'
FROM joined WHERE status <> 'no_result'
UNION ALL
SELECT conv_id, CAST(turn AS BIGINT), 2, NULL, 'plain', 'as_given', '',
  '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}'
FROM conversations WHERE role <> 'assistant' AND NOT (role = 'user' AND turn > 0)
"""


@query(OP9_SQL)
def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the tool calls that assistants' turns stand for, with the user's next turn as the result, and all other
    turns as plain messages.

    What a call is named, given and built on follows from the length and the place of its turn.
    """
    turns = table(spark, sf_dir, "conversations")
    n, head = F.length("text"), toolcalls.quoted("text")
    name = F.element_at(F.array(*map(F.lit, ("search", "translate", "lookup", "mystery"))), (n % 4 + 1).cast("int"))
    kind = F.floor(F.col("turn") / 2) % 3

    def given(form: str) -> Column:
        return F.format_string(form, head)

    arguments = (
        F.when(n % 11 == 0, F.concat(F.lit("oops "), "text"))
        .when((n % 4 == 0) & (n % 7 == 0), given('{"query": %s, "limit": "many"}'))
        .when(n % 4 == 0, F.format_string('{"query": %s, "limit": %d}', head, n))
        .when((n % 4 == 1) & (n % 5 == 0), given('{"text": %s}'))
        .when(n % 4 == 1, given('{"text": %s, "target": "en"}'))
        .when((n % 4 == 2) & (n % 3 == 0), given('{"key": %s, "fuzzy": 1.50, "exact": true}'))
        .when(n % 4 == 2, given('{"key": %s, "exact": false}'))
        .otherwise(given('{ "text": %s }'))
    )

    def call_id(shift: int) -> Column:
        return F.concat(F.lit("c"), F.col("turn") + shift)

    uses = F.when(kind == 0, F.array(call_id(2))).when(kind == 2, F.array(call_id(-2))).otherwise(F.array().cast("array<string>"))
    calls = turns.where("role = 'assistant'").select(
        "conv_id", call_id(0).alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), uses.alias("uses")
    )
    results = turns.where("role = 'user' AND turn > 0").select(
        "conv_id", call_id(-1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    schemas = spark.createDataFrame(TOOL_FIELDS, "tool string, field string, kind string, required boolean")
    links = toolcalls.ordered(toolcalls.linked(calls, results))
    called = toolcalls.messages(toolcalls.validated(links, schemas))
    others = toolcalls.plain_messages(turns.where("role <> 'assistant' AND NOT (role = 'user' AND turn > 0)"))
    return called.unionByName(others).select(
        "conv_id", "place", "part", "call_id", "status", F.col("order").alias("sequence"),
        F.array_join("problems", ",").alias("problems"), "line",
    )


OP7_SQL = r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * ((page_id * 37) % 8760) AS fetched_at,
    lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
    regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', '') AS path
  FROM pages),
hosts AS (SELECT host, min(page_id) AS m FROM captures GROUP BY host),
dated AS (
  SELECT 'hosts' AS list, host AS pattern, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (m % 200) AS valid_from,
    TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (m % 200 + 60) AS valid_to FROM hosts WHERE m % 3 <> 0
  UNION ALL
  SELECT 'hosts', host, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (m % 200 + 120), TIMESTAMP '9999-12-31'
  FROM hosts WHERE m % 3 = 1
  UNION ALL
  SELECT 'paths', host || '/en', TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (m % 50), TIMESTAMP '9999-12-31'
  FROM hosts WHERE m % 2 = 0
  UNION ALL
  SELECT 'domains', regexp_replace(host, '^[^.]*\.', ''), TIMESTAMP '2024-07-01', TIMESTAMP '2024-10-01'
  FROM hosts GROUP BY regexp_replace(host, '^[^.]*\.', '') HAVING min(m) % 4 = 1
  UNION ALL
  SELECT 'written', host || '/en', TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (m % 40),
    TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (m % 40 + 90) FROM hosts WHERE m % 5 IN (1, 2)
  UNION ALL
  SELECT 'written', host || '/EN', TIMESTAMP '2024-01-01', TIMESTAMP '9999-12-31' FROM hosts WHERE m % 5 = 3),
hits AS (
  SELECT c.page_id, d.list, d.pattern FROM captures c JOIN dated d
    ON (c.host = d.pattern OR ends_with(c.host, '.' || d.pattern)
      OR starts_with(c.host || c.path || '/', d.pattern || '/'))
    AND c.fetched_at >= d.valid_from AND c.fetched_at < d.valid_to),
counted AS (SELECT page_id, count(*) AS hits, min({'a': list, 'b': pattern}) AS first FROM hits GROUP BY page_id)
SELECT c.page_id, c.url, c.fetched_at, h.hits IS NOT NULL AS blocked, CAST(coalesce(h.hits, 0) AS BIGINT) AS hits,
  h.first.a AS hit_list, h.first.b AS hit_pattern
FROM captures c LEFT JOIN counted h ON h.page_id = c.page_id
"""


@query(OP7_SQL)
def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against dated lists of hosts, paths and domains, which are drawn from the pages' own hosts."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")

    def after(days: Column) -> Column:
        return start + F.make_dt_interval(days.cast("int"))

    hours = F.make_dt_interval(hours=(F.col("page_id") * 37 % 8760).cast("int"))
    captures = table(spark, sf_dir, "pages").select("page_id", "url", (start + hours).alias("fetched_at"))
    hosts = captures.groupBy(urls.host("url").alias("host")).agg(F.min("page_id").alias("m"))
    domain = F.regexp_replace("host", r"^[^.]*\.", "")
    domains = hosts.groupBy(domain.alias("host")).agg(F.min("m").alias("m")).where(F.col("m") % 4 == 1)
    day = F.col("m") % 200

    def entry(rows: DataFrame, name: str, pattern: Column, action: str, dated: Column) -> DataFrame:
        return rows.select(
            F.lit(name).alias("list"), pattern.alias("pattern"), F.lit(action).alias("action"), dated.alias("dated")
        )

    host = F.col("host")
    listed = hosts.where(F.col("m") % 3 != 0)
    written = hosts.where((F.col("m") % 5).isin(1, 2))
    entries = (
        entry(listed, "hosts", host, "add", after(day))
        .union(entry(listed, "hosts", host, "remove", after(day + 60)))
        .union(entry(hosts.where(F.col("m") % 3 == 1), "hosts", host, "add", after(day + 120)))
        .union(entry(hosts.where(F.col("m") % 2 == 0), "paths", F.concat(host, F.lit("/en")), "add", after(F.col("m") % 50)))
        .union(entry(domains, "domains", host, "add", after(F.lit(182))))
        .union(entry(domains, "domains", host, "remove", after(F.lit(274))))
        # The same pattern with a scheme, a port and capitals is taken off again in its plain form.
        .union(entry(written, "written", F.concat(F.upper(host), F.lit(":8080/en/")), "add", after(F.col("m") % 40)))
        .union(entry(written, "written", F.concat(F.lit("http://"), host, F.lit("/en")), "remove", after(F.col("m") % 40 + 90)))
        # Paths keep their case, so this covers no page under /en.
        .union(entry(hosts.where(F.col("m") % 5 == 3), "written", F.concat(host, F.lit("/EN")), "add", after(F.lit(0))))
    )
    return urls.judge(captures, materialize(entries, "entries"))


@query()
def op11_mixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under word counts and under mixed context models.

    Both learn from the documents whose key's checksum does not leave 0 when divided by 10.
    """
    docs = table(spark, sf_dir, "documents")
    training = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0, F.lit(True))
    return lm.score(docs, training)


WORDS = r"[a-z\u00C0-\u00FF]+"


@query()
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the words one letter apart and the form each is a variant of.

    One run in some 199, by a checksum of document and run, loses a letter first.
    """
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", F.explode(variants.runs("text", WORDS)).alias("run"))
    tagged = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    hashed = found.select("run", F.crc32(tagged.cast("binary")).alias("h"))
    at = F.col("h") % F.length("run")
    cut = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
    word = F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.length("word") >= 6).groupBy("word").agg(F.count("*").alias("n"))
    return variants.variants(counted.where("n >= 5"))


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    list_sum(list_transform(list_zip(a.w, v.w), lambda p: p[1] * p[2])) AS score
  FROM whole a JOIN whole v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score,
  CAST(negative_score AS BIGINT) AS negative_score FROM ranked WHERE rank <= 5
"""


@query(OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score nearly as high as the positives of every vector whose id is divisible by 100."""
    whole = table(spark, sf_dir, "embeddings").where(
        F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    )
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = whole.select("vec_id", label.alias("label"), scaled.alias("weights"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)
