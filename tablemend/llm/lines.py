"""Line dedup: passages of consecutive lines that occurred before are removed.

Every run of three lines is hashed. A run seen more than once keeps its first occurrence, by key and place; the lines
of all later ones are covered, overlapping runs merge, and covered lines go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.names import free_name

_BREAK = "\n"


def _marked(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows as `row`, with their key, a hash of the text that tells apart rows of one key, and their lines."""
    return docs.select(
        F.struct("*").alias("row"),
        F.col(key).alias("doc"),
        F.xxhash64(text).alias("mark"),
        F.split(text, _BREAK).alias("lines"),
    )


def windows(docs: DataFrame, size: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Hashes (128 bits) of all runs of `size` lines: doc, mark, place, h1, h2. Runs of blank lines only are left out."""
    starts = F.when(F.size("lines") >= size, F.sequence(F.lit(0), F.size("lines") - size))
    runs = _marked(docs, text, key).select("doc", "mark", "lines", F.explode(starts).alias("place"))
    parts = [F.get("lines", F.col("place") + i) for i in range(size)]
    filled = runs.where(F.trim(F.concat(*parts)) != "")
    return filled.select(
        "doc", "mark", "place", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(size), *parts).alias("h2")
    )


def covered(docs: DataFrame, size: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Starts of the runs that occurred before: doc, mark, starts (sorted)."""
    runs = windows(docs, size, text, key)
    first = (
        runs.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc", "mark", "place")).alias("first"))
        .where("n > 1")
        .select("h1", "h2", "first")
    )
    here = F.struct("doc", "mark", "place")
    later = runs.join(first, ["h1", "h2"]).where(~here.eqNullSafe(F.col("first")))
    return later.groupBy("doc", "mark").agg(F.sort_array(F.collect_set("place")).alias("starts"))


def _kept(lines: Column, starts: Column, size: int) -> Column:
    """Lines outside the covered runs: what lies between the end of one start's run and the next start."""
    n = F.size(starts)

    def between(i: Column) -> Column:
        low = F.when(i == 0, 0).otherwise(F.get(starts, i - 1) + size)
        high = F.when(i == n, F.size(lines)).otherwise(F.get(starts, i))
        return F.slice(lines, low + 1, F.greatest(high - low, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), n), between))


def dedupe_lines(docs: DataFrame, size: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows with their columns, `text` without repeated runs of lines, and as a struct `found` (underscores are added
    where a column has that name) the numbers n_lines and removed_lines.

    Lines end at line feeds and are compared as they are. Rows of one key are ordered by a hash of their text; rows
    that repeat both are one document and keep or lose the same lines. Null keys come first. A null text stays null and
    has no lines; an empty text has one. A text whose lines all go becomes empty. Texts of fewer than `size` lines and
    empty tables come back unchanged.
    """
    starts = covered(docs, size, text, key).select(
        F.col("doc").alias("of_doc"), F.col("mark").alias("of_mark"), "starts"
    )
    rows = _marked(docs, text, key)
    same = F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("mark") == F.col("of_mark"))
    kept = _kept(F.col("lines"), F.col("starts"), size)
    joined = rows.join(starts, same, "left").withColumn("kept", F.when(F.col("starts").isNotNull(), kept))
    total = F.greatest(F.size("lines"), F.lit(0))
    return joined.select(
        *[
            F.coalesce(F.array_join("kept", _BREAK), F.col("row")[c]).alias(c) if c == text else F.col("row")[c].alias(c)
            for c in docs.columns
        ],
        F.struct(
            total.alias("n_lines"),
            F.when(F.col("starts").isNull(), 0).otherwise(total - F.size("kept")).alias("removed_lines"),
        ).alias(free_name(docs.columns, "found")),
    )


OP1_SQL = """
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
runs AS (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS place FROM docs WHERE len(lines) >= 3),
texts AS (
  SELECT doc_id, place, lines[place + 1] || chr(10) || lines[place + 2] || chr(10) || lines[place + 3] AS run,
    lines[place + 1] || lines[place + 2] || lines[place + 3] AS words
  FROM runs),
filled AS (SELECT doc_id, place, run FROM texts WHERE trim(words) <> ''),
later AS (
  SELECT doc_id, place FROM (
    SELECT doc_id, place, row_number() OVER (PARTITION BY run ORDER BY doc_id, place) AS nth FROM filled)
  WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, place + i AS line FROM later, (SELECT unnest(range(0, 3)) AS i)),
numbered AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS n FROM docs),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY n) AS text FROM numbered
  WHERE (doc_id, n) NOT IN (SELECT doc_id, line FROM gone) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.lines), 0) AS INTEGER) AS n_lines,
  CAST(coalesce(c.removed, 0) AS INTEGER) AS removed_lines,
  md5(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END) AS kept_md5
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN counts c ON c.doc_id = d.doc_id
"""
