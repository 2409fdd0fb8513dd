"""Document fingerprints by I-Match.

A document keeps the terms whose inverse document frequency lies in a band: frequent words say little, and a word of one
document alone is often a slip. The distinct terms are sorted and hashed, not once but for several random subsets of the
lexicon, so that a document with some other terms still shares the hashes of the subsets that none of them is in.

Subsets come in groups. Within a group each holds half the words of the one before, so that long texts, which differ in
many words, have sparse subsets to agree in, and short texts dense ones to have terms in at all. The densest subsets of a
long text would tell nothing: a text uses those that leave it some `terms` terms at most, by the number of its words.

Only DataFrame functions are used, and all terms are 64-bit hashes of words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm.names import free_name

_BETWEEN = r"[^\p{L}\p{N}]+"
_PLACES = 1 << 36


@dataclass(frozen=True)
class Lexicons:
    """Random subsets of the lexicon: in each of `groups` groups, subset k of `levels` takes one word in 2 ** (k + 1)."""

    groups: int = 10
    levels: int = 14
    terms: int = 8
    least_idf: float = 4.0
    least_documents: int = 2


def terms(text: str | Column) -> Column:
    """Hashes of the distinct words of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN)
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def _mark(group: Column, term: Column) -> Column:
    """A hash whose zeros at the end tell how many of a group's subsets hold a term, from the densest."""
    return F.xxhash64(group, term)


def _level(group: Column, term: Column) -> Column:
    mark = _mark(group, term)
    return F.length(F.bin(mark.bitwiseAND(-mark))) - 1


def first_level(n_words: str | Column, lexicons: Lexicons) -> Column:
    """The densest subset, from 1, that a text of so many distinct words uses."""
    doubled = F.ceil(F.log2(F.greatest(F.col(n_words) if isinstance(n_words, str) else n_words, F.lit(1)) / lexicons.terms))
    return F.least(F.greatest(doubled, F.lit(1)), F.lit(lexicons.levels)).cast("int")


def entries(found: str, version: int, lexicons: Lexicons) -> Column:
    """Terms of a text by the groups in which some subset it uses holds them: version, group, level, term."""
    found = F.col(found)
    # Bits that are zero for the terms of the densest subset used.
    zeros = F.call_function("shiftleft", F.lit(1).cast("long"), first_level(F.size(found), lexicons)) - 1

    def of_group(group: int) -> Column:
        number = F.lit(group)
        held = F.filter(found, lambda t: _mark(number, t).bitwiseAND(zeros) == 0)
        return F.transform(
            held,
            lambda t: F.struct(
                F.lit(version).cast("byte").alias("version"),
                number.cast("byte").alias("group"),
                _level(number, t).cast("byte").alias("level"),
                t.alias("term"),
            ),
        )

    return F.concat(*[of_group(g) for g in range(lexicons.groups)])


def band(docs: DataFrame, lexicons: Lexicons, column: str = "terms") -> tuple[DataFrame, DataFrame]:
    """Terms (column `term`) in the band, and those too frequent for it, over rows with arrays of distinct terms.

    A term's documents are counted over all rows. With a least idf of log(f), a term is too frequent in over 1/f of the
    rows, so there are at most f times as many such terms as a row has terms on average, however many rows there are.
    """
    most = F.greatest(F.floor(F.count("*") * F.exp(F.lit(-lexicons.least_idf))), F.lit(lexicons.least_documents))
    limit = docs.agg(most).scalar()
    counts = docs.select(F.explode(column).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    inside = counts.where((F.col("n") >= lexicons.least_documents) & (F.col("n") <= limit)).select("term")
    return inside, counts.where(F.col("n") > limit).select("term")


def signature(groups: list[str], least: str | Column, otherwise: str | Column, lexicons: Lexicons) -> Column:
    """Hashes of the subsets of a text's entries, which come by group and sorted by term, 8 hexadecimal digits each, joined
    by hyphens; empty where a subset has none or is denser than the text uses. A text without terms in the band has `=` and
    a hash of itself.
    """
    levels = F.array(*[F.lit(k) for k in range(1, lexicons.levels + 1)])

    def of_group(entries: str) -> Column:
        def part(level: Column) -> Column:
            chosen = F.transform(F.filter(entries, lambda e: e["level"] >= level), lambda e: e["term"])
            digits = F.substring(F.lower(F.lpad(F.hex(F.xxhash64(chosen)), 16, "0")), 1, 8)
            return F.when((level >= least) & F.exists(entries, lambda e: e["level"] >= level), digits).otherwise("")

        return F.when(F.size(entries) > 0, F.array_join(F.transform(levels, part), "-")).otherwise("-" * (lexicons.levels - 1))

    filled = sum((F.size(g) for g in groups), F.lit(0))
    return F.when(filled > 0, F.concat_ws("-", *map(of_group, groups))).otherwise(F.concat(F.lit("="), otherwise))


def likeness(one: Column, other: Column) -> Column:
    """Share of the subsets in which two fingerprints agree, among those that either has terms in; 0 to 1."""
    pairs = F.arrays_zip(F.split(one, "-").alias("a"), F.split(other, "-").alias("b"))
    used = F.filter(pairs, lambda p: (F.coalesce(p["a"], F.lit("")) != "") | (F.coalesce(p["b"], F.lit("")) != ""))
    equal = F.filter(used, lambda p: p["a"] == p["b"])
    return F.when(one == other, 1.0).otherwise(F.size(equal) / F.greatest(F.size(used), F.lit(1)))


def fingerprints(
    rows: DataFrame, versions: dict[str, str], key: str, lexicon: tuple[DataFrame, DataFrame], lexicons: Lexicons
) -> DataFrame:
    """Fingerprints of one or more texts a row: all columns but `entries`, and one for each version.

    `versions` names, for each result, the column of its text's hash; the terms of version i are the entries that carry
    i, and its column of distinct words is `n_words_<i>`. `lexicon` is what `band` found. The key is unique; rows stay
    small, so texts are not among them. Names the rows have already are kept apart.
    """
    inside, frequent = lexicon
    own, listed, found_in = (free_name(rows.columns, n) for n in ("own", "entry", "found"))
    pairs = rows.select(F.col(key).alias(own), F.explode("entries").alias(listed))
    term = pairs.select(own, f"{listed}.*")
    # Frequent terms go before the shuffle: what is left has no term in more than a small share of the rows.
    kept = term.join(F.broadcast(frequent), "term", "left_anti").join(inside, "term")
    of_version = [
        F.sort_array(F.collect_list(F.when(F.col("version") == i, F.struct("group", "term", "level")))).alias(f"{found_in}_{i}")
        for i in range(len(versions))
    ]
    grouped = kept.groupBy(own).agg(*of_version)
    joined = rows.join(grouped, F.col(key) == F.col(own), "left")
    kept_columns = [c for c in rows.columns if c != "entries"]
    none = F.array().cast("array<struct<group:tinyint,term:bigint,level:tinyint>>")
    # The entries of each group as a column of their own: subsets look at a few entries, not at all of them.
    def of_group(column: str, group: int) -> Column:
        return F.filter(F.coalesce(column, none), lambda e: e["group"] == group)

    by_group = {
        f"{found_in}_{i}_{g}": of_group(f"{found_in}_{i}", g)
        for i in range(len(versions))
        for g in range(lexicons.groups)
    }
    joined = joined.withColumns(by_group)
    signatures = [
        signature(
            [f"{found_in}_{i}_{g}" for g in range(lexicons.groups)], first_level(f"n_words_{i}", lexicons), text_hash, lexicons
        ).alias(name)
        for i, (name, text_hash) in enumerate(versions.items())
    ]
    return joined.select(*kept_columns, *signatures)


def with_next(docs: DataFrame, text: str = "text", key: str = "doc_id", parts: int = 200) -> DataFrame:
    """Each row's key and text, and those of the next row in ascending order of the keys; the first follows the last.

    Null texts are empty, null keys come first, rows of one key are ordered by a hash of their text. `place` is a
    unique number of the row, `next_place` that of the next. Rows are dealt to ranges of keys that hold about the same
    number; the first row of each range is added to the range before it, so no range needs to see another.
    """
    slim = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    points = [(i + 1) / parts for i in range(parts - 1)]
    bounds = slim.agg(F.percentile_approx("id", points, parts * 10)).first()[0] if parts > 1 else None
    bounds = sorted(set(bounds or []))
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("id"))) if bounds else F.lit(0)
    order = F.struct("id", F.xxhash64("content").alias("mark"))
    dealt = slim.withColumn("part", part).withColumn("order", order).withColumn("last", F.lit(0)).withColumn("from", F.col("part"))
    # One row per range; the order of the ranges is found from their numbers alone.
    firsts = dealt.groupBy("part").agg(F.min_by(F.struct("id", "content", "order"), "order").alias("row"))
    by_part = Window.orderBy(F.desc("part"))
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lead("part").over(by_part), F.first("part").over(whole))
    into = dealt.select("part").distinct().select("part", before.alias("into"))
    borrowed = firsts.join(F.broadcast(into), "part").select(
        "row.id", "row.content", F.col("into").alias("part"), "row.order", F.lit(1).alias("last"), F.col("part").alias("from")
    )
    ordered = Window.partitionBy("part").orderBy("last", "order")
    number = F.row_number().over(ordered)
    following = F.lead(F.struct("content", "last", "from")).over(ordered)
    rows = dealt.unionByName(borrowed).select(
        "id", "content", "part", "last", number.alias("number"), following.alias("next")
    )
    place = F.col("part").cast("long") * _PLACES + F.col("number")
    return rows.where("last = 0").select(
        F.col("id").alias(key),
        F.col("content").alias(text),
        place.alias("place"),
        F.col("next.content").alias("next_text"),
        F.when(F.col("next.last") == 1, F.col("next.from").cast("long") * _PLACES + 1).otherwise(place + 1).alias("next_place"),
    )
