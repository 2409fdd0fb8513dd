"""Spelling variants: words one inserted, deleted or replaced letter apart, found along a trie held as tables.

The trie is a table of edges per depth, made from the words that still share a node with another. States (word,
position, node, one edit made) move along it by a join with the edges of the next depth. A word whose edit lies in its
second half has its first half whole, so it walks there without an edit and enters the frontier at its middle; edits
in the first half are found in the same way in a second trie, of the words read backwards. Where a node has one word
below it, the rest of the state's word is compared with that word at once, so the walk ends with the longest beginning
that two words share, however long words are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend import session

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Edges of a depth that are few enough for a broadcast, and the longest stretch without a branch passed at once.
_FEW_EDGES, _LONGEST_SKIP = 4096, 20


# Rounds write many small files: this codec holds no buffers outside the heap that only a collection of garbage frees.
_CODEC = "zstd"


def materialize(df: DataFrame, label: str) -> DataFrame:
    return session.materialize(df, label, compression=_CODEC)


def runs(text: str | Column, pattern: str) -> Column:
    """All matches of a pattern, A-Z lowered and other letters left as they are."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(pattern), F.lit(0))


def _letter(path: str | Column, at: Column) -> Column:
    """The code point at a place counted from 0; empty beyond the end."""
    return F.substring(path, at + 1, F.lit(1))


def _from(path: str | Column, at: Column) -> Column:
    return F.substring(path, at + 1, F.length(path))


def _both_ways(vocabulary: DataFrame) -> DataFrame:
    """Each word forwards (side 0) and backwards (side 1); edits are made from place `free` on."""
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    forwards = vocabulary.select(F.lit(0).alias("side"), F.col("word").alias("path"), size.alias("size"), half.alias("free"))
    backwards = vocabulary.select(
        F.lit(1).alias("side"), F.reverse("word").alias("path"), size.alias("size"), (size - half).alias("free")
    )
    return forwards.union(backwards)


def _edges(below: DataFrame, depth: int) -> DataFrame:
    """Edges that leave the nodes of a depth: side, node, letter, child, words below it, one of them, and whether one
    ends at the child."""
    onward = below.where(F.col("size") > depth).withColumn("child", F.substring("path", 1, depth + 1))
    grouped = onward.groupBy("side", "child").agg(
        F.count("*").alias("n"), F.min("path").alias("only"), F.min("size").alias("least")
    )
    return grouped.select(
        "side",
        F.substring("child", 1, depth).alias("node"),
        _letter("child", F.lit(depth)).alias("letter"),
        "child",
        "n",
        "only",
        (F.col("least") == depth + 1).alias("ends"),
    )


def _skip(below: DataFrame, depth: int) -> int:
    """How many letters, by powers of two, all nodes of a depth go on without a branch or an end."""
    nodes = below.groupBy("side", "node").agg(F.min("path").alias("least"), F.max("path").alias("most"))
    same = [
        F.bool_and(
            (F.substring("least", depth + 1, 2**i) == F.substring("most", depth + 1, 2**i)) & (F.length("least") > depth + 2**i)
        ).alias(str(i))
        for i in range(_LONGEST_SKIP)
    ]
    return max((2 ** int(i) for i, yes in nodes.agg(*same).first().asDict().items() if yes), default=0)


def _moved_on(states: DataFrame, below: DataFrame, depth: int, skip: int) -> DataFrame:
    """States moved over letters that all words below their node share."""
    chains = below.groupBy("side", "node").agg(F.min(F.substring("path", 1, depth + skip)).alias("chain"))
    same = F.substring("path", F.col("place") + 1, F.lit(skip)) == F.substring("chain", depth + 1, skip)
    return states.join(chains, ["side", "node"]).where(same).select(
        "side", "path", "size", (F.col("place") + skip).alias("place"), F.col("chain").alias("node"), "node_ends"
    )


def near_words(words: DataFrame, word: str = "word") -> DataFrame:
    """Pairs (word, near) of words that differ by exactly one inserted, deleted or replaced code point, both ways round.

    Null and empty words are none; repeated words count once; other columns are left out. No words give no pairs.
    Every depth of the trie takes one round, from half the shortest word to the longest beginning (or end) that two
    words share, less what all words left share there; each round's states are written to the shared folder.
    """
    spark = words.sparkSession
    vocabulary = words.select(F.col(word).alias("word")).where(F.length("word") > 0).distinct()
    tries = materialize(_both_ways(vocabulary), "tries")
    first = tries.agg(F.min("free")).first()[0] or 0
    below = tries.select("*", F.substring("path", 1, first).alias("node"), F.lit(False).alias("node_ends"))
    folder = session.scratch_path(spark, "frontier")
    states, depth = None, first
    while not below.isEmpty():
        edges = materialize(_edges(below, depth), "edges")
        size = edges.agg(F.count("*").alias("n"), F.count_distinct("side", "node").alias("nodes"), F.bool_or("ends").alias("ends")).first()
        if size["n"] == size["nodes"] and not size["ends"] and (skip := _skip(below, depth)):
            if states is not None:
                states = materialize(_moved_on(states, below, depth, skip), "states")
            below = materialize(
                below.withColumn("node", F.substring("path", 1, depth + skip)).withColumn("node_ends", F.lit(False)), "below"
            )
            depth += skip
            continue
        if size["n"] <= _FEW_EDGES:
            edges = F.broadcast(edges)
        dropped = _dropped(below, depth)
        moved = _opened(below, edges, depth).unionByName(
            _followed(dropped if states is None else dropped.unionByName(states), edges)
        )
        # A letter left out at the end leaves nothing to follow.
        ended = dropped.where((F.col("place") == F.col("size")) & F.col("node_ends"))
        ended = ended.select("side", "path", F.col("node").alias("found"), *_no_state())
        level = f"{folder}/depth={depth}"
        _settled(moved, depth).unionByName(ended).write.parquet(level, compression=_CODEC)
        states = (
            spark.read.parquet(level)
            .where(F.col("found").isNull())
            .select("side", "path", "size", "place", "node", F.lit(False).alias("node_ends"))
        )
        shared = edges.where("n > 1").select("side", F.col("child").alias("to"), F.col("ends").alias("to_ends"), "child")
        onward = below.where(F.col("size") > depth).withColumn("child", F.substring("path", 1, depth + 1))
        below = onward.join(shared, ["side", "child"]).select(
            "side", "path", "size", "free", F.col("to").alias("node"), F.col("to_ends").alias("node_ends")
        )
        below = materialize(below, "below")
        depth += 1
    if depth == first:
        return vocabulary.limit(0).select("word", F.col("word").alias("near"))
    found = spark.read.parquet(folder).where(F.col("found").isNotNull())
    unturned = [F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c)) for c in ("path", "found")]
    return found.select(unturned[0].alias("word"), unturned[1].alias("near")).distinct()


def _no_state() -> list[Column]:
    return [
        F.lit(None).cast("int").alias("size"), F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("node")
    ]


def _opened(below: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """Words that make their edit at this depth: another letter for theirs, or one put in before it.

    A letter put in before its equal is the same as one put in behind it, so it waits for the next place.
    """
    free = below.where(F.col("free") <= depth).select("side", "path", "size", "node")
    away = free.join(edges, ["side", "node"]).where(F.col("letter") != _letter("path", F.lit(depth)))
    places = F.when(F.col("size") > depth, F.array(F.lit(depth), F.lit(depth + 1))).otherwise(F.array(F.lit(depth)))
    return away.select("side", "path", "size", F.explode(places).alias("place"), "child", "n", "only", "ends")


def _dropped(below: DataFrame, depth: int) -> DataFrame:
    """Words that leave out their letter at this depth and stay at the node; of equal letters in a row only the last."""
    free = below.where((F.col("free") <= depth) & (F.col("size") > depth))
    free = free.where(_letter("path", F.lit(depth)) != _letter("path", F.lit(depth + 1)))
    return free.select("side", "path", "size", F.lit(depth + 1).alias("place"), "node", "node_ends")


def _followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States whose next letter has an edge, moved along it."""
    going = states.where(F.col("place") < F.col("size")).select(
        "side", "path", "size", "place", F.concat("node", _letter("path", F.col("place"))).alias("child")
    )
    return going.join(edges.select("side", "child", "n", "only", "ends"), ["side", "child"]).select(
        "side", "path", "size", (F.col("place") + 1).alias("place"), "child", "n", "only", "ends"
    )


def _settled(moved: DataFrame, depth: int) -> DataFrame:
    """Moved states that have found a word (`found`), and those that go on from a node with several words (`node`)."""
    last = F.col("n") == 1
    same_rest = _from("path", F.col("place")) == _from("only", F.lit(depth + 1))
    arrived = F.col("ends") & (F.col("place") == F.col("size"))
    found = F.when(last & same_rest, F.col("only")).when(~last & arrived, F.col("child"))
    goes_on = ~last & (F.col("place") < F.col("size"))
    return moved.where((last & same_rest) | (~last & arrived) | goes_on).select(
        "side", "path", found.alias("found"), "size", "place", F.when(goes_on, F.col("child")).alias("node")
    )


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Each word of (word, n) with its near words: word, n, n_near, form, form_n, root.

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that is `ratio` or more
    times the word's own; the root is found by following forms to the last, and is the word itself without one. Null
    and empty words and null numbers are left out; of rows that repeat a word the largest n counts. Forms grow along a chain, so
    following them by doubled steps ends after the logarithm of the longest chain.
    """
    # A ratio of 1 could lead round in circles.
    if ratio < 2:
        raise ValueError("forms must outnumber their variants")
    counted = words.where((F.length("word") > 0) & F.col("n").isNotNull()).groupBy("word").agg(F.max("n").alias("n"))
    counted = materialize(counted, "words")
    pairs = near_words(counted)
    sized = pairs.join(counted.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = sized.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    )
    form = -F.col("best.less") >= ratio * F.col("n")
    placed = counted.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form, F.col("best.near")).alias("form"),
        F.when(form, -F.col("best.less")).alias("form_n"),
    )
    placed = materialize(placed, "forms")
    return placed.join(_roots(placed), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words that have a form; each round doubles the steps taken."""
    steps = materialize(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = materialize(steps.join(ahead, "root", "left").select("word", "root", "further"), "roots")
        if joined.where(F.col("further").isNotNull()).isEmpty():
            return steps
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))
