"""Mixing sources to target weights by a temperature.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources alike) and 1 (as they
are). The exponent is found by bisection: the smallest at which no source repeats more often than a limit, or the
largest whose weights still have a target entropy. The largest source is taken once; every other source is repeated
until it has its weight: whole rounds of all its documents, and one part of a round, for which a permutation of the
source's blocks is followed until the budget is met.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm.names import free_name
from tablemend.session import materialize

# Halvings of the exponent's interval that one pass over the sources decides, and how many passes there are.
_HALVINGS, _PASSES = 6, 7
# Blocks of a source; the stride is odd, so that it visits each of them once.
_BLOCKS, _STRIDE = 1024, 389
# Parts in which a source meets its plan.
_SALTS = 61


def tokens(text: str | Column) -> Column:
    """Number of words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def _draw(key: str, seed: int) -> Column:
    """A fixed random number of 60 bits for a key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _holds(exponent: float, most: float | None, entropy: float | None) -> Column:
    """Whether the weights at an exponent keep to the repetition limit, or no longer reach the entropy."""
    ratio = F.col("n") / F.col("largest")
    if most is not None:
        return F.max(F.pow(ratio, F.lit(exponent - 1.0))) <= most
    raw = F.pow(ratio, F.lit(exponent))
    # Entropy of normalised weights: log of the sum less the weighted mean of the logs.
    found = F.log(F.sum(raw)) - F.sum(raw * F.log(raw)) / F.sum(raw)
    return found <= entropy


def exponent(totals: DataFrame, most: float | None = None, entropy: float | None = None) -> float:
    """Bisect the exponent over totals (n, largest) of the sources; a pass decides several halvings at once.

    With `most`, the smallest exponent at which the smallest source repeats at most so often. With `entropy` (in
    nats), the largest that still reaches it, 0 where none does. Only the answers at some exponents reach the driver.
    """
    if (most is None) == (entropy is None):
        raise ValueError("give a repetition limit or an entropy")
    low, high = 0.0, 1.0
    positive = totals.where("n > 0")
    for _ in range(_PASSES):
        points = [low + (high - low) * i / 2**_HALVINGS for i in range(1, 2**_HALVINGS)]
        row = positive.agg(*[F.coalesce(_holds(p, most, entropy), F.lit(True)) for p in points]).first()
        first = next((i for i, ok in enumerate(row, 1) if ok), 2**_HALVINGS)
        low, high = low + (high - low) * (first - 1) / 2**_HALVINGS, low + (high - low) * first / 2**_HALVINGS
    return high if most is not None else low


def plan(
    docs: DataFrame,
    most: float | None = 2.0,
    entropy: float | None = None,
    seed: int = 7,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """What each source contributes: of_source, weight, rounds, and the end of the part round (cut_rank, cut_draw).

    A part round takes the blocks before `cut_rank`, and of that block the documents up to `cut_draw`. It meets the
    budget and passes it by less than one document with its repeats.
    """
    slim = docs.select(
        F.col(source).alias("of_source"), tokens(text).alias("n"), _draw(key, seed).alias("draw")
    ).withColumn("rank", _rank())
    slim = materialize(slim, "tokens")
    # A source has a row for each of its blocks, however many documents it holds.
    blocks = slim.groupBy("of_source", "rank").agg(F.sum("n").alias("n"))
    totals = materialize(blocks.groupBy("of_source").agg(F.sum("n").alias("n")), "sources")
    sized = totals.withColumn("largest", totals.agg(F.max("n")).scalar())
    power = exponent(sized, most, entropy)
    repeats = F.when(F.col("n") > 0, F.pow(F.col("n") / F.col("largest"), F.lit(power - 1.0))).otherwise(1.0)
    budgets = sized.select(
        F.col("of_source").alias("budget_of"),
        F.floor(repeats).cast("int").alias("rounds"),
        ((repeats - F.floor(repeats)) * F.col("n")).alias("part"),
        (repeats * F.col("n")).alias("budget"),
    )
    whole = budgets.agg(F.sum("budget")).scalar()
    budgets = budgets.withColumn("weight", F.when(whole > 0, F.col("budget") / whole).otherwise(0.0))
    # The block in which the part round ends: the first whose running total meets the budget.
    before = Window.partitionBy("of_source").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = blocks.withColumn("upto", F.sum("n").over(before))
    same = F.col("of_source").eqNullSafe(F.col("budget_of"))
    ends = (
        running.join(budgets, same)
        .where((F.col("part") > 0) & (F.col("upto") >= F.col("part")))
        .groupBy("of_source")
        .agg(F.min(F.struct("rank", (F.col("part") - F.col("upto") + F.col("n")).alias("left"))).alias("end"))
        .select(F.col("of_source").alias("end_of"), F.col("end.rank").alias("cut_rank"), "end.left")
    )
    last = slim.join(
        ends, F.col("of_source").eqNullSafe(F.col("end_of")) & (F.col("rank") == F.col("cut_rank"))
    ).groupBy("end_of", "cut_rank", "left", "draw").agg(F.sum("n").alias("n"))
    within = Window.partitionBy("end_of").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        last.withColumn("upto", F.sum("n").over(within))
        .where(F.col("upto") >= F.col("left"))
        .groupBy("end_of", "cut_rank")
        .agg(F.min("draw").alias("cut_draw"))
    )
    return budgets.join(cut, F.col("budget_of").eqNullSafe(F.col("end_of")), "left").select(
        F.col("budget_of").alias("of_source"), "weight", "rounds", "cut_rank", "cut_draw"
    )


def _rank() -> Column:
    """Place of a document's block in the order in which a part round visits the blocks of its source."""
    block = F.col("draw") % _BLOCKS
    shift = F.pmod(F.crc32(F.coalesce("of_source", F.lit("")).cast("binary")), F.lit(_BLOCKS))
    return F.pmod(block * _STRIDE + shift, F.lit(_BLOCKS))


def mix(
    docs: DataFrame,
    most: float | None = 2.0,
    entropy: float | None = None,
    seed: int = 7,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Rows with their columns as often as the weights ask for, and a struct `drawn` (underscores are added where a column
    has that name) of round and order in it.

    Every row comes at least once. A null source is a source of its own. Null and empty texts have no tokens: they cost
    no budget, and a source without tokens comes once. Rows that repeat key and source come together. `drawn.place` is
    the block's rank and `drawn.draw` the order in the block. No rows give none.
    """
    plans = plan(docs, most, entropy, seed, text, key, source)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("of"), F.col(source).alias("of_source"), _draw(key, seed).alias("draw")
    ).withColumn("rank", _rank())
    # A frequent source is dealt to several tasks.
    salted = rows.drop("of_source").withColumn("salt", F.col("draw") % _SALTS)
    spread = plans.withColumn("of_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    joined = salted.join(spread, F.col("of").eqNullSafe(F.col("of_source")) & (F.col("salt") == F.col("of_salt")))
    taken = (F.col("rank") < F.col("cut_rank")) | (
        (F.col("rank") == F.col("cut_rank")) & (F.col("draw") <= F.col("cut_draw"))
    )
    last = F.col("rounds") - F.when(taken, 0).otherwise(1)
    drawn = joined.select("row", "rank", "draw", F.explode(F.sequence(F.lit(0), last)).alias("round"))
    return drawn.select(
        *[F.col("row")[c].alias(c) for c in docs.columns],
        F.struct("round", F.col("rank").alias("place"), "draw").alias(free_name(docs.columns, "drawn")),
    )


def shares_entropy(shares: list[float]) -> float:
    """Entropy in nats of a list of shares."""
    return -sum(s * math.log(s) for s in shares if s > 0)
