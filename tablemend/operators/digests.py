"""Differences of two copies found through digests of key buckets, for copies that are nearly equal.

A row's key and change second are hashed; a bucket of keys has the number of its rows and sums of their hashes, which do
not depend on the order of rows. Buckets whose digests agree hold the same keys and seconds. Those that differ are
divided further, level by level, and only their rows are compared by key in the end. Equal copies so shuffle a row a
bucket and task instead of every key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.predicates import keys_present
from tablemend.functions.times import whole_second
from tablemend.functions.windows import TimeWindow
from tablemend.operators.ledger import all_differences, latest_time
from tablemend.session import materialize

# Bits of the key hash that name a bucket on each level.
LEVELS = (8, 14)
_BUCKET = "__bucket"


def _bucket(keys: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def _digests(rows: DataFrame, keys: list[str], ts: str, bits: int, side: str) -> DataFrame:
    """One row a bucket: number of rows and two sums over hashes of key and second, negative for the target."""
    mark = F.xxhash64(*keys, whole_second(F.col(ts)))
    sign = F.lit(1 if side == "source" else -1)
    high, low = F.shiftright(mark, 32), mark.bitwiseAND(F.lit(0xFFFFFFFF))
    return rows.select(
        _bucket(keys, bits).alias(_BUCKET), sign.alias("n"), (sign * high).alias("high"), (sign * low).alias("low")
    )


def differing_buckets(source: DataFrame, target: DataFrame, keys: list[str], ts: str, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Buckets of the last level, as (bits, bucket), whose rows differ by key or change second.

    Both sides have complete keys. A level looks only at rows of buckets that differ on the level before, at most
    2 ** bits of them, which are broadcast.
    """
    found = None
    for bits in levels:
        sides = []
        for side, rows in (("source", source), ("target", target)):
            if found is not None:
                rows = rows_in_buckets(rows, keys, found)
            sides.append(_digests(rows, keys, ts, bits, side))
        sums = sides[0].unionByName(sides[1]).groupBy(_BUCKET).agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])
        different = sums.where((F.col("n") != 0) | (F.col("high") != 0) | (F.col("low") != 0))
        found = materialize(different.select(F.lit(bits).alias("bits"), _BUCKET), "buckets")
        if found.isEmpty():
            break
    return found


def rows_in_buckets(rows: DataFrame, keys: list[str], buckets: DataFrame) -> DataFrame:
    """Rows of the given buckets, by a broadcast that is never longer than the level has buckets."""
    first = buckets.select("bits").first()
    if first is None:
        return rows.limit(0)
    return rows.join(F.broadcast(buckets.select(_BUCKET)), _bucket(keys, first["bits"]) == F.col(_BUCKET), "left_semi")


def digest_differences(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    ts: str,
    window: TimeWindow,
    deletes: DataFrame | None = None,
    levels: tuple[int, ...] = LEVELS,
) -> DataFrame:
    """The rows of `ledger.all_differences`, for copies of which most buckets are equal.

    Rows without a complete key are differences of their own and are compared as they are. Tables are scanned once for
    each level and once more at the end. Two buckets that differ and yet have equal sums are as unlikely as two texts
    with equal 128-bit hashes.
    """
    whole = keys_present(keys)
    inside = window.holds(F.col(ts))
    buckets = differing_buckets(source.where(whole & inside), target.where(whole & inside), keys, ts, levels)
    near = [rows_in_buckets(rows.where(whole), keys, buckets) for rows in (source, target)]
    holed = [rows.where(~whole) for rows in (source, target)]
    sides = [a.unionByName(b) for a, b in zip(near, holed, strict=True)]
    return all_differences(*sides, keys, ts, window, deletes, newest=latest_time(target, ts))
