"""Near-duplicates by SimHash, found through an index in Gray order.

Fingerprints that differ in at most `bits` bits agree in at least one of `bits` + 1 blocks of their bits, so those that
share a block's value are brought together; groups that are still too large are divided again by blocks of their other
bits, which loses no pair either. Within a group the fingerprints are sorted by their rank in the Gray code, in which
neighbours share long patterns. The index over them is a tree: a node knows the bits that all fingerprints below it
share, its children only what they share beyond that, and a search adds up the differences on the way down and leaves
out a whole node once there are too many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.components import components
from tablemend.session import materialize

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BITS_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1
_LEAF, _FAN = 16, 8
# Pairs of a query and a node looked at together.
_FRONTIER = 1 << 20


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of words, repeats included; a shorter text is one run, a text without words none."""
    split = (text or "").encode().translate(_LOWER).split()
    if not split:
        return np.empty(0, dtype="<u8")
    joined = b" ".join(split)
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(split) - words + 1)
    spans = zip(starts[:n].tolist(), ends[min(words, len(split)) - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), dtype="<u8", count=n)


def fingerprint(text: str | None, words: int) -> int:
    """Majority of the shingles' hashes in every bit; zero without words."""
    hashes = shingle_hashes(text, words)
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by_byte[:, j], minlength=256) @ _BITS_OF_BYTE for j in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, words: int, text: str, name: str) -> DataFrame:
    """The same rows with their fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, fingerprints(text))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Tree over fingerprints in Gray order, from wide nodes down to leaves of a few fingerprints."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, any_one = self._folded(self.codes, self.codes, _LEAF)
        levels = [(ones, any_one)]
        while len(ones) > _FAN:
            ones, any_one = self._folded(ones, any_one, _FAN)
            levels.append((ones, any_one))
        # From the top: the pattern shared below a node, and the mask of bits not already shared above it.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        above = np.zeros(1, dtype=np.uint64)
        for depth, (ones, any_one) in enumerate(reversed(levels)):
            shared = ~(ones ^ any_one)
            parent = np.arange(len(ones)) // _FAN if depth else np.zeros(len(ones), dtype=np.int64)
            self.levels.append((ones, shared & ~above[parent]))
            above = shared
        self.spread = levels[0]

    @staticmethod
    def _folded(ones: np.ndarray, any_one: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(0, len(ones), size)
        return np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(any_one, at)

    def links(self, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i, j), i < j in Gray order, of fingerprints that differ in at most `bits` bits."""
        step = max(1, _FRONTIER // max(1, len(self.levels[0][0]) * _FAN))
        for first in range(0, len(self.codes), step):
            yield from self._search(np.arange(first, min(first + step, len(self.codes))), bits)

    def _search(self, query: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        node = np.tile(np.arange(len(self.levels[0][0])), len(query))
        query = np.repeat(query, len(self.levels[0][0]))
        differ = np.zeros(len(query), dtype=np.int64)
        for depth, (pattern, mask) in enumerate(self.levels):
            differ = differ + np.bitwise_count((self.codes[query] ^ pattern[node]) & mask[node])
            width = _LEAF * _FAN ** (len(self.levels) - 1 - depth)
            # Links are taken from the lower place, so nodes that end before it are not needed.
            near = (differ <= bits) & ((node + 1) * width > query)
            query, node, differ = query[near], node[near], differ[near]
            if depth + 1 < len(self.levels):
                below = len(self.levels[depth + 1][0])
                node = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
                query, differ = np.repeat(query, _FAN), np.repeat(differ, _FAN)
                there = node < below
                query, node, differ = query[there], node[there], differ[there]
        for first in range(0, len(query), _FRONTIER // _LEAF):
            part = slice(first, first + _FRONTIER // _LEAF)
            other = (node[part, None] * _LEAF + np.arange(_LEAF)).ravel()
            one = np.repeat(query[part], _LEAF)
            there = (other < len(self.codes)) & (other > one)
            one, other = one[there], other[there]
            close = np.bitwise_count(self.codes[one] ^ self.codes[other]) <= bits
            yield one[close], other[close]


def roots(codes: np.ndarray, bits: int) -> np.ndarray:
    """For distinct codes: the least place linked, directly or over others, in the order of the Gray index."""
    index = GrayIndex(codes)
    root = np.arange(len(index.codes))
    for one, other in index.links(bits):
        while len(one):
            a, b = root[one], root[other]
            low, high = np.minimum(a, b), np.maximum(a, b)
            apart = low != high
            if not apart.any():
                break
            one, other = one[apart], other[apart]
            np.minimum.at(root, high[apart], low[apart])
            while (root[root] != root).any():
                root = root[root]
    return np.stack([index.codes, index.codes[root]])


def _masks(parent: int, parts: int) -> list[int]:
    """The bits outside `parent` divided into `parts` blocks, each together with `parent`."""
    rest = [b for b in range(64) if not parent >> b & 1]
    blocks = [rest[len(rest) * i // parts : len(rest) * (i + 1) // parts] for i in range(parts)]
    return [parent | sum(1 << b for b in block) for block in blocks]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keyed(codes: DataFrame, parents: list[int], parts: int) -> DataFrame:
    """Every code once for each block below its mask, with the mask and the value under it."""
    below = F.create_map(
        *[
            x
            for p in parents
            for x in (F.lit(_signed(p)), F.array(*[F.lit(_signed(m)) for m in _masks(p, parts)]))
        ]
    )
    exploded = codes.select("code", F.explode(below[F.col("mask")]).alias("mask"))
    return exploded.select("code", "mask", F.col("code").bitwiseAND(F.col("mask")).alias("value"))


def groups(codes: DataFrame, bits: int, largest: int) -> DataFrame:
    """Codes (distinct, in column `code`) in groups (mask, value) such that every close pair meets in one.

    A group of more than `largest` is divided again by the bits its codes do not share yet, until it is small enough or
    so few bits are left that it cannot be larger than 2 ** 15.
    """
    parts = bits + 1
    parents, rows, found = [0], codes.select("code", F.lit(0).cast("long").alias("mask")), None
    while True:
        # Masks of different parents may coincide from the second level on.
        keyed = _keyed(rows, parents, parts)
        keyed = materialize(keyed if found is None else keyed.distinct(), "blocks")
        counted = keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        parents = sorted({m for p in parents for m in _masks(p, parts)})
        last = 64 - min(m.bit_count() for m in parents) <= max(15, parts)
        small = counted if last else counted.where(F.col("n") <= largest)
        here = keyed.join(small.drop("n"), ["mask", "value"], "left_semi")
        found = here if found is None else found.unionByName(here)
        large = counted.where(F.col("n") > largest).drop("n")
        if last or large.isEmpty():
            return found
        rows = keyed.join(large, ["mask", "value"], "left_semi").select("code", "mask")


def linked(codes: DataFrame, bits: int, largest: int) -> DataFrame:
    """Edges (a, b) that connect the codes as all pairs within `bits` bits would.

    A group yields one edge a code at most, however dense it is.
    """
    meeting = groups(codes, bits, largest)
    spread = meeting.repartition("mask", "value").sortWithinPartitions("mask", "value")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches):
            code, root = roots(group, bits)
            tied = code != root
            if tied.any():
                arrays = [pa.array(x[tied].view(np.int64)) for x in (code, root)]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return spread.mapInArrow(search, "a long, b long").distinct()


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Codes of one group after another, from rows sorted by group; a group may span batches."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        code, mask, value = (batch.column(n).to_numpy() for n in ("code", "mask", "value"))
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
        for part in np.split(np.arange(len(code)), cuts):
            key = (mask[part[0]], value[part[0]])
            if key != held_key and held:
                yield np.concatenate(held).view(np.uint64)
                held = []
            held_key = key
            held.append(code[part])
    if held:
        yield np.concatenate(held).view(np.uint64)


def _classes(docs: DataFrame, words: int, bits: int, largest: int, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc, mark, fingerprint), `mark` being a hash of the text, and the root of every fingerprint (code, root)."""
    slim = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    hashed = materialize(with_fingerprint(slim, words, "text", "fingerprint").drop("text"), "simhash")
    codes = materialize(hashed.select(F.col("fingerprint").alias("code")).distinct(), "fingerprints")
    parts = components(linked(codes, bits, largest))
    placed = codes.join(parts, F.col("code") == F.col("node"), "left")
    return hashed, materialize(placed.select("code", F.coalesce("component", "code").alias("root")), "roots")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    bits: int = 3,
    largest: int = 4096,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Each row's key, 64-bit `fingerprint` and `component`, the smallest key reachable over close fingerprints.

    Fingerprints link when they differ in at most `bits` bits. Null and empty texts have fingerprint zero, which links
    like any other; repeated rows share fingerprint and component. Null keys take part but are no component's smallest
    key unless it has no other. An empty table gives an empty result.
    """
    hashed, of_code = _classes(docs, words, bits, largest, text, key)
    least = hashed.groupBy("fingerprint").agg(F.min("doc").alias("least"))
    rooted = of_code.join(least, F.col("code") == F.col("fingerprint")).select("code", "root", "least")
    smallest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("smallest"))
    found = materialize(rooted.join(smallest, F.col("root") == F.col("of")).select("code", "smallest"), "components")
    joined = hashed.join(found, F.col("fingerprint") == F.col("code"))
    return joined.select(F.col("doc").alias(key), "fingerprint", F.col("smallest").alias("component"))


def one_of_each(
    docs: DataFrame,
    words: int = 3,
    bits: int = 3,
    largest: int = 4096,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row of each component of close fingerprints, with all its columns: that of the smallest key, of rows with
    that key the one whose text has the smaller hash, of rows that repeat key and text any one.

    Rows with a null key stay only where no other is in the component. Null and empty texts are a component of their own.
    """
    hashed, of_code = _classes(docs, words, bits, largest, text, key)
    rooted = hashed.join(of_code, F.col("fingerprint") == F.col("code"))
    order = F.struct(F.col("doc").isNull().alias("keyless"), "doc", "mark")
    least = rooted.groupBy("root").agg(F.min(order).alias("row"))
    kept = materialize(least.select(F.struct("row.doc", "row.mark").alias("kept")), "kept")
    tag = F.struct(F.col(key).alias("doc"), F.xxhash64(text).alias("mark"))
    rows = docs.select(F.struct("*").alias("row"), tag.alias("tag")).join(kept, F.col("tag") == F.col("kept"), "left_semi")
    return rows.groupBy("tag").agg(F.first("row").alias("row")).select("row.*")


def as_hex(code: str | Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(code), 16, "0"))
