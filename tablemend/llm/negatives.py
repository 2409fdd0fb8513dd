"""Hard negatives by bounds along a spanning tree of anchors.

Anchors of a block are joined to a tree of short edges. If a candidate x has score s at an anchor p, its score at an
anchor c lies within s -/+ |c - p| |x|, since inner products with x differ by at most that much. So the tree is walked
from its root: every anchor takes its parent's scores, or bounds on them, widened by edge length times norm. Only the
candidates whose bounds overlap what is asked for are scored anew; an anchor for which that would be most of them
scores all, and its children start from exact scores again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.session import materialize

# Whole numbers up to here are exact as doubles.
_EXACT = 2**53
# Share of the candidates beyond which an anchor scores all of them, and a margin for rounded roots.
_DENSE, _MARGIN = 0.25, 1e-6


@dataclass(frozen=True)
class Rows:
    """Keys in ascending order, with labels and vectors."""

    keys: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(place, parent, length) by Prim's rule: nearest to the tree first; the first place is the root, its parent -1."""
    if not len(vectors):
        return []
    left = np.ones(len(vectors), dtype=bool)
    near, parent = np.full(len(vectors), np.inf), np.full(len(vectors), -1)
    at, found = 0, []
    while True:
        length = 0.0 if parent[at] < 0 else float(np.sqrt(near[at]))
        found.append((at, int(parent[at]), length))
        left[at] = False
        if not left.any():
            return found
        squared = ((vectors - vectors[at]) ** 2).sum(axis=1)
        closer = left & (squared < near)
        near[closer], parent[closer] = squared[closer], at
        at = int(np.argmin(np.where(left, near, np.inf)))


class Walk:
    """Bounds on the scores of a shard's candidates at one anchor after another."""

    def __init__(self, shard: Rows, anchors: Rows) -> None:
        self.shard, self.anchors = shard, anchors
        self._norms = np.sqrt((shard.vectors**2).sum(axis=1))
        self._held: dict[int, list] = {}
        self.scored = 0

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each anchor's place with lower and upper bounds, to be tightened in place by `score`."""
        tree = spanning_tree(self.anchors.vectors)
        children = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(tree) or 1)
        for at, parent, length in tree:
            if parent < 0:
                low = high = self.score_all(at)
            else:
                low, high, wait = self._held[parent]
                reach = length * self._norms * (1 + 1e-12) + _MARGIN
                low, high = low - reach, high + reach
                self._held[parent][2] = wait - 1
                if wait == 1:
                    del self._held[parent]
            state = [low, high, int(children[at])]
            if children[at]:
                self._held[at] = state
            yield at, *self._ready(at, state)

    def _ready(self, at: int, state: list) -> tuple[np.ndarray, np.ndarray]:
        self._current = (at, state)
        return state[0], state[1]

    def score_all(self, at: int) -> np.ndarray:
        self.scored += len(self.shard.keys)
        return self.shard.vectors @ self.anchors.vectors[at]

    def score(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores at the current anchor: the places looked at, all of `wanted` among them, and their scores."""
        at, state = self._current
        places = np.flatnonzero(wanted)
        if len(places) > _DENSE * len(wanted):
            exact = state[0] if state[0] is state[1] else self.score_all(at)
            state[0] = state[1] = exact
            return places, exact[places]
        self.scored += len(places)
        exact = self.shard.vectors[places] @ self.anchors.vectors[at]
        state[0][places] = state[1][places] = exact
        return places, exact


def _best(keys: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller key."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((keys[some], -score[some]))[:k]]


def same_label(shard: Rows, anchors: Rows, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor, places and scores of the k best candidates of its label under other keys."""
    walk = Walk(shard, anchors)
    for at, low, high in walk:
        of_label = (shard.labels == anchors.labels[at]) & (shard.keys != anchors.keys[at])
        n = int(of_label.sum())
        if n > k:
            threshold = np.partition(low[of_label], n - k)[n - k]
            of_label &= high >= threshold
        places, score = walk.score(of_label)
        best = _best(shard.keys[places], score, k)
        yield at, places[best], score[best]


def in_windows(
    shard: Rows, anchors: Rows, windows: list[list[tuple[int, int, int]]], k: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each anchor and each of its windows (number, least, most): places and scores of the k best candidates of other
    labels inside."""
    walk = Walk(shard, anchors)
    for at, low, high in walk:
        asked = [w for w in windows[at] if w[1] <= w[2]]
        if not asked:
            continue
        other = (shard.labels != anchors.labels[at]) & (shard.keys != anchors.keys[at])
        overlap = np.zeros(len(low), dtype=bool)
        for _, least, most in asked:
            inside = other & (low >= least) & (high <= most)
            known = low[inside]
            # With k candidates surely inside, only those that may score as high as the k-th matter.
            floor = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else least
            overlap |= other & (high >= max(floor, least)) & (low <= most)
        places, score = walk.score(overlap)
        for number, least, most in asked:
            within = np.flatnonzero((score >= least) & (score <= most))
            best = within[_best(shard.keys[places[within]], score[within], k)]
            yield at, number, places[best], score[best]


_PACKED = "group long, keys binary, labels binary, width int, data binary"


def _grouped(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows dealt into groups of about `size`, one packed row each, and the number of groups."""
    n = max(1, -(-rows.count() // size))
    numbered = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(n)))

    def pack(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("key")
        vectors = batch.column("weights").to_pylist()
        dense = np.zeros((len(vectors), max(map(len, vectors), default=0)), dtype="<i8")
        for place, row in enumerate(vectors):
            dense[place, : len(row)] = row
        values = [
            batch.column("group")[0].as_py(), batch.column("key").to_numpy().astype("<i8").tobytes(),
            batch.column("label").to_numpy().astype("<i8").tobytes(), dense.shape[1], dense.tobytes(),
        ]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
        names = ["group", "keys", "labels", "width", "data"]
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

    return numbered.groupBy("group").applyInArrow(pack, _PACKED), n


def _rows(row: dict, prefix: str, wide: int) -> Rows:
    keys, labels = (np.frombuffer(row[f"{prefix}_{c}"], dtype="<i8") for c in ("keys", "labels"))
    dense = np.zeros((len(keys), wide))
    width = row[f"{prefix}_width"]
    dense[:, :width] = np.frombuffer(row[f"{prefix}_data"], dtype="<i8").reshape(len(keys), width)
    return Rows(keys, labels, dense)


def _checked(row: dict) -> tuple[Rows, Rows]:
    """The candidates and the anchors of a cell."""
    wide = max(row["shard_width"], row["block_width"])
    shard, anchors = _rows(row, "shard", wide), _rows(row, "block", wide)
    most = [float(np.abs(r.vectors).max(initial=0)) for r in (shard, anchors)]
    if 4 * wide * max(most) ** 2 > _EXACT:
        raise OverflowError("inner products are too large to be exact")
    return shard, anchors


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _cells(shards: DataFrame, n_shards: int, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """Every shard beside every block of the stated anchors, one row each."""
    left = shards.select(*[F.col(c).alias(f"shard_{c}") for c in shards.columns]).withColumn("in_block", _numbers(n_blocks))
    right = blocks.select(*[F.col(c).alias(f"block_{c}") for c in blocks.columns]).withColumn("in_shard", _numbers(n_shards))
    met = left.join(right, (F.col("in_block") == F.col("block_group")) & (F.col("in_shard") == F.col("shard_group")))
    return met.drop("in_block", "in_shard", "shard_group")


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    most_percent: int = 100,
    key: str = "vec_id",
    label: str = "label",
    weights: str = "weights",
    shard_rows: int = 8192,
    block_rows: int = 1024,
) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    `anchors` is a condition on the rows. An anchor's positives are its best `positives` rows of the same label; their
    negatives are the best `negatives` rows of other labels whose score lies between `least_percent` and `most_percent`
    of the positive's. Scores are inner products of arrays of longs (missing places count as zero), higher first, ties
    to the smaller key. Rows with a null key, label or vector, or a null in it, take no part; of rows that repeat a key
    the least by label and vector does. An anchor alone with its label gives no rows, nor does a table without anchors.
    Inner products beyond 2 ** 53 raise an error.

    Candidates and anchors are packed into shards and blocks of a bounded number of rows, and every pair of them is a
    task's work of its own.
    """
    whole = F.col(key).isNotNull() & F.col(label).isNotNull() & F.forall(weights, lambda w: w.isNotNull())
    named = rows.where(whole).select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(weights).alias("weights"), anchors.alias("anchor")
    )
    once = named.groupBy("key").agg(F.min(F.struct("label", "weights", "anchor")).alias("row"))
    once = materialize(once.select("key", "row.label", "row.weights", "row.anchor"), "candidates")
    shards, n_shards = _grouped(once.select("key", "label", "weights"), shard_rows)
    blocks, n_blocks = _grouped(once.where("anchor").select("key", "label", "weights"), block_rows)
    shards, blocks = materialize(shards, "shards"), materialize(blocks, "blocks")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, chosen = _checked(row)
                found = [
                    (row["block_group"], chosen.keys[at], shard.keys[places], score)
                    for at, places, score in same_label(shard, chosen, positives)
                ]
                yield _batch(["group", "anchor", "other", "score"], found)

    found = _cells(shards, n_shards, blocks, n_blocks).mapInArrow(nearest, "group long, anchor long, other long, score long")
    best = Window.partitionBy("group", "anchor").orderBy(F.desc("score"), "other")
    first = found.withColumn("number", F.row_number().over(best)).where(F.col("number") <= positives)
    # At most `positives` rows for each of a block's anchors.
    asked = materialize(first, "positives").groupBy("group").agg(
        F.collect_list(F.struct("anchor", "number", "other", "score")).alias("asked")
    )
    windows = blocks.join(asked, "group")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, chosen = _checked(row)
                place = {int(k): i for i, k in enumerate(chosen.keys)}
                asked_of = [[] for _ in chosen.keys]
                for i, a in enumerate(row["block_asked"]):
                    least, most = -(-a["score"] * least_percent // 100), a["score"] * most_percent // 100
                    asked_of[place[a["anchor"]]].append((i, least, most))
                found = []
                for at, number, places, score in in_windows(shard, chosen, asked_of, negatives):
                    a = row["block_asked"][number]
                    found.append((chosen.keys[at], a["number"], a["other"], a["score"], shard.keys[places], score))
                yield _batch(["anchor", "number", "positive", "positive_score", "other", "score"], found)

    cells = _cells(shards, n_shards, windows, n_blocks)
    hard = cells.mapInArrow(between, "anchor long, number long, positive long, positive_score long, other long, score long")
    best = Window.partitionBy("anchor", "number").orderBy(F.desc("score"), "other")
    ranked = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _batch(names: list[str], found: list[tuple]) -> pa.RecordBatch:
    """Columns of longs; single values of an entry are repeated for all rows of its last one."""
    sizes = [len(entry[-1]) for entry in found]
    columns = [
        np.concatenate([v if isinstance(v, np.ndarray) else np.full(n, v) for v, n in zip(values, sizes, strict=True)])
        for values in zip(*found, strict=True)
    ] or [np.empty(0)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)
