"""Exact top-k search over integer vectors by MaxScore.

Vectors are lists of terms: a position of the vector and the sign of its component. A shard of the vectors keeps a
posting list per term and the largest weight in it. A query adds positive score only through the terms of its own
signs, each at most its weight times the list's largest. From the weakest upwards, terms whose bounds together cannot
reach the k-th best score known are non-essential: no vector that occurs in these lists alone can be among the best.
The other lists are traversed, and the vectors found there are probed in the rest for as long as they stay competitive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Largest sum of products that a signed 64-bit number holds.
_LARGEST = 2**63 - 1
_GROUP_TYPES = "group long, keys binary, width int, n_bytes int, data binary"
_GROUP = pa.schema(
    [("group", pa.int64()), ("keys", pa.binary()), ("width", pa.int32()), ("n_bytes", pa.int32()), ("data", pa.binary())]
)


class Shard:
    """Posting lists of some vectors, which are in ascending order of their keys."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray) -> None:
        self.keys, self.vectors = keys, vectors
        self.postings = []
        for column in vectors.T:
            lists = []
            for signed in (column, -column):
                at = np.flatnonzero(signed > 0)
                lists.append((at, signed[at], int(signed[at].max(initial=0))))
            self.postings.append(lists)

    def best(self, key: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best vectors under other keys, best first, ties to the smaller key."""
        terms = sorted(
            ((abs(int(q)) * self.postings[d][int(q < 0)][2], d) for d, q in enumerate(query.tolist()) if q), reverse=True
        )
        bounds = np.array([b for b, _ in terms], dtype=np.int64)
        rest = np.append(np.cumsum(bounds[::-1])[::-1], 0)
        own = self.keys == key
        gathered = np.zeros(len(self.keys), dtype=np.int64)
        # The strongest lists alone point to good vectors, whose scores set the first threshold.
        seeds = min(4, len(terms))
        self._traverse(gathered, query, [d for _, d in terms[:seeds]])
        gathered[own] = -1
        start = np.argpartition(-gathered, min(4 * k, len(gathered) - 1))[: 4 * k + 1]
        known = np.sort((self.vectors[start] @ query)[~own[start]])
        threshold = int(known[-k]) if len(known) >= k else None
        if threshold is None or threshold <= 0:
            return self._ranked(np.flatnonzero(~own), query, k)
        essential = int(np.argmax(rest < threshold))
        self._traverse(gathered, query, [d for _, d in terms[seeds:essential]])
        essential = max(essential, seeds)
        near = np.flatnonzero((gathered > 0) & (gathered + rest[essential] >= threshold) & ~own)
        partial = gathered[near]
        for at in range(essential, len(terms)):
            d = terms[at][1]
            partial = partial + np.maximum(self.vectors[near, d] * query[d], 0)
            competes = partial + rest[at + 1] >= threshold
            near, partial = near[competes], partial[competes]
        return self._ranked(near, query, k)

    def _traverse(self, gathered: np.ndarray, query: np.ndarray, dimensions: list[int]) -> None:
        for d in dimensions:
            at, weight, _ = self.postings[d][int(query[d] < 0)]
            gathered[at] += weight * abs(query[d])

    def _ranked(self, places: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        score = self.vectors[places] @ query
        order = np.lexsort((self.keys[places], -score))[:k]
        return places[order], score[order]


def _packed(vectors: DataFrame, group: str, key: str, weights: str) -> DataFrame:
    """One row per group: its keys, ascending, and its vectors, filled up with zeros, as bytes of so many a number."""

    def pack(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("key")
        rows = batch.column("weights").to_pylist()
        width = max(map(len, rows), default=0)
        dense = np.zeros((len(rows), width), dtype="<i8")
        for place, row in enumerate(rows):
            dense[place, : len(row)] = row
        n_bytes = next(n for n in (1, 2, 4, 8) if _fits(dense, n))
        return pa.table(
            {
                "group": [batch.column("group")[0].as_py()],
                "keys": [batch.column("key").to_numpy().astype("<i8").tobytes()],
                "width": [width],
                "n_bytes": [n_bytes],
                "data": [dense.astype(f"<i{n_bytes}").tobytes()],
            },
            schema=_GROUP,
        )

    named = vectors.select(F.col(group).alias("group"), F.col(key).alias("key"), F.col(weights).alias("weights"))
    return named.groupBy("group").applyInArrow(pack, _GROUP_TYPES)


def _fits(dense: np.ndarray, n_bytes: int) -> bool:
    held = np.iinfo(f"<i{n_bytes}")
    return held.min <= int(dense.min(initial=0)) and int(dense.max(initial=0)) <= held.max


def _unpacked(keys: bytes, width: int, n_bytes: int, data: bytes, wide: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.frombuffer(keys, dtype="<i8")
    dense = np.zeros((len(key), wide), dtype=np.int64)
    dense[:, :width] = np.frombuffer(data, dtype=f"<i{n_bytes}").reshape(len(key), width)
    return key, dense


def _copies(groups: DataFrame, name: str, n: int) -> DataFrame:
    """Each group once for each number below n, one after another: `explode` holds all copies of a row at once."""

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                for number in range(n):
                    yield pa.RecordBatch.from_arrays([*one.columns, pa.array([number])], names=[*one.schema.names, name])

    return groups.mapInArrow(copied, f"{_GROUP_TYPES}, {name} long")


def _largest(dense: np.ndarray) -> int:
    return max(abs(int(dense.min(initial=0))), int(dense.max(initial=0)))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    weights: str = "weights",
    shard_rows: int = 8192,
    block_rows: int = 4096,
) -> DataFrame:
    """The k highest inner products of each query with the vectors under other keys: query_id, rank, key, score.

    `weights` is an array of longs; missing positions at the end count as zero. Vectors and queries that are null or
    hold a null, and rows without a key, take no part. Fewer than k other vectors give all of them; ties go to the
    smaller key; rows that repeat a vector are candidates of their own, but none of a query with their key. Of queries
    that repeat a key the least vector is taken. No queries or no vectors give no rows. Scores that do not fit a long raise an error.

    Shards and blocks of queries have a bounded number of rows; blocks are sent to the shards, one copy at a time.
    """
    whole = F.col(key).isNotNull() & F.col(weights).isNotNull() & ~F.exists(weights, lambda w: w.isNull())

    def grouped(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
        rows = rows.where(whole).select(F.col(key).cast("long").alias("key"), F.col(weights).alias("weights"))
        n = max(1, -(-rows.count() // size))
        numbered = rows.withColumn("group", F.pmod(F.xxhash64("key", "weights"), F.lit(n)))
        return _packed(numbered, "group", "key", "weights"), n

    shards, n_shards = grouped(vectors, shard_rows)
    once = queries.where(whole).groupBy(key).agg(F.min(weights).alias(weights))
    blocks, n_blocks = grouped(once, block_rows)
    # A shard meets its blocks in one task, or in more where there are fewer shards than tasks.
    n_parts = max(1, min(n_blocks, -(-int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n_shards)))
    dealt = _copies(shards, "part", n_parts)
    dealt = dealt.select(*[F.col(c).alias(f"shard_{c}") for c in dealt.columns])
    sent = _copies(blocks, "shard", n_shards).withColumn("part", F.col("group") % n_parts)
    # From the left, so that a row meets one other: all that a row meets are held at once.
    cells = sent.join(dealt, (F.col("shard") == F.col("shard_group")) & (F.col("part") == F.col("shard_part")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                wide = max(row["shard_width"], row["width"])
                keys, query = _unpacked(row["keys"], row["width"], row["n_bytes"], row["data"], wide)
                if last != (row["shard_group"], wide):
                    own = (row[f"shard_{n}"] for n in ("keys", "width", "n_bytes", "data"))
                    held = Shard(*_unpacked(*own, wide))
                    last = row["shard_group"], wide
                if wide * _largest(held.vectors) * _largest(query) > _LARGEST:
                    raise OverflowError("inner products do not fit a long")
                found = [held.best(int(i), q, k) for i, q in zip(keys, query, strict=True)]
                sizes = [len(at) for at, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(keys, sizes)),
                        pa.array(held.keys[np.concatenate([at for at, _ in found])]),
                        pa.array(np.concatenate([score for _, score in found])),
                    ],
                    names=["query_id", "other", "score"],
                )

    of = ["keys", "width", "n_bytes", "data"]
    found = cells.select("shard_group", *[f"shard_{n}" for n in of], *of).mapInArrow(search, "query_id long, other long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "other")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("other").alias(key), "score")
