"""Packing of tokenised documents into sequences of a fixed length, by minimum bin slack.

A document's ids are cut at multiples of the capacity; the rest of each document is a shorter piece. How pieces are
combined is decided on the histogram of piece lengths alone, which has no more rows than the capacity has values:
starting from the longest remaining length, a subset-sum over bitsets finds the multiset of remaining lengths that
comes closest to filling a window, and that pattern is used for as many windows as the counts allow. Places in the
windows then follow from each piece's number among the pieces of its length.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemend.session import materialize

# Words whose ids a worker remembers; beyond that it starts anew, which changes the speed only.
_REMEMBERED_WORDS = 800_000
# Marks that are tokens of their own behind a letter.
_APART = frozenset(",.")
# Bytes of text looked at together: fewer take less memory of a worker and some more time.
_PART_BYTES = 8 << 20


class WordIds:
    """Ids of a text as little-endian 32-bit bytes, remembered by word.

    Only for vocabularies that drop white space before they look for words: the ids of a text are then those of its
    parts between spaces and line breaks, one after another.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        last = [i for word, i in self._tokenizer.get_vocab().items() if word.endswith("</w>")]
        self._ends = np.zeros(self._tokenizer.get_vocab_size(), dtype=bool)
        self._ends[last] = True

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each.

        Words are split and numbered as Arrow arrays, so Python only sees the distinct words of the texts.
        """
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        numbered = split.flatten().dictionary_encode()
        words = numbered.dictionary.to_pylist()
        if len(self._known) > _REMEMBERED_WORDS:
            self._known.clear()
        self._learn(set(words) - self._known.keys())
        found = list(map(self._known.__getitem__, words))
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        buffers = [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)])), pa.py_buffer(b"".join(found))]
        taken = pa.Array.from_buffers(pa.large_binary(), len(found), buffers).take(numbered.indices)
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(taken) + 1] // 4
        ids = np.frombuffer(taken.buffers()[2], dtype="<u4", count=ends[-1]) if ends[-1] else np.empty(0, dtype="<u4")
        edges = split.offsets.to_numpy()
        return ids, np.diff(ends[edges - edges[0]])

    def _learn(self, words: set[str]) -> None:
        """Find the ids of words not met before.

        A comma or full stop behind a letter is a token of its own, and ASCII letters are lowered anyway, so such words
        fall back on their core. (Lowered, a few letters end in a combining mark, which joins the comma's token.)
        """
        known = self._known
        apart = [w for w in words if w[-1:] in _APART and w[-2:-1].isalpha() and w[-2].lower().isalpha()]
        whole = list(words.difference(apart))
        cores = [w.lower() if w.isascii() else w for w in whole]
        apart_cores = [w[:-1].lower() if w.isascii() else w[:-1] for w in apart]
        new = {*cores, *apart_cores, *_APART} - known.keys()
        letters = [w for w in new if w.isalpha()]
        rest = [w for w in new if not w.isalpha()]
        known.update(zip(letters, self._in_one_text(letters), strict=True))
        known.update(zip(rest, self._one_by_one(rest), strict=True))
        ids = known.__getitem__
        known.update(zip(whole, map(ids, cores), strict=True))
        known.update([(w, ids(c) + ids(w[-1])) for w, c in zip(apart, apart_cores, strict=True)])

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4").tobytes() for f in found]

    def _in_one_text(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, each of which has one id that ends a word, its last."""
        if not words:
            return []
        # Without offsets, which nobody asks for, this takes less time.
        (found,) = self._tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words):
            return self._one_by_one(words)
        packed = ids.tobytes()
        starts = [0, *ends[:-1].tolist()]
        return [packed[4 * a : 4 * b] for a, b in zip(starts, ends.tolist(), strict=True)]


_encoders: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def _parts(texts: pa.Array, part_bytes: int) -> Iterator[tuple[int, pa.StringArray]]:
    """Texts in parts of a bounded total, each with the place of its first; null texts are empty."""
    texts = texts.fill_null("").cast(pa.string())
    part = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 64) // part_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield a, texts.slice(a, b - a)


def _numbers_of(length: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length, counted on in `places`."""
    order = np.argsort(length, kind="stable")
    in_order = length[order]
    first = np.searchsorted(in_order, in_order)
    number = np.empty(len(length), dtype=np.int64)
    number[order] = np.arange(len(length)) - first + places[in_order]
    places += np.bincount(length, minlength=len(places))
    return number


def cut(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    end_id: int,
    text: str = "text",
    key: str = "doc_id",
    part_bytes: int = _PART_BYTES,
) -> DataFrame:
    """Pieces of every document: its key, `start`, `length`, `doc_tokens` and the `ids` themselves.

    `part` and `place` number the pieces of a length within a task.
    """
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("place", T.LongType()),
        ]
    )
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary)
        part = TaskContext.get().partitionId()
        places = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for first, some in _parts(batch.column(1), part_bytes):
                ids, sizes = encoder.encode(some)
                total = sizes + 1
                ends = np.cumsum(total)
                whole = np.full(int(total.sum()), end_id, dtype="<u4")
                inner = np.ones(len(whole), dtype=bool)
                inner[ends - 1] = False
                whole[inner] = ids
                n = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                length = np.minimum(total[row] - start, capacity)
                # The pieces lie one behind the other in `whole`.
                offsets = np.concatenate([[0], np.cumsum(length)]) * 4
                buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(whole)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + first)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(total[row]),
                        pa.Array.from_buffers(pa.large_binary(), len(row), buffers).cast(pa.binary()),
                        pa.array(np.full(len(row), part, dtype=np.int32)),
                        pa.array(_numbers_of(length, places)),
                    ],
                    names=schema.names,
                )

    return docs.select(F.col(key), F.col(text)).mapInArrow(pieces, schema)


@dataclass(frozen=True)
class Pattern:
    """A filling used for `windows` windows: how many pieces of which length."""

    counts: tuple[tuple[int, int], ...]
    windows: int


def closest_filling(room: int, counts: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """Pieces of the given lengths whose total comes closest to `room` from below.

    Bit t of a set says that total t can be reached. Counts are split into powers of two, so a length takes a few
    shifts however many pieces it has.
    """
    limit = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for size in lengths:
        if size > room or not counts[size]:
            continue
        left, chunk = min(counts[size], room // size), 1
        while left:
            chunk = min(chunk, left)
            steps.append((size, chunk, reached))
            reached |= (reached << (size * chunk)) & limit
            left -= chunk
            chunk *= 2
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    chosen: dict[int, int] = {}
    for size, chunk, before in reversed(steps):
        if not before >> total & 1:
            chosen[size] = chosen.get(size, 0) + chunk
            total -= size * chunk
    return chosen


def plan_windows(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up a histogram of piece lengths."""
    counts = {size: n for size, n in histogram.items() if n}
    patterns = []
    while counts:
        lengths = sorted(counts, reverse=True)
        longest = lengths[0]
        counts[longest] -= 1
        chosen = closest_filling(capacity - longest, counts, lengths)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        windows = min(counts[size] // n for size, n in chosen.items())
        patterns.append(Pattern(tuple(sorted(chosen.items(), reverse=True)), windows))
        for size, n in chosen.items():
            counts[size] -= n * windows
            if not counts[size]:
                del counts[size]
    return patterns


def _ranges(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from, to, pieces a window, first window, offset) for the pieces of a length, in order of number."""
    used: dict[int, int] = {}
    found, window = [], 0
    for pattern in patterns:
        offset = 0
        for size, n in pattern.counts:
            first = used.get(size, 0)
            used[size] = first + n * pattern.windows
            found.append((size, first, used[size], n, window, offset))
            offset += size * n
        window += pattern.windows
    return found


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 1,
    text: str = "text",
    key: str = "doc_id",
    measures: dict[str, Column] | None = None,
    keep_ids: bool = True,
    part_bytes: int = _PART_BYTES,
) -> DataFrame:
    """Every document's ids in pieces, each with its `sequence_id` and `offset`.

    Columns: the key, start, length, doc_tokens, the measures (expressions over `ids`, taken before the shuffle), ids
    (packed 32-bit little-endian; left out on demand), sequence_id, offset. Each row is a document of its own, also
    when its key or text repeats or its key is null. A null or empty text is the end id alone. No rows give no
    pieces. Sequences are numbered from 0 without gaps; within one, pieces lie side by side from 0.

    The driver holds one count per length, at most `capacity` of them, and the patterns made of those: fewer than
    the sum of capacity / length over all lengths, whatever the number of documents.
    """
    spark = docs.sparkSession
    measures = measures or {}
    names = [key, "start", "length", "doc_tokens", *measures, *(["ids"] if keep_ids else [])]
    pieces = materialize(
        cut(docs, vocabulary, capacity, end_id, text, key, part_bytes)
        .withColumns(measures)
        .select(*names, "part", "place"),
        "pieces",
    )
    cells = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # At most one row per length.
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = spark.createDataFrame(
        _ranges(plan_windows(histogram, capacity)),
        "size long, first long, last long, each long, window long, base long",
    )
    before = (
        F.sum("n").over(
            Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        - F.col("n")
    )
    starts = cells.select(F.col("part").alias("in_part"), F.col("length").alias("of_length"), before.alias("before"))
    numbered = pieces.join(
        starts, (F.col("part") == F.col("in_part")) & (F.col("length") == F.col("of_length"))
    ).withColumn("number", F.col("before") + F.col("place"))
    placed = numbered.join(
        F.broadcast(ranges),
        (F.col("length") == F.col("size")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("last")),
    )
    within = F.col("number") - F.col("first")
    return placed.select(
        *names,
        (F.col("window") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + within % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
