"""Language-model scores by online logistic context mixing.

A text is a sequence of words and an end. Every frequent word has a prefix code; any other word is an escape followed by
the codes of its bytes and of its end. Each binary decision of these codes is predicted in several contexts at once:
none, the ending of the word before, the two words before; within a spelled word, two and four bytes before and its whole beginning. A context and a decision are hashed to a slot that counts zeros and ones over all training documents.
The predictions are combined in the logistic domain by weights that a gate selects (frequent or spelled word, how much
two of the contexts have seen), a last map refines the result. Both are first fitted to the decisions of all training
documents and go on learning within every document, from what they have already coded. The cost of a text is the sum over its decisions, so the scores are those of one distribution.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.session import materialize

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Stands for the end of a text: no word holds a space.
_END = b" "
_CONTEXTS = 3
_MIX, _STIR = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
# Words counted before a task passes its counts on; bytes of text and words of a text worked on at a time; decisions
# learnt from together; slots of a part of the table.
_COUNTED, _TEXT, _SEGMENT, _STEP, _PART = 500_000, 1 << 19, 1 << 16, 512, 1 << 15
# Words whose decisions are counted at a time, so that these stay in a core's cache.
_COUNTING = 1 << 13
# Counts up to here have a level of their own; levels above grow by a factor.
_EXACT, _GROWTH, _LEVELS = 64, 1.12, 256
_PRIOR, _RATE, _LEAST = 0.6, 0.002, 1e-4
_BINS, _SPAN, _HELD, _NEWTON = 33, 8.0, 32.0, 25
_GATES = 18


@dataclass(frozen=True)
class Shape:
    """Bounds of a model: words with a code of their own (those that occur `least` times, so that words seen once teach
    how new ones are spelled), slots a context (as a power of two), and how many training documents the first weights are
    learnt from: all unless asked otherwise, with 0 they stay even. All counts are taken over all training documents."""

    lexicon: int = 1 << 17
    least: int = 2
    bits: int = 21
    tuned_rows: int | None = None


@dataclass(frozen=True)
class Codes:
    """Prefix codes: the decisions of symbol s are places first[s] to first[s + 1] of `node` and `bit`."""

    first: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def huffman(weights: list[int]) -> Codes:
    """Prefix codes of least expected length for symbols of the given weights, two symbols or more."""
    n = len(weights)
    parent, branch = np.zeros(2 * n - 1, dtype=np.int64), np.zeros(2 * n - 1, dtype=np.uint8)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    for node in range(n, 2 * n - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[[left, right]], branch[right] = node, 1
        heapq.heappush(heap, (a + b, node))
    at, levels = np.arange(n), []
    while (inner := at != 2 * n - 2).any():
        levels.append((np.flatnonzero(inner), parent[at[inner]] - n, branch[at[inner]]))
        at = np.where(inner, parent[at], at)
    depth = np.bincount(np.concatenate([s for s, _, _ in levels]), minlength=n)
    first = np.concatenate([[0], np.cumsum(depth)])
    node, bit = np.empty(first[-1], dtype=np.uint32), np.empty(first[-1], dtype=np.uint8)
    for step, (symbol, above, taken) in enumerate(levels):
        place = first[symbol + 1] - 1 - step
        node[place], bit[place] = above, taken
    return Codes(first, node, bit)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of several ranges one after another."""
    ends = np.cumsum(size)
    found = np.repeat(start - ends + size, size)
    found += np.arange(len(found))
    return found


def _hashes(words: list[bytes]) -> np.ndarray:
    """Of the words, and of their endings of two bytes."""
    return np.array([[zlib.crc32(w) for w in words], [zlib.crc32(w[-2:]) for w in words]], dtype=np.uint32)


class Lexicon:
    """Frequent words with their counts, and the codes of words, of the end, of the escape and of bytes."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, rest: int) -> None:
        self.words, self.counts, self.ends = words, np.array(counts, dtype=np.int64), ends
        self.end, self.escape, self.byte = len(words), len(words) + 1, len(words) + 2
        spelled = Counter(b"".join(words))
        whole = huffman([*counts, max(ends, 1), max(rest, 1)])
        letters = huffman([*(spelled[b] + 1 for b in range(256)), len(words) + 1])
        self.codes = Codes(
            np.concatenate([whole.first, letters.first[1:] + whole.first[-1]]),
            np.concatenate([whole.node, letters.node + np.uint32(len(words) + 2)]),
            np.concatenate([whole.bit, letters.bit]),
        )
        self.mixed = self.codes.node * _MIX
        self.rare = self.byte + 257
        self.numbers = {**{w: i for i, w in enumerate(words)}, _END: self.end}
        self.hashes = _hashes([*words, _END])
        self.base = np.log10(np.append(self.counts, ends) + 0.1)


class _Numbers(dict):
    """Numbers of words; words outside the lexicon get new ones as they are met."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__(lexicon.numbers)
        self._next, self.met = lexicon.rare, []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self._next + len(self.met)
        self.met.append(word)
        return number


@dataclass
class Decisions:
    """Binary decisions of some documents in order: document, value, whether of a spelled word, and a slot a context."""

    doc: np.ndarray
    bit: np.ndarray
    spelled: np.ndarray
    slots: list[np.ndarray]


class Reading:
    """Some texts as numbers of words, from which decisions are made a part at a time."""

    def __init__(self, lexicon: Lexicon, texts: list[bytes | None]) -> None:
        numbers = _Numbers(lexicon)
        split = [(t or b"").translate(_LOWER).split() for t in texts]
        for words in split:
            words.append(_END)
        self.lexicon, self.sizes = lexicon, np.array([len(w) for w in split], dtype=np.int64)
        flat = map(numbers.__getitem__, chain.from_iterable(split))
        self.words = np.fromiter(flat, dtype=np.int64, count=int(self.sizes.sum()))
        self.bytes = np.array([sum(map(len, w)) + len(w) - 3 for w in split], dtype=np.int64).clip(0)
        self.rare = numbers.met
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.sizes)
        start = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.words)) - np.repeat(start, self.sizes)
        self._spell()
        gap = np.zeros(lexicon.rare - lexicon.end - 1, dtype=np.uint32)
        own, ending = (np.concatenate([a, gap, b])[self.words] for a, b in zip(lexicon.hashes, self._hashes, strict=True))
        before = [np.where(self.place >= back, np.roll(own, back), np.uint32(back)) for back in (1, 2)]
        ending = np.where(self.place >= 1, np.roll(ending, 1), np.uint32(1))
        self._contexts = [None, ending * _STIR, (before[0] * _MIX ^ before[1]) * _STIR]

    def _spell(self) -> None:
        """Codes and contexts of the letters of every rare word."""
        lengths = np.array([len(w) + 1 for w in self.rare], dtype=np.int64)
        self._first = np.concatenate([[0], np.cumsum(lengths)])
        self._hashes = _hashes(self.rare)
        # A space ends each word here; words hold none.
        letters = np.frombuffer(b"".join(w + b" " for w in self.rare), dtype=np.uint8)
        place = np.arange(len(letters)) - np.repeat(self._first[:-1], lengths)
        ends = place == np.repeat(lengths, lengths) - 1
        self._letter_codes = self.lexicon.byte + np.where(ends, 256, letters.astype(np.int64))
        back = [np.where(place >= i, np.roll(letters, i), 0).astype(np.uint32) for i in (1, 2, 3, 4)]
        two = back[0] | back[1] << np.uint32(8)
        four = two | back[2] << np.uint32(16) | back[3] << np.uint32(24)
        power = np.cumprod(np.full(int(lengths.max(initial=1)), _MIX, dtype=np.uint32), dtype=np.uint32)
        running = np.cumsum((letters.astype(np.uint32) + np.uint32(1)) * power[place], dtype=np.uint32)
        before = np.concatenate([[np.uint32(0)], running[:-1]]).astype(np.uint32) if len(letters) else running
        begun = before - np.repeat(before[self._first[:-1]], lengths) if len(letters) else before
        self._letter_contexts = [(c + np.uint32(i)) * _STIR for i, c in enumerate((two, four, begun))]

    def decisions(self, chosen: np.ndarray, bits: int) -> Decisions:
        """Decisions of the words at the chosen places, in order."""
        lexicon, words = self.lexicon, self.words[chosen]
        rare = np.flatnonzero(words >= lexicon.rare)
        of = words[rare] - lexicon.rare
        spelled_size = self._first[of + 1] - self._first[of]
        events = np.ones(len(words), dtype=np.int64)
        events[rare] += spelled_size
        at = np.cumsum(events) - events
        codes = np.empty(int(events.sum()), dtype=np.int64)
        codes[at] = np.where(words < lexicon.rare, words, lexicon.escape)
        into, source = _ranges(at[rare] + 1, spelled_size), _ranges(self._first[of], spelled_size)
        codes[into] = self._letter_codes[source]
        first = lexicon.codes.first
        size = first[codes + 1] - first[codes]
        place = _ranges(first[codes], size)
        node = lexicon.mixed.take(place)
        slots = []
        for word_context, letter_context in zip(self._contexts, self._letter_contexts, strict=True):
            context = np.zeros(len(codes), dtype=np.uint32)
            if word_context is not None:
                context[at] = word_context[chosen]
            context[into] = letter_context[source]
            slot = np.repeat(context, size)
            slot ^= node
            slot *= _STIR
            slot >>= np.uint32(32 - bits)
            slots.append(slot)
        spelled = np.zeros(len(codes), dtype=np.uint8)
        spelled[into] = 1
        # How many decisions each word and its letters take together.
        each = np.add.reduceat(size, at) if len(at) else at
        doc = np.repeat(self.doc[chosen], each)
        return Decisions(doc, lexicon.codes.bit.take(place), np.repeat(spelled, size), slots)


def _levels(counts: np.ndarray) -> np.ndarray:
    above = _EXACT + np.log(np.maximum(counts, _EXACT) / _EXACT) / np.log(_GROWTH)
    return np.where(counts <= _EXACT, counts, np.minimum(np.rint(above), _LEVELS - 1)).astype(np.uint16)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By state, a pair of levels: log-odds of a one, and how much was seen (none, little, more)."""
    level = np.arange(_LEVELS)
    value = np.where(level <= _EXACT, level, _EXACT * _GROWTH ** (level - float(_EXACT)))
    zeros, ones = np.repeat(value, _LEVELS), np.tile(value, _LEVELS)
    odds = np.log((ones + _PRIOR) / (zeros + _PRIOR)).astype(np.float32)
    return odds, np.digitize(zeros + ones, [0.5, 3.5]).astype(np.uint8)


def _grades() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grade of every state, and by grade the log-odds and how much was seen.

    States that have seen nothing are one grade, those that have seen little differ by their odds, and all others by
    theirs in steps of a half.
    """
    odds, seen = _tables()
    little = np.unique(odds[seen == 1])
    wide = np.arange(-16, 17, dtype=np.float32) / 2
    step = np.rint(np.clip(odds, -8, 8) * 2).astype(np.int64) + 16
    grade = np.select([seen == 0, seen == 1], [0, 1 + np.searchsorted(little, odds)], 1 + len(little) + step)
    kinds = np.repeat(np.arange(3), [1, len(little), len(wide)])
    return grade.astype(np.uint8), np.concatenate([np.zeros(1, np.float32), little, wide]), kinds


def _less(states: np.ndarray, own: np.ndarray) -> np.ndarray:
    """States without own counts, both with zeros in the upper and ones in the lower byte; levels beyond the exact ones
    hardly change, so own counts above those may be cut to a byte."""
    levels, counts = np.ascontiguousarray(states).view(np.uint8), own.view(np.uint8)
    counts = counts * (levels <= _EXACT)
    np.minimum(levels, counts, out=counts)
    return np.subtract(levels, counts, out=counts).view(np.uint16)


def _cells(slots: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Places of slots' counts of zeros or ones."""
    cell = slots.astype(np.intp)
    cell <<= 1
    cell += bit
    return cell


@dataclass
class Mixer:
    """Weights by document, gate and context, and the refining map by document, kind of decision and bin."""

    weights: np.ndarray
    refined: np.ndarray

    @classmethod
    def new(cls) -> Mixer:
        bins = np.linspace(-_SPAN, _SPAN, _BINS)
        return cls(np.full((1, _GATES, _CONTEXTS), 0.3, np.float32), np.tile(1 / (1 + np.exp(-bins)), (1, 2, 1)).astype(np.float32))

    def copies(self, n: int) -> Mixer:
        return Mixer(np.repeat(self.weights, n, axis=0), np.repeat(self.refined, n, axis=0))

    @classmethod
    def fitted(cls, counts: np.ndarray) -> Mixer:
        """Weights and map that fit decisions best, counted by spelled word, bit and the grade of every context.

        Each gate's weights are a logistic regression that is drawn to the even ones like some decisions would, by Newton
        steps; the map holds the share of ones of its bins.
        """
        mixer = cls.new()
        _, value, seen = _grades()
        # Spelled words and bits come first.
        cells = np.flatnonzero(counts.sum(axis=1))
        zeros, ones = counts.transpose(1, 0, 2).reshape(2, -1)[:, cells].astype(float)
        spelled, *grades = np.unravel_index(cells, (2, *[len(value)] * _CONTEXTS))
        odds = np.stack([value[g] for g in grades], axis=1).astype(float)
        gate = (spelled * 3 + seen[grades[1]]) * 3 + seen[grades[2]]
        mixed = np.zeros(len(cells))
        for g in np.unique(gate):
            at = np.flatnonzero(gate == g)
            x, n, start = odds[at], zeros[at] + ones[at], mixer.weights[0, g].astype(float)
            best = start.copy()
            for _ in range(_NEWTON):
                chance = 1 / (1 + np.exp(-np.clip(x @ best, -_SPAN, _SPAN)))
                slope = x.T @ (ones[at] - n * chance) - _HELD * (best - start)
                step = np.linalg.solve((x * (n * chance * (1 - chance))[:, None]).T @ x + _HELD * np.eye(_CONTEXTS), slope)
                # No context's word is turned round.
                best = np.maximum(best + np.clip(step, -0.5, 0.5), 0)
            mixer.weights[0, g] = best
            mixed[at] = x @ best
        low = np.rint((np.clip(mixed, -_SPAN, _SPAN) + _SPAN) * (_BINS - 1) / (2 * _SPAN)).astype(np.int64)
        low += spelled * _BINS
        size = mixer.refined.size
        held = mixer.refined.reshape(-1) * _HELD + np.bincount(low, ones, minlength=size)
        mixer.refined = (held / (_HELD + np.bincount(low, zeros + ones, minlength=size))).astype(np.float32).reshape(1, 2, -1)
        return mixer

    def cost(self, found: Decisions, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Log2 probability of each document's decisions, learning from every `_STEP` of them before the next."""
        total = np.zeros(len(self.weights))
        size = np.bincount(found.doc, minlength=len(total))
        start = np.cumsum(size) - size
        # Gate and value of a decision in one byte, and a row of weights a context.
        marks = gate << np.uint8(1) | found.bit
        weights = np.ascontiguousarray(self.weights.reshape(-1, _CONTEXTS).T)
        for first in range(0, int(size.max(initial=0)), _STEP):
            live = np.flatnonzero(size > first)
            each = np.minimum(size[live] - first, _STEP)
            take = _ranges(start[live] + first, each)
            cost = self._learn(weights, np.repeat(live, each), marks.take(take), [o.take(take) for o in odds])
            total[live] += np.add.reduceat(cost, np.cumsum(each) - each, dtype=np.float64)
        self.weights = np.ascontiguousarray(weights.T).reshape(self.weights.shape)
        return total

    def _learn(self, weights: np.ndarray, doc: np.ndarray, marks: np.ndarray, odds: list[np.ndarray]) -> np.ndarray:
        # Places as numpy wants them, so that no use of them converts them again.
        cell = doc * _GATES + (marks >> np.uint8(1))
        bit = (marks & np.uint8(1)).astype(np.float32)
        mixed = weights[0].take(cell) * odds[0]
        for k in range(1, _CONTEXTS):
            mixed += weights[k].take(cell) * odds[k]
        mixed = np.clip(mixed, -_SPAN + 0.01, _SPAN - 0.01)
        chance = 1 / (1 + np.exp(-mixed))
        scaled = (mixed + np.float32(_SPAN)) * np.float32((_BINS - 1) / (2 * _SPAN))
        low = scaled.astype(np.intp)
        share = scaled - low.astype(np.float32)
        # The upper half of the gates is of spelled words.
        low += (doc * 2 + (marks >= _GATES)) * _BINS
        refined = self.refined.reshape(-1)
        final = (chance + refined.take(low) * (1 - share) + refined.take(low + 1) * share) / 2
        final = np.clip(final, _LEAST, 1 - _LEAST)
        cost = np.log(1 - np.abs(bit - final)) * np.float32(1 / np.log(2))
        error = (bit - chance) * np.float32(_RATE)
        for k in range(_CONTEXTS):
            weights[k] += np.bincount(cell, error * odds[k], minlength=weights.shape[1])
        near = low + (share >= 0.5)
        refined += np.bincount(near, bit - refined.take(near), minlength=refined.size) / (
            _HELD + np.bincount(near, minlength=refined.size)
        )
        return cost


class Model:
    """Lexicon, states of all slots, and the mixer that every document starts from."""

    def __init__(self, lexicon: Lexicon, states: bytes, bits: int) -> None:
        self.lexicon, self.states, self.bits = lexicon, states, bits
        self.mixer = Mixer.new()

    def _states(self, found: Decisions) -> list[np.ndarray]:
        table = np.frombuffer(self.states, dtype="<u2").reshape(_CONTEXTS, -1)
        return [table[k].take(slots) for k, slots in enumerate(found.slots)]

    def _inputs(self, found: Decisions, own: list[tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds by context and the gate of every decision; `own` counts of cells (a slot and a bit) are taken off first."""
        if not hasattr(self, "_cached"):
            self._cached = _tables()
        odds, seen = self._cached
        states = self._states(found)
        if own is not None:
            counts = np.zeros(2 << self.bits, dtype=np.uint8)
            for k, (cells, n) in enumerate(own):
                counts[cells ^ 1] = np.minimum(n, 255)
                states[k] = _less(states[k], counts.view("<u2").take(found.slots[k]))
                counts[cells ^ 1] = 0
        gate = (found.spelled * np.uint8(3) + seen.take(states[1])) * np.uint8(3) + seen.take(states[2])
        return np.stack([odds.take(s) for s in states]), gate

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_cached"}

    def graded(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """The cell of every decision in the counts of `Mixer.fitted`, each text without its own part of the counts."""
        reading = Reading(self.lexicon, texts)
        grade, value, _ = _grades()
        counts = np.zeros((_CONTEXTS, 2 << self.bits), dtype=np.uint8)
        pairs = counts.view("<u2")
        ends = np.cumsum(reading.sizes)
        one, most = np.uint8(1), min(_COUNTING, _SEGMENT)

        def cells(found: Decisions, own: list[np.ndarray]) -> np.ndarray:
            cell = (found.spelled * np.uint8(2) + found.bit).astype(np.int32)
            for states, mine in zip(self._states(found), own, strict=True):
                cell = cell * np.int32(len(value)) + grade.take(_less(states, mine))
            return cell

        first = 0
        while first < len(ends):
            begin = int(ends[first] - reading.sizes[first])
            last = max(first + 1, int(np.searchsorted(ends, begin + most, side="right")))
            parts = [np.arange(a, min(a + most, ends[last - 1])) for a in range(begin, int(ends[last - 1]), most)]
            if len(parts) == 1:
                # Whole texts, counted one after another.
                found = reading.decisions(parts[0], self.bits)
                cuts = np.searchsorted(found.doc, np.arange(first, last + 1))
                own = [np.empty(len(found.bit), dtype="<u2") for _ in range(_CONTEXTS)]
                for k, slots in enumerate(found.slots):
                    slot, cell = slots.astype(np.intp), _cells(slots, found.bit ^ one)
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                        np.add.at(counts[k], cell[a:b], one)
                        own[k][a:b] = pairs[k].take(slot[a:b])
                        # Both counts of a slot at once.
                        pairs[k][slot[a:b]] = 0
                yield cells(found, own)
            else:
                # One long text, read twice.
                for part in parts:
                    found = reading.decisions(part, self.bits)
                    for k, slots in enumerate(found.slots):
                        np.add.at(counts[k], _cells(slots, found.bit ^ one), one)
                for part in parts:
                    found = reading.decisions(part, self.bits)
                    yield cells(found, [pairs[k].take(slots) for k, slots in enumerate(found.slots)])
                counts.fill(0)
            first = last

    def score(self, texts: list[bytes | None]) -> tuple[Reading, np.ndarray]:
        """The texts read, and the log2 probability of each."""
        reading = Reading(self.lexicon, texts)
        mixer, total = self.mixer.copies(len(texts)), np.zeros(len(texts))
        for part in range(0, int(reading.sizes.max(initial=0)), _SEGMENT):
            chosen = np.flatnonzero((reading.place >= part) & (reading.place < part + _SEGMENT))
            found = reading.decisions(chosen, self.bits)
            total += mixer.cost(found, *self._inputs(found))
        return reading, total


def _texts(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """Texts in parts of a bounded total, each with the place of its first; one longer text is a part of its own."""
    values = column.cast(pa.binary()).to_pylist()
    first, held = 0, 0
    for i, value in enumerate(values):
        size = len(value or b"") + 64
        if held and held + size > _TEXT:
            yield first, values[first:i]
            first, held = i, 0
        held += size
    if held:
        yield first, values[first:]


def _word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over all texts, words as bytes; the end is not among them."""

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for texts in batches:
            for text in texts.column(0).cast(pa.binary()).to_pylist():
                counts.update((text or b"").translate(_LOWER).split())
                if len(counts) > _COUNTED:
                    yield batch(counts)
                    counts.clear()
        yield batch(counts)

    found = training.select("text").mapInArrow(counted, "word binary, n long")
    return materialize(found.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")


def _states(training: DataFrame, lexicon: Lexicon, bits: int) -> bytes:
    """Counts of zeros and ones of every slot over all texts, as pairs of levels.

    A task sends its own sums, in parts of `_PART` slots, so what is shuffled grows with the tasks; the sums of a part
    are folded one after another, whatever their number.
    """
    context = training.sparkSession.sparkContext
    shared = context.broadcast(lexicon)
    parts = max(1, (1 << bits) // _PART)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((_CONTEXTS, 2 << bits), dtype=np.uint32)
        one = np.uint32(1)
        for texts in batches:
            for _, some in _texts(texts.column(0)):
                reading = Reading(shared.value, some)
                for a in range(0, len(reading.words), _COUNTING):
                    found = reading.decisions(np.arange(a, min(a + _COUNTING, len(reading.words))), bits)
                    for k, slots in enumerate(found.slots):
                        np.add.at(counts[k], _cells(slots, found.bit), one)
        for k in range(_CONTEXTS):
            for part, sums in enumerate(counts[k].reshape(parts, -1)):
                if most := int(sums.max()):
                    kind = np.dtype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")
                    values = [[k * parts + part], [kind.itemsize], [sums.astype(kind).tobytes()]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.binary()), strict=True)],
                        names=["part", "width", "sums"],
                    )

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    if total is not None:
                        yield packed(part, total)
                    part, total = row["part"], 0
                total = total + np.frombuffer(row["sums"], dtype=f"<u{row['width']}").astype(np.int64)
        if total is not None:
            yield packed(part, total)

    def packed(part: int, total: np.ndarray) -> pa.RecordBatch:
        zeros, ones = _levels(total.reshape(-1, 2)).T
        states = (zeros << np.uint16(8) | ones).astype("<u2").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([states], pa.binary())], names=["part", "states"])

    # Tasks as many as keep all cores busy for some turns: their tables are what is shuffled.
    tasks = max(1, 8 * context.defaultParallelism)
    sums = training.select("text").coalesce(tasks).mapInArrow(gathered, "part int, width int, sums binary")
    dealt = sums.repartition(max(1, min(_CONTEXTS * parts, 4 * context.defaultParallelism)), "part").sortWithinPartitions("part")
    found = materialize(dealt.mapInArrow(folded, "part int, states binary"), "states")
    states = {r["part"]: bytes(r["states"]) for r in found.toLocalIterator()}
    empty = bytes(2 * ((1 << bits) // parts))
    return b"".join(states.get(i, empty) for i in range(_CONTEXTS * parts))


def _first_mixer(training: DataFrame, model: Broadcast, rows: int | None) -> Mixer:
    """Weights fitted to the decisions of all training texts, or of so many in an order given by a hash.

    A task sends its counts by cell, of which there are some 300,000 at most, and so does the sum of all.
    """
    if rows == 0:
        return Mixer.new()
    if rows is not None:
        training = training.orderBy(F.xxhash64("key", "text")).limit(rows)
    size = len(_grades()[1]) ** _CONTEXTS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(4 * size, dtype=np.int64)
        for texts in batches:
            for _, some in _texts(texts.column(0)):
                for cells in model.value.graded(some):
                    counts += np.bincount(cells, minlength=len(counts))
        cells = np.flatnonzero(counts)
        columns = [pa.array(cells.astype(np.int32)), pa.array(counts[cells])]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "n"])

    tasks = max(1, 8 * training.sparkSession.sparkContext.defaultParallelism)
    found = training.select("text").coalesce(tasks).mapInArrow(counted, "cell int, n long")
    sums = found.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(4 * size, dtype=np.int64)
    counts[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    return Mixer.fitted(counts.reshape(2, 2, size))


def score(
    docs: DataFrame, training: Column, shape: Shape | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Scores of every row: the key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    A model is learnt from the rows where `training` is true. Tokens are the text's words, lowered in A-Z, and one end.
    base_score is the log10 probability of the tokens under their counts with 0.1 added, score that of the mixed model;
    bits_per_byte divides the latter's bits by the length of the words joined by spaces (null for a text without words).

    Null texts are empty: the end alone. Every row counts, also if its key or text repeats or its key is null. Without
    training rows nothing is known, every decision costs about a bit, and base_score is 0. An empty table gives no rows.

    The driver holds the lexicon and the states of the slots, whose sizes `shape` bounds. Counts of all other words are
    joined to the rows' rare words by a shuffle.
    """
    shape = shape or Shape()
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    learnt = rows.where("training")
    counts = _word_counts(learnt)
    ends = learnt.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("distinct")).first()
    top = counts.where(F.col("n") >= shape.least).orderBy(F.desc("n"), "word").limit(shape.lexicon).toArrow()
    words, numbers = top.column("word").to_pylist(), top.column("n").to_pylist()
    lexicon = Lexicon(words, numbers, ends, total["n"] - sum(numbers))
    shared = spark.sparkContext.broadcast(Model(lexicon, _states(learnt, lexicon, shape.bits), shape.bits))
    first_mixer = _first_mixer(learnt, shared, shape.tuned_rows)
    bytes_log = np.log10(2)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known_base = TaskContext.get().partitionId() << 36, shared.value.lexicon.base
        shared.value.mixer = first_mixer
        for batch in batches:
            for first, some in _texts(batch.column("text")):
                reading, bits = shared.value.score(some)
                common = reading.words < shared.value.lexicon.rare
                known = common & ((reading.words != shared.value.lexicon.end) | (ends > 0))
                base = np.bincount(reading.doc[known], known_base[reading.words[known]], minlength=len(some))
                found = reading.doc[~common] * max(1, len(reading.rare)) + reading.words[~common] - shared.value.lexicon.rare
                pairs, n = np.unique(found, return_counts=True)
                of, rare = np.divmod(pairs, max(1, len(reading.rare)))
                listed = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of, np.arange(len(some) + 1)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(reading.rare, pa.binary()).take(pa.array(rare)), pa.array(n, pa.int64())], names=["word", "n"]
                    ),
                )
                size = reading.bytes.astype(float)
                per_byte = np.divide(-bits, size, out=np.full(len(some), np.nan), where=size > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number + np.arange(len(some))),
                        batch.column("key").slice(first, len(some)),
                        batch.column("training").slice(first, len(some)),
                        pa.array(reading.sizes),
                        pa.array(np.bincount(reading.doc[known], minlength=len(some))),
                        pa.array(base.astype(float)),
                        pa.array(bits * bytes_log),
                        pa.array(per_byte, from_pandas=True),
                        listed,
                    ],
                    names=["row", "key", "training", "tokens", "known", "base", "score", "bits_per_byte", "rare"],
                )
                number += len(some)

    schema = (
        f"row long, key {rows.schema['key'].dataType.simpleString()}, training boolean, tokens long, known long, base double, "
        "score double, bits_per_byte double, rare array<struct<word:binary,n:long>>"
    )
    found = materialize(rows.mapInArrow(scored, schema), "scored")
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    # Words outside the lexicon are rare in the corpus, so no word gathers many rows.
    known = rare.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 0.1)).alias("more_base")
    )
    n_known = F.col("known") + F.coalesce("more", F.lit(0))
    distinct = total["distinct"] + (1 if ends else 0)
    all_tokens = total["n"] + ends
    least = F.lit(float(np.log10(all_tokens + 0.1 * (distinct + 1))))
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) - (F.col("tokens") - n_known) - F.col("tokens") * least
    return found.join(known, "row", "left").select(
        F.col("key").alias(key),
        (~F.col("training")).alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        n_known.alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        "bits_per_byte",
    )
