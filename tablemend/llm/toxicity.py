"""Toxicity by multiple-instance learning: sentences are scored, labels belong to documents.

A sentence's score is logistic in its terms; a document is toxic when some sentence is, so its score is the noisy-or
of its sentences, 1 - prod(1 - p). The weights are fitted to document labels only, and the sentence scores then show
where the offence lies.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_END = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_LEAST_WEIGHT = 0.01


# Words whose weight a worker remembers; beyond that it starts anew.
_REMEMBERED_WORDS = 200_000
_PREFIXES = range(3, 10)
_DOCS_AT_ONCE = 250


def features(word: str) -> list[str]:
    """The word and its beginnings, so that inflected and compound forms share evidence."""
    return [word, *(word[:k] + "*" for k in _PREFIXES if k <= len(word))]


class WordWeights(dict):
    """Weight of a word, the sum over its features, worked out when it is first met."""

    def __init__(self, weights: dict[str, float]) -> None:
        self._weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= _REMEMBERED_WORDS:
            self.clear()
        total = self[word] = sum(self._weights.get(f, 0.0) for f in features(word))
        return total


@dataclass(frozen=True)
class Model:
    """Bias of a sentence and the weights of its words' features."""

    bias: float
    weights: dict[str, float]

    def odds(self, sentences: list[str], known: WordWeights | None = None) -> list[float | None]:
        """Log-odds of each sentence, or None where it has no word."""
        weight = (WordWeights(self.weights) if known is None else known).__getitem__
        split = [_WORD.findall(s) for s in sentences]
        return [self.bias + sum(map(weight, words)) if words else None for words in split]

    def score(self, text: str | None, known: WordWeights | None = None) -> float:
        """Noisy-or over the sentences; a text without any word counts as one sentence of unknown words."""
        odds = [z for z in self.odds(_END.split((text or "").lower()), known) if z is not None]
        return -math.expm1(-sum(map(_softplus, odds or [self.bias])))


def _softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows_per_class: int,
    longest: int,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """At most `rows_per_class` texts of each label, in an order given by a hash of the key.

    A key labelled both ways counts as 1. Only texts of up to `longest` code points are drawn, so the sample has a
    proven size; a key that repeats gives one text.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    once = known.groupBy(key).agg(F.max(label).cast("int").alias("label"))
    drawn = [
        once.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(rows_per_class) for value in (0, 1)
    ]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = docs.select(key, F.coalesce(text, F.lit("")).alias("text")).join(chosen, key)
    short = texts.where(F.length("text") <= longest)
    return short.groupBy(key).agg(F.first("label").alias("label"), F.min("text").alias("text"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    text: str = "text",
    key: str = "doc_id",
    rows_per_class: int = 2000,
    longest: int = 6000,
    least_documents: int = 5,
    rounds: int = 150,
) -> Model:
    """Fit sentence weights to document labels on a bounded sample.

    The sample is at most 2 * rows_per_class texts of at most `longest` code points; how often each label occurs is
    counted over all labelled rows and weighs the sample. Without labels every score is 0; with one label only, all
    scores are near it.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    per_key = known.groupBy(key).agg(F.max(label).alias("label"))
    counted = per_key.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    if not counted["n"]:
        return Model(-math.inf, {})
    sample = labelled_sample(docs, labels, label, rows_per_class, longest, text, key).orderBy(key).toPandas()
    share = counted["ones"] / counted["n"]
    drawn = sample["label"].mean() if len(sample) else 0.0
    if not 0 < share < 1 or not 0 < drawn < 1:
        near = min(max(share, 1e-6), 1 - 1e-6)
        return Model(math.log(math.expm1(-math.log1p(-near))), {})
    weight = np.where(sample["label"] == 1, share / drawn, (1 - share) / (1 - drawn))
    return _descend(sample["text"].tolist(), sample["label"].to_numpy(float), weight, least_documents, rounds)


def _descend(
    texts: list[str], label: np.ndarray, weight: np.ndarray, least: int, rounds: int, ridge: float = 1e-4
) -> Model:
    """Adam on the weighted log loss of the noisy-or."""
    number: dict[str, int] = {}
    sentence_doc, at, word = array("q"), array("q"), array("q")
    for d, text in enumerate(texts):
        for words in [w for s in _END.split(text.lower()) if (w := _WORD.findall(s))] or [[]]:
            word.extend([number.setdefault(w, len(number)) for w in words])
            at.extend([len(sentence_doc)] * len(words))
            sentence_doc.append(d)
    doc, at, word = (np.array(x, dtype=np.int64) for x in (sentence_doc, at, word))
    names: dict[str, int] = {}
    expanded = [[names.setdefault(f, len(names)) for f in features(w)] for w in number]
    of_word = np.repeat(np.arange(len(number)), [len(x) for x in expanded])
    feature = np.array([f for x in expanded for f in x], dtype=np.int64)
    kept = _frequent(doc[at], word, of_word, feature, len(names), least)
    of_word, feature = of_word[kept[feature] >= 0], kept[feature][kept[feature] >= 0]
    kept = {f: int(kept[i]) for f, i in names.items() if kept[i] >= 0}
    n_docs, n_sentences, n_words = len(texts), len(doc), len(number)
    mass = weight / weight.sum()
    w = np.zeros(len(kept) + 1)
    w[-1] = math.log(float((mass * label).sum()) * n_docs / n_sentences)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        by_word = np.bincount(of_word, w[feature], minlength=n_words)
        z = w[-1] + np.bincount(at, by_word[word], minlength=n_sentences)
        total = np.bincount(doc, np.logaddexp(0, z), minlength=n_docs)
        slope = np.where(label == 1, 1 - 1 / -np.expm1(-np.maximum(total, 1e-12)), 1.0) * mass
        by_sentence = slope[doc] * np.exp(-np.logaddexp(0, -z))
        to_word = np.bincount(word, by_sentence[at], minlength=n_words)
        gradient = np.append(np.bincount(feature, to_word[of_word], minlength=len(kept)), by_sentence.sum())
        gradient[:-1] += ridge * w[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(float(w[-1]), {f: float(w[i]) for f, i in kept.items() if abs(w[i]) >= _LEAST_WEIGHT})


def _frequent(
    doc: np.ndarray, word: np.ndarray, of_word: np.ndarray, feature: np.ndarray, n_features: int, least: int
) -> np.ndarray:
    """A new number for each feature that enough documents have, -1 for the others."""
    n_words = word.max(initial=0) + 1
    pairs = np.unique(doc * n_words + word)
    first = np.searchsorted(of_word, np.arange(n_words + 1))
    seen = np.zeros(n_features, dtype=np.int64)
    # Some documents at a time, for the sake of memory.
    edges = np.searchsorted(pairs // n_words, np.arange(0, doc.max(initial=0) + _DOCS_AT_ONCE + 1, _DOCS_AT_ONCE))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        in_doc, in_word = np.divmod(pairs[a:b], n_words)
        sizes = np.diff(first)[in_word]
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        found = feature[np.repeat(first[in_word], sizes) + steps]
        once = np.unique(np.repeat(in_doc, sizes) * n_features + found) % max(n_features, 1)
        seen += np.bincount(once, minlength=n_features)
    enough = seen >= least
    return np.where(enough, np.cumsum(enough) - 1, -1)


def score(model: Model, text: str | Column) -> Column:
    """Toxicity of a text, 0 to 1; a null or empty text has the score of a sentence without known terms."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = WordWeights(model.weights)
        for texts in batches:
            yield pd.Series([model.score(t, known) for t in texts], dtype="float64")

    return scored(text)


def offending_sentences(
    docs: DataFrame, model: Model, at_least: float = 0.3, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Sentences that reach a score: key, their place in the text in code points, score and wording."""

    @F.pandas_udf("array<struct<start:long,stop:long,score:double,sentence:string>>")
    def located(texts: pd.Series) -> pd.Series:
        return pd.Series([_located(model, t, at_least) for t in texts])

    found = docs.select(F.col(key).alias("key"), F.explode(located(text)).alias("found"))
    return found.select(F.col("key").alias(key), "found.*")


def _located(model: Model, text: str | None, at_least: float) -> list[dict]:
    text = text or ""
    ends = [m.span() for m in _END.finditer(text)]
    spans = list(zip([0, *(e for _, e in ends)], [*(s for s, _ in ends), len(text)], strict=True))
    found = []
    for (start, stop), odds in zip(spans, model.odds([text[a:b].lower() for a, b in spans]), strict=True):
        if odds is not None and (p := -math.expm1(-_softplus(odds))) >= at_least:
            found.append({"start": start, "stop": stop, "score": p, "sentence": text[start:stop]})
    return found
