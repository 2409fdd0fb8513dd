"""Toxicity scores against the noisy-or written out, and the gradient the fit descends by."""

import math
import re

import numpy as np
import pytest

from tablemend.llm import toxicity

MODEL = toxicity.Model(-2.5, {"scum": 3.0, "scu*": 0.7, "moro*": 2.0, "and": -0.3, "verylongword": 1.5})


def plain(text):
    clean = 1.0
    sentences = [s for s in re.split(r"[.!?\n]+", (text or "").lower()) if re.search(r"[^\W\d_]", s)]
    for sentence in sentences or [""]:
        z = MODEL.bias
        for word in re.findall(r"[^\W\d_]+", sentence):
            z += MODEL.weights.get(word, 0.0)
            z += sum(MODEL.weights.get(word[:k] + "*", 0.0) for k in range(3, 10) if k <= len(word))
        clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


@pytest.mark.parametrize(
    "text",
    [None, "", "...", "12 34", "Scum and scum. Fine day!", "Moron\nmorons, SCUM?\n\nAnd so", "verylongword " * 40, "a. " * 500],
)
def test_scores_are_the_noisy_or_of_sentences(text):
    assert MODEL.score(text) == pytest.approx(plain(text), rel=1e-9)


def test_fit_raises_the_likelihood_of_its_labels():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in "abcdefghij" for _ in "xy"]
    texts = [". ".join(" ".join(rng.choice(words, 6)) for _ in range(4)) for _ in range(300)]
    label = rng.random(300) < 0.2
    texts = [t + ". you scum here" if bad else t for t, bad in zip(texts, label, strict=True)]
    model = toxicity._descend(texts, label.astype(float), np.ones(300), 5, 150)
    found = np.array([model.score(t) for t in texts])
    assert found[label].min() > 0.5 > 0.2 > found[~label].max()
