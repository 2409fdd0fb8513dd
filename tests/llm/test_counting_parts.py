"""Decisions counted some words at a time."""

import numpy as np

from tablemend.llm import lm


def test_first_weights_do_not_depend_on_the_words_counted_at_a_time(monkeypatch):
    """Whole texts one after another, and texts longer than what is counted at a time, against all at once."""
    rng = np.random.default_rng(8)
    words = [b"w%d" % i for i in range(60)]
    texts = [b" ".join(words[i] for i in rng.integers(0, 60, n)) + b" rare%d" % n for n in (0, 3, 70, 40, 1, 200)]
    lexicon = lm.Lexicon(words, [2 * i + 2 for i in range(60)][::-1], 6, 9)
    counts, bits = np.zeros((3, 2 << 12), dtype=np.int64), 12
    found = lm.Reading(lexicon, texts)
    every = found.decisions(np.arange(len(found.words)), bits)
    for k, slots in enumerate(every.slots):
        np.add.at(counts[k], lm._cells(slots, every.bit), 1)
        assert counts[k].reshape(-1, 2).sum(axis=1).tolist() == np.bincount(slots, minlength=1 << bits).tolist()
    zeros, ones = lm._levels(counts.reshape(-1, 2)).T
    model = lm.Model(lexicon, (zeros << np.uint16(8) | ones).astype("<u2").tobytes(), bits)
    want = np.concatenate(list(model.graded(texts)))
    assert len(want) == len(every.bit) and len(set(want.tolist())) > 20
    for most in (16, 64):
        monkeypatch.setattr(lm, "_COUNTING", most)
        assert (np.concatenate(list(model.graded(texts))) == want).all()


def test_own_counts_are_cut_at_nothing_and_left_beyond_the_exact_levels():
    states = np.array([5 << 8 | 3, 64 << 8 | 65, 255 << 8 | 1, 0], dtype=np.uint16)
    own = np.array([2 << 8 | 4, 70 << 8 | 9, 9 << 8 | 1, 7], dtype="<u2")
    assert lm._less(states, own).tolist() == [3 << 8, 65, 255 << 8, 0]
