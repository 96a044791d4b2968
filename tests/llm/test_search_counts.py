"""Running sums, word numbers and counts of rarer words of the benchmark search, against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from gridlake.llm.semantic_decontam import _known, _numbers, _rare_counts, running_sums


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 1024, 1025, 40_000])
def test_running_sums_are_numpys(n):
    rows = np.random.default_rng(n).standard_normal((n, 3)).astype(np.float32)
    assert np.array_equal(running_sums(rows), np.concatenate((np.zeros((1, 3), np.float32), np.cumsum(rows, axis=0))))


def test_words_that_share_their_low_bits_have_numbers_of_their_own():
    vocabulary = np.unique(np.array([5, 5 + (1 << 20), 5 + (1 << 25), 5 + (1 << 31), 0xFFFFFFFF, *range(100, 3000)], "<u4"))
    number = {int(x): i for i, x in enumerate(vocabulary)}
    for size in (len(vocabulary), 1):
        asked = np.array([0, 5, 6, 5 + (1 << 20), 5 + (1 << 25), 5 + (1 << 31), 5 + (1 << 22), 0xFFFFFFFF, *range(90, 3100)], "<u4")
        want = [number[int(x)] if number.get(int(x), size) < size else size for x in asked]
        assert _known(asked, _numbers(vocabulary[:size])).tolist() == want


def test_rarer_words_are_counted_inside_the_range():
    rng = random.Random(4)
    for _ in range(50):
        n_words, n_items, vocabulary = rng.randint(1, 60), rng.randint(1, 5), 6
        rare = np.array([[rng.random() < 0.5 for _ in range(n_items)] for _ in range(vocabulary)])
        words = np.array([rng.randint(0, vocabulary) for _ in range(n_words)])  # the last is no benchmark word
        word, item = np.nonzero(rare)
        places = np.flatnonzero(words < vocabulary)
        asked = np.array([rng.randrange(n_items) for _ in range(30)])
        lo = np.array([rng.randint(0, n_words) for _ in asked])
        hi = np.minimum(lo + np.array([rng.randint(0, 20) for _ in asked]), n_words)
        got = _rare_counts(np.searchsorted(word, np.arange(vocabulary + 1)), item, places, words[places], n_words, asked, lo, hi)
        assert got.tolist() == [sum(x < vocabulary and rare[x, i] for x in words[a:b]) for i, a, b in zip(asked, lo, hi)]
