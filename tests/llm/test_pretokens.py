"""Pre-tokens cut on arrays and ids from the table of short ones, against the pattern and the library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex

from gridlake.llm import pretoken
from gridlake.llm.pretoken import IdEncoder, _ShortIds, char_classes, default_tokenizer, pretoken_begins

_BITS = ["a", "B", "s", "t", "re", "ve", "m", "ll", "d", "'", "'", " ", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", "1", "٣", "½", ",", ".", "<", "é", "日本", "😀", "́", "’", "\0", "Ⅷ"]


def test_cuts_are_the_patterns():
    kinds, rng = char_classes(), random.Random(1)
    words = regex.compile(public_tokenizers.PATTERN).findall
    for _ in range(5000):
        texts = [x for x in ("".join(rng.choices(_BITS, k=rng.randint(0, 9))) for _ in range(rng.randint(1, 4))) if x]
        if not texts:
            continue
        text = "".join(texts)
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        at = pretoken_begins(code, kinds[code], np.cumsum([0, *map(len, texts)])[:-1]).tolist()
        assert [text[a:b] for a, b in zip(at, [*at[1:], len(text)])] == [w for x in texts for w in words(x)], texts


@pytest.mark.parametrize("name, value", [("SLOTS", 64), ("_CUT_CHARS", 20), ("MAX_REMEMBERED", 10)])
def test_ids_are_the_librarys_within_small_bounds(monkeypatch, name, value):
    monkeypatch.setattr(pretoken, name, value)
    enc, rng = IdEncoder(default_tokenizer()), random.Random(2)
    bits = [*_BITS, "word", " word", "<|endoftext|>", "<|endof", "longwordoverfifteenbytes" * 9, *(f" w{i}x" for i in range(50))]
    for _ in range(100):
        texts = ["".join(rng.choices(bits, k=rng.randint(0, 80))) for _ in range(rng.randint(0, 5))]
        assert enc.encode(texts) == [np.array(enc.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_known_short_pretokens_take_no_step_of_their_own(monkeypatch):
    enc = IdEncoder(default_tokenizer())
    texts = ["the thing's own words, 12 of them\n", "and the others"]
    first = enc.encode(texts)
    monkeypatch.setattr(enc, "known", type("Asked", (), {"rotate": lambda self: None})())
    assert enc.encode(texts * 3) == first * 3


def test_a_full_table_keeps_what_was_asked_again():
    table = _ShortIds(16)
    key = lambda a, b: (np.arange(a, b, dtype=np.uint64), np.full(b - a, 1 << 56, np.uint64))
    table.add(*key(0, 8), [bytes([i, 0, 0, 0]) for i in range(8)])
    assert (table.find(*key(0, 2)) >= 0).all()
    table.add(*key(8, 10), [b"\x08\0\0\0", b"\x09\0\0\0"])
    found = table.find(*key(0, 10))
    assert (found >= 0).tolist() == [True] * 2 + [False] * 6 + [True] * 2
    assert table.pool[found[found >= 0] >> 4].tolist() == [0, 1, 8, 9]
    table.add(*key(100, 120), [bytes([i, 0, 0, 0, i, 0, 0, 0]) for i in range(20)])  # more than it has slots
    found = table.find(*key(100, 120))
    assert (found & 15).tolist() == [2] * 20 and table.pool[(found >> 4) + 1].tolist() == list(range(20))
