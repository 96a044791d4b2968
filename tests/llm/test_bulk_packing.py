"""Bulk best-fit: parentheses matching, ranges that meet, ids against the library, few sequences, odd rows."""

from __future__ import annotations

import bisect
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from gridlake.llm.bulk_best_fit import WordEncoder, bulk_best_fit, match_sorted, pack_bulk, ranges_met
from gridlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def stack_match(is_gap):
    stack, pairs, free = [], set(), []
    for i, g in enumerate(is_gap):
        if not g:
            stack.append(i)
        elif stack:
            pairs.add((stack.pop(), i))
        else:
            free.append(i)
    return pairs, free, stack


@pytest.mark.parametrize("seed", range(20))
def test_match_is_a_stack(seed):
    rng = np.random.default_rng(seed)
    is_gap = rng.random(rng.integers(1, 200)) < rng.random()
    pieces, slots, free_slots, free_pieces = match_sorted(is_gap)
    pairs, free, stack = stack_match(is_gap)
    assert set(zip(pieces.tolist(), slots.tolist())) == pairs
    assert free_slots.tolist() == free and free_pieces.tolist() == stack


def test_ranges_meet_like_one_range():
    rng = random.Random(3)
    left = [(p, rng.randint(0, 5), rng.randint(0, 5)) for p in range(40)]
    got = set()
    for _, n, a, at, c, first in ranges_met(left):
        got |= {((a, at + i), (c, first + i)) for i in range(n)}
    stack, want = [], set()
    for p, slots, pieces in left:
        want |= {((p, i), stack.pop()) for i in range(slots) if stack}
        stack += [(p, i) for i in reversed(range(pieces))]
    assert got == want


def test_ids_equal_the_library(vocabulary):
    texts = ["", " \n\t", "Hello, World's 123 ½ naïve Ärger", "a<|endoftext|>b <|startoftext|>", "İstanbul ΣΑΣ ς", "é   x\u0085y\x1cz", "日本語 テスト", "don't WE'LL", " x", "—“q”…", "Привет Ё", "😀 ok", "ſtraße ẞ"]
    enc = WordEncoder(vocabulary)
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


def decreasing(lengths, window):
    """Number of sequences of best-fit decreasing, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else window
        bisect.insort(rooms, room - n)
    return len(rooms)


def held(rows, window):
    """Checks the sequences of (key, length, sequence, offset) rows; their number."""
    own = defaultdict(list)
    for _, length, seq, offset in rows:
        own[seq].append((offset, length))
    for spans in own.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return len(own)


@pytest.mark.parametrize(
    "lengths",
    [
        [random.Random(1).randint(1, 4096) for _ in range(3000)],
        [random.Random(2).randint(300, 420) for _ in range(3000)],  # ten or more to a sequence
        [1366] * 2000 + [1365] * 1000 + [1] * 500,  # one size holds most pieces
        [4096, 4096, 2048, 2048, 2049],
        [int(4096 * random.Random(i).random() ** 3) + 1 for i in range(3000)],
        [1] * 3000,
    ],
)
def test_few_sequences(spark, lengths):
    df = spark.createDataFrame(list(enumerate(lengths)), "key long, length long").repartition(5)
    got = [(r.key, lengths[r.key], r.sequence_id, r.offset) for r in bulk_best_fit(df).collect()]
    assert sorted(r[0] for r in got) == list(range(len(lengths)))
    n, best = held(got, 4096), decreasing(lengths, 4096)
    assert n <= best * 1.02 + 1


def test_query_against_the_library(spark, vocabulary):
    enc = WordEncoder(vocabulary).tokenizer
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    ids = {k: enc.encode(t, add_special_tokens=False).ids + [1] for k, t in texts.items()}
    rows = QUERIES["op12_bulk_best_fit"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.piece) for r in rows) == sorted((k, i) for k, x in ids.items() for i in range(-(-len(x) // 4096)))
    for r in rows:
        x = ids[r.doc_id][r.piece * 4096 : r.piece * 4096 + 4096]
        assert r.start == r.piece * 4096 and r.length == len(x) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(x)}I", *x))
    assert held([((r.doc_id, r.piece), r.length, r.sequence_id, r.offset) for r in rows], 4096) <= decreasing([r.length for r in rows], 4096) * 1.02 + 1


def test_odd_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (None, "word " * 9000, "k"), (3, "word " * 5000, "k"), (3, "word " * 5000, "k")]
    out = pack_bulk(spark.createDataFrame(rows, "doc_id long, text string, offset string")).collect()
    assert sorted(((r.doc_id or 0), r.piece, r.start, r.length) for r in out) == sorted(
        [(1, 0, 0, 1), (2, 0, 0, 1), (0, 0, 0, 4096), (0, 1, 4096, 4096), (0, 2, 8192, 809)] + [(3, 0, 0, 4096), (3, 1, 4096, 905)] * 2
    )
    assert held([(None, r.length, r.sequence_id, r.offset) for r in out], 4096) == 5 and all(len(r.ids) == 4 * r.length for r in out)
    assert pack_bulk(spark.createDataFrame([], "doc_id long, text string")).count() == 0
