"""The registered queries on a small table against plain Python versions of what they promise."""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from gridlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    keys = list(texts)
    return {k: e.ids for k, e in zip(keys, t.encode_batch([texts[k] for k in keys], add_special_tokens=False))}


def run(spark, name):
    return QUERIES[name](spark, SF_SMALL).collect()


def test_benchmark_passages(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in run(spark, "op1_semantic_decontam")}
    planted = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert planted and planted <= got
    words = lambda s: re.findall(r"[^\W_]+", s.lower())
    for d, i in got - planted:  # a near copy: most five-word runs of the item stand in the document
        a, b = words(items[i]), words(texts[d])
        runs = set(zip(*[b[k:] for k in range(5)]))
        assert sum(x in runs for x in zip(*[a[k:] for k in range(5)])) >= 0.5 * (len(a) - 4)


def test_packing(spark, texts, ids):
    rows = run(spark, "op2_best_fit_pack")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        x = (ids[r.doc_id] + [1])[r.start : r.start + r.length]
        assert len(x) == r.length and zlib.crc32(struct.pack(f"<{len(x)}I", *x)) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, own in pieces.items():
        assert _end(own) == len(ids[d]) + 1
    assert pieces.keys() == texts.keys()
    assert all(_end(own) <= 2048 for own in sequences.values())
    open_ = []  # best-fit decreasing, piece by piece
    for n in sorted((r.length for r in rows), reverse=True):
        i = bisect.bisect_left(open_, n)
        room = open_.pop(i) if i < len(open_) else 2048
        bisect.insort(open_, room - n)
    assert len(sequences) == len(open_)


def _end(own):
    at = 0
    for start, length in sorted(own):
        assert start == at
        at += length
    return at


def test_near_duplicates(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, "op3_minhash_dedup")}
    sets = {}
    for d, t in texts.items():
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        sets[d] = frozenset(zip(*[w[i:] for i in range(4)])) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert got == {d: (len(s), label[d], label[d] == d) for d, s in sets.items()}


def test_shards(spark, texts):
    rows = run(spark, "op4_kd_shards")
    size, slots, of = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        of[raw].add(r.shard)
    assert len(rows) == len(texts) and set(size) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t.encode()) for t in texts.values())
    assert max(size.values()) - min(size.values()) <= 2 * largest


def test_language(spark):
    rows = {r.doc_id: r for r in run(spark, "op5_ppm_language")}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert rows.keys() == truth.keys()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [d for d, r in rows.items() if r.held_out]
    assert sum(rows[d].lang_pred == truth[d] for d in held) >= 0.95 * len(held)


def test_quality(spark, texts):
    for r in run(spark, "op7_line_quality"):
        t = texts[r.doc_id]
        w = WORD.findall(t)
        windows = list(zip(w, w[1:], w[2:]))
        often = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        exp = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == exp
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.kept and r.base_failed)


def test_good_documents_stay(spark):
    good = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect() if r.quality == 1}
    assert not [r.doc_id for r in run(spark, "op7_line_quality") if r.doc_id in good and not r.base_failed and not r.kept]


def test_threads(spark):
    truth = {(r.conv_id, r.turn): (r.text or "").strip("\n") for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()}
    rows = run(spark, "op8_quote_threads")
    assert {(r.conv_id, r.turn): r.text for r in rows} == truth
    for r in rows:
        assert r.parent_turn == (r.turn - 1 if r.turn else None) and (r.root_turn, r.depth, r.position) == (0, r.turn, r.turn)


def test_token_counts(spark, texts, ids):
    rows = run(spark, "op9_token_counts")
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        (d, len(t.encode()), len(ids[d]), len(ids[d]) > 1024) for d, t in texts.items()
    }


def test_archives(spark):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    digest = {p: base64.b32encode(hashlib.sha1(x).digest()).decode() for p, x in pages}
    top = {digest[p]: p for p, _ in sorted(pages)}
    rows = run(spark, "op10_zip_warc")
    assert {tuple(r) for r in rows} == {
        (p, len(x), digest[p], *(("response", None) if top[digest[p]] == p else ("revisit", top[digest[p]]))) for p, x in pages
    }


def test_pipeline(spark, texts):
    """Every document leaves at the stage that rejects it, and the rest is packed whole."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    left = {r.doc_id for r in packed}
    good = {r.doc_id for r in run(spark, "op7_line_quality") if r.kept}
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, t in texts.items() if any(x in t for x in items)}
    assert left <= good and not left & leaked
    shingles = {}
    for d in sorted(good):
        w = WORD.findall(texts[d].lower())
        shingles[d] = set(zip(*[w[i:] for i in range(5)]))
    copies = {b for a in shingles for b in shingles if a < b and shingles[b] and len(shingles[a] & shingles[b]) >= 0.7 * len(shingles[a] | shingles[b])}
    # clean documents without a relative stay (a near copy of a leaked passage may go as well)
    assert len((good - leaked - copies) - left) <= 0.01 * len(texts)
    whole = defaultdict(int)
    for r in packed:
        whole[r.doc_id] += r.length
    assert all(whole[r.doc_id] == r.doc_tokens for r in packed)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "decontaminate", "packing"]
    step = docs
    for name, stage in corpus_pipeline.STAGES[:2]:
        step = stage(spark, step, SF_SMALL)
        assert step.columns == docs.columns, name
