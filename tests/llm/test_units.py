"""Parts of the operators against their definitions."""

from __future__ import annotations

import bisect
import io
import math
import random
import sys
import zipfile

import numpy as np
import pyarrow as pa
import pytest

from gridlake.llm import common, token_transducer
from gridlake.llm.best_fit_pack import best_fit_runs
from gridlake.llm.license_dice import scan
from gridlake.llm.minhash_dedup import BINS, _sketch_batches, near_duplicates, sketch
from gridlake.llm.ppm_language import _count_batches, _Tables
from gridlake.llm.pretoken import IdEncoder, default_tokenizer
from gridlake.llm.quote_threads import own_text, passages, quote_level, threads
from gridlake.llm.semantic_decontam import lcs_length
from gridlake.llm.shingles import shingle_sets
from gridlake.llm.token_transducer import Counter, Transducer
from gridlake.llm.zip_warc import PackageWriter, parse_record, read_at, stored_members, _record

ODD = [chr(i) for i in (0x85, 0xA0, 0x2028, 0x200B, 0x3000, 0x1C, 0xFEFF, 0x301, 0x660, 0xB2, 0x1F600, 0x4E2D, 0, 0xAD)]
ODD += list(" \n\t\r'stredlm09aZ.,!#_<|>") + ["<|endoftext|>", "'ll", "  "]


def odd_texts(n: int, length: int, seed: int = 3) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, length))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def test_ids_equal_the_library(library):
    texts = odd_texts(3000, 25)
    got = IdEncoder(default_tokenizer()).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_transducer_and_composed_maps(library):
    c = Counter(default_tokenizer())
    for i, text in enumerate(odd_texts(150, 300)):
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert c.count(text) == n
        step = 1 + i % 40
        maps = [c.state_map(text[k : k + step]) for k in range(0, len(text), step)] or [c.state_map("")]
        while len(maps) > 1:  # any bracketing gives the same
            k = (i * 7 + len(maps)) % (len(maps) - 1)
            maps[k : k + 2] = [c.compose(maps[k], maps[k + 1])]
        assert c.total(maps[0]) == n


def test_transducer_of_any_merges():
    r = random.Random(8)
    for turn in range(60):
        merges, known = [], [b"a", b"b", b"c"]
        for _ in range(r.randint(1, 25)):
            pair = (r.choice(known), r.choice(known))
            fresh = pair[0] + pair[1] not in known
            if pair not in merges and len(pair[0] + pair[1]) < 9 and (fresh or turn % 2):  # in every other turn some tokens have two merges
                merges.append(pair)
                known.append(pair[0] + pair[1])
        t = Transducer(merges, {bytes((i,)) for i in range(256)} | set(known))
        for _ in range(80):
            data = bytes(r.choice(b"abc") for _ in range(r.randint(0, 20)))
            assert t.count(data) == len(t.encode(data))


def test_counting_new_words_is_cheap(monkeypatch):
    """Two tokens are compared by their merges, not by encoding them; frequent pre-tokens are counted once, whatever number of rare ones comes between."""
    monkeypatch.setattr(token_transducer, "MAX_WORDS", 400)
    c = Counter(default_tokenizer())
    encoded, counted = [], []
    encode, count = c.transducer.encode, c.transducer.count
    c.transducer.encode = lambda data: encoded.append(data) or encode(data)
    c.transducer.count = lambda data: counted.append(data) or count(data)
    r = random.Random(4)
    rare = ["".join(r.choice("etaoinshrdlu") for _ in range(9)) for _ in range(3000)]
    assert sum(c.count(f" common {x}") for x in rare) == sum(1 + len(encode(f" {x}".encode())) for x in rare)
    assert counted.count(b" common") == 1
    assert len(encoded) == len(set(encoded)) and all(x in c.transducer.numbers for x in encoded)
    assert len(c.known) + len(c.known.old) <= 402


def test_a_task_drops_what_other_operators_left(monkeypatch):
    """An operator's tasks free the worker's caches of the operators before it, and end by returning its freed pages."""
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(len(calls)))
    monkeypatch.setitem(sys.__dict__, "_gridlake_llm_cache", {"ids": {"large": 1}})
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b c d e f", None])], names=["id", "text"])
    out = list(common.lean(_sketch_batches(5), "sets")([batch]))
    assert [x.column(1).to_pylist() for x in out] == [[2, 0]]
    assert list(sys.__dict__["_gridlake_llm_cache"]) == ["sets"]
    assert len(calls) == 2


def test_sets_and_sketches_come_in_small_batches(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    got = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1)}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 250


def test_runs_are_best_fit_decreasing():
    r = random.Random(5)
    for window in (7, 64, 100):
        lengths = [r.randint(1, window) for _ in range(r.randint(0, 300))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        runs = sorted(best_fit_runs(counts, window))
        used: dict[int, list[tuple[int, int]]] = {}
        for n, k in counts.items():
            own = [x for x in runs if x[0] == n]
            for j in range(k):
                _, lo, per, first, offset = max(x for x in own if x[1] <= j)
                used.setdefault(first + (j - lo) // per, []).append((offset + (j - lo) % per * n, n))
        for pieces in used.values():
            at = 0
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            assert at <= window
        rooms: list[int] = []
        for n in sorted(lengths, reverse=True):
            i = bisect.bisect_left(rooms, n)
            room = rooms.pop(i) if i < len(rooms) else window
            bisect.insort(rooms, room - n)
        assert len(used) == len(rooms) and sorted(window - sum(n for _, n in p) for p in used.values()) == rooms


def test_sketch_fills_every_bin_and_estimates():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate((a[:320], r.integers(0, 2**63, 80, dtype=np.uint64)))
    one = r.integers(0, 2**63, 1, dtype=np.uint64)
    rows = sketch(np.concatenate((a, b, one)), np.array([0, 400, 800, 801]))
    assert (rows != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and rows.shape == (3, BINS)
    assert abs((rows[0] == rows[1]).mean() - 320 / 480) < 0.1


def test_shingles_of_short_and_cased_texts():
    texts = ["", " \n", "One two", "one\tTWO", "a b c d", "a b c d e", "a b c d a b c d"]
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    elems, first = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offs, 4)
    sets = [set(elems[first[i] : first[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [0, 0, 1, 1, 1, 2, 4]
    assert sets[2] == sets[3] and sets[4] < sets[5] and sets[4] < sets[6]


def test_code_lengths_are_exact():
    import pyarrow as pa

    train = [("x", "abab abba ab"), ("y", "éàé bcb éà"), ("y", "")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in train]), pa.array([r[1] for r in train])], names=["lang", "text"])
    total: dict[tuple[str, int], int] = {}
    for out in _count_batches(3)([batch]):
        for lang, gram, n in zip(*(c.to_pylist() for c in out.columns)):
            total[lang, gram] = total.get((lang, gram), 0) + n
    grams = np.unique([g for _, g in total])
    counts = np.array([[total.get((lang, int(g)), 0) for lang in ("x", "y")] for g in grams], np.int32)
    texts = ["", "ab", "abba éà zz", "\x00q日本"]
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    for pairs in (2, 50):
        tables = _Tables({"langs": ["x", "y"], "grams": grams, "counts": counts}, pairs)
        got = tables.lengths(np.frombuffer(b"".join(raw), np.uint8), offs)
        assert got.tolist() == [[_code_length(total, lang, x) for lang in ("x", "y")] for x in raw]


def _code_length(total, lang, text):
    seen: dict[bytes, dict[bytes, int]] = {}
    for (own, gram), n in total.items():
        if own == lang:
            k = gram >> 40
            data = (gram & ((1 << 40) - 1)).to_bytes(k, "big")
            seen.setdefault(data[:-1], {})[data[-1:]] = n
    out, padded = 0, b"\0\0\0" + text
    for p in range(3, len(padded)):
        bits, found = 0.0, False
        for order in (3, 2, 1, 0):
            follow = seen.get(padded[p - order : p])
            if follow:
                n, d = sum(follow.values()), len(follow)
                c = follow.get(padded[p : p + 1], 0)
                bits -= math.log2((c or d) / (n + d))
                if c:
                    found = True
                    break
        out += round((bits if found else bits + 8) * 256)
    return out


def test_lcs():
    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert lcs_length(a, b) == table[-1][-1]


def test_package_is_a_zip_and_reads_by_range():
    class Kept(io.BytesIO):
        def close(self):
            self.kept = self.getvalue()

    out = Kept()
    w = PackageWriter(out)
    payloads = [b"", b"<html>\r\n\r\n</html>", bytes(range(256))]
    for i, p in enumerate(payloads):
        import base64
        import hashlib

        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        w.add(_record(str(i), f"u{i}", "response", "", digest, p), str(i), f"u{i}")
    w.close()
    z = zipfile.ZipFile(io.BytesIO(out.kept))
    assert z.testzip() is None and z.namelist() == ["archive/data.warc", "indexes/index.cdx"]
    for tail in (b"",):
        f = io.BytesIO(out.kept + tail)
        members = stored_members(f, len(out.kept) + len(tail))
        index = read_at(f, *members["indexes/index.cdx"]).decode().split("\n")[:-1]
        for line, p in zip(index, payloads):
            _, offset, length, _ = line.split(" ")
            got = parse_record(read_at(f, members["archive/data.warc"][0] + int(offset), int(length)))
            assert got[4] == len(p) and got[6] == p
    with pytest.raises(ValueError, match="end record"):
        stored_members(io.BytesIO(b"x" * 100), 100)
    plain = io.BytesIO()  # a package of another writer, with 32-bit fields and a comment
    with zipfile.ZipFile(plain, "w") as other:
        other.writestr("a.txt", b"hello")
        other.comment = b"PK\x05\x06 in a comment"
    size = len(plain.getvalue())
    members = stored_members(plain, size)
    assert read_at(plain, *members["a.txt"]) == b"hello"


def test_quotes():
    assert quote_level("> > hi") == (2, "hi") and quote_level(" >>x") == (2, "x") and quote_level("a > b") == (0, "a > b")
    text = ">> Oldest line here now\n> Answer to it\n\nMy own text\n> quoted again\nEnd"
    assert own_text(text) == "My own text\nEnd"
    assert (2, "oldest line here now") in passages(text) and (1, "quoted again") in passages(text) and (0, "end") in passages(text)


def test_threads_branch_and_share_a_common_line(spark):
    rows = [
        (1, "Hello all, this is the first message\nThanks"),
        (2, "> Hello all, this is the first message\nI answer the first one here\nThanks"),
        (3, "> Hello all, this is the first message\nAnother answer to the first one\nThanks"),
        (4, ">> Hello all, this is the first message\n> Another answer to the first one\n> Thanks\nDeep answer"),
        (5, "> never written by anyone\nAn own topic with no parent"),
        (6, None),
    ]
    out = {r.id: (r.parent, r.root, r.depth, r.position) for r in threads(spark.createDataFrame(rows, "m long, body string"), "m", "body").collect()}
    assert out == {1: (None, 1, 0, 0), 2: (1, 1, 1, 1), 3: (1, 1, 1, 2), 4: (3, 1, 2, 3), 5: (None, 5, 0, 0), 6: (None, 6, 0, 0)}


def test_threads_tell_repeated_turns_apart(spark):
    rows = [
        (1, "Shall we meet on Monday?"),
        (2, "> Shall we meet on Monday?\nThanks."),
        (3, ">> Shall we meet on Monday?\n> Thanks.\nAnd what about Friday?"),
        (4, ">> Thanks.\n> And what about Friday?\nThanks."),
        (5, ">> And what about Friday?\n> Thanks.\nSee you on Friday then."),
        (6, ">> Shall we meet on Monday?\n> Thanks.\nMonday is fine for me too."),
        (7, "> Thanks.\nWhich of the two answers?"),
        (8, ">> And what about Friday?\nOnly the deeper quote is left here."),
        (9, ">>> Shall we meet on Monday?\nNobody keeps it at the second level but these."),
        (10, "A line of one author."),
        (11, ">> A line of one author.\nThe message between is lost."),
    ]
    out = {r.id: r.parent for r in threads(spark.createDataFrame(rows, "m long, body string"), "m", "body").collect()}
    assert out == {1: None, 2: 1, 3: 2, 4: 3, 5: 4, 6: 2, 7: 4, 8: 4, 9: 6, 10: None, 11: 10}


def test_a_common_turn_links_to_the_latest_earlier_one(spark):
    rows = [(i, "The same words in every turn" if i % 2 else "> The same words in every turn\nAnswer number %d" % i) for i in range(1, 401)]
    out = {r.id: r.parent for r in threads(spark.createDataFrame(rows, "m long, body string"), "m", "body").collect()}
    assert out == {i: None if i % 2 else i - 1 for i in range(1, 401)}


def test_licences_over_lines_and_near_matches(spark):
    rows = [
        (1, "Some words.\nLicensed under the Apache\nLicense, Version 2.0.\nMore words."),
        (2, "This work is LICENSED under the GNU General Public Licence, version 3 (or so)."),
        (3, "released under the mit license"),
        (4, "We talked about a license that was not under any general terms."),
    ]
    out = {(r.id, r.license, r.line, r.n_lines) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(1, "Apache-2.0", 2, 2), (3, "MIT", 1, 1)} <= out and not [x for x in out if x[0] == 4]
