"""Spelling variants: the recurrences and the query against plain Python, divided buckets, odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from gridlake.llm import spelling_variants as sv
from gridlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def one_error(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_by_deletion(words):
    """Near words of each word, by what is left when one letter is taken out or masked."""
    group = defaultdict(set)
    for w in words:
        group[w].add(w)
        for i in range(len(w)):
            group[w[:i] + w[i + 1 :]].add(w)
            group[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for k, own in group.items():
        for a in own:
            near[a] |= {b for b in own if b != a and one_error(a, b)}
    return near


def variants(counts, ratio=10):
    near, out = near_by_deletion(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        out[w] = best if best is not None and counts[best] >= ratio * n else None
    rows = set()
    for w, form in out.items():
        root = w
        while out[root] is not None:
            root = out[root]
        rows.add((w, form, root, counts[w], len(near[w]), counts[form] if form else None))
    return rows


def rows_of(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("letters", ["ab", "abcé", "日本x"])
def test_recurrences(letters):
    rng = random.Random(len(letters))
    for m in (1, 2, 5):
        words = sorted({"".join(rng.choices(letters, k=rng.choice([m, m + 1]))) for _ in range(150)})
        a, b = sv.near_pairs(words, m)
        got = {(words[i], words[j]) for i, j in zip(a, b)}
        assert got == {(x, y) for x in words for y in words if len(x) == m and len(y) in (m, m + 1) and one_error(x, y)}


def test_query_against_plain_python(spark):
    counts = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    want = variants({w: n for w, n in counts.items() if n >= 2})
    assert sum(x[1] is not None for x in want) > 10
    assert rows_of(QUERIES["op11_spelling_variants"](spark, SF)) == want


def test_divided_buckets_lose_nothing(spark, monkeypatch):
    """Words that share a half, in buckets of at most four."""
    monkeypatch.setattr(sv, "BLOCK", 4)
    rng = random.Random(9)
    tails = {"".join(rng.choices("abc", k=rng.choice([4, 5]))) for _ in range(120)}
    words = {"prefix" + t: rng.choice([1, 2, 15, 200]) for t in tails} | {t + "suffix": 3 for t in tails} | {"aaaaaaa" + "a" * k: 10**k for k in range(6)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = sv.bucket_rows(df)
    assert rows.groupBy("m", "a", "b", "outside").count().filter("count > 4 and b - a > 1").isEmpty()
    assert rows_of(sv.spelling_variants(df)) == variants(words)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "Straßen ÀLTERES"), (3, "STRASSEN x" * 3), (3, "strassen strassen"), (4, "a" * 20_000 + " " + "a" * 20_001), (4, "a" * 20_000 + " " + "a" * 20_001), (5, "été123straßen")]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n long")
    got = {r.word: r.n for r in sv.vocabulary(df, damage=0).collect()}
    assert got == {"strassen": 3, "xstrassen": 2, "straßen": 2, "a" * 20_000: 2, "a" * 20_001: 2}
    out = rows_of(sv.spelling_variants(sv.vocabulary(df, damage=0)))
    assert out == variants(got)
    assert sv.spelling_variants(sv.vocabulary(df.limit(0))).count() == 0
