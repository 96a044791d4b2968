"""Recall of the benchmark search against brute force on planted items."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import semantic_decontam
from gridlake.llm.semantic_decontam import (
    ANSWER_SHARE,
    COPY_SHARE,
    FEATURES,
    PARAPHRASE_SHARE,
    PASSAGE_WORDS,
    _feature,
    _gram_batches,
    _prepare,
    _search,
    _words,
    contaminated,
    lcs_length,
)
from tests.conftest import SF_SMALL


def _planted(items, share, n, tail, seed):
    """Documents that hold an item with ``share`` of the words before its last fifth kept: (item number, text)."""
    r = random.Random(seed)
    other = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru") for b in ("ten", "var", "sol", "dim", "pek") for c in ("a", "or", "is", "um")]
    out = []
    for _ in range(n):
        i = r.randrange(len(items))
        x = items[i].split()
        body = len(x) - max(4, len(x) // 5)
        for j in r.sample(range(body), min(body, round(len(x) * (1 - share)))):
            x[j] = r.choice(other)
        around = [[r.choice(other) for _ in range(r.randrange(40, 90))] for _ in range(2)]
        out.append((i, " ".join(around[0] + x + ([] if tail else around[1]))))
    return out


@pytest.fixture(scope="module")
def passages_benchmark(spark):
    return [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").collect()]


def _recall(spark, items, cases):
    docs = spark.createDataFrame([(k, x) for k, (_, x) in enumerate(cases)], "doc_id long, text string")
    docs = docs.unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text"))
    got = {(r.id, r.item) for r in contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    return sum((k, i) in got for k, (i, _) in enumerate(cases)) / len(cases)


def _accepted(items, cases):
    """The cases that the rule on words takes, by brute force over the whole document."""
    keep = []
    for i, text in cases:
        x, y = items[i].lower().split(), text.lower().split()
        clean = lambda w: [v for v in (re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", u) for u in w) for v in v.split()]
        x, y = clean(x), clean(y)
        common, answer = lcs_length(x, y), x[-max(4, len(x) // 5) :]
        if common >= COPY_SHARE * len(x) or (common >= PARAPHRASE_SHARE * len(x) and lcs_length(answer, y) >= ANSWER_SHARE * len(answer)):
            keep.append((i, text))
    return keep


def test_paraphrases_are_found_at_each_share_of_kept_words(spark, passages_benchmark):
    for share in (0.9, 0.8, 0.7, 0.62):
        cases = _accepted(passages_benchmark, _planted(passages_benchmark, share, 200, False, 11))
        assert len(cases) > 100 and _recall(spark, passages_benchmark, cases) >= 0.9


def test_items_at_the_end_of_a_text(spark, passages_benchmark):
    # each document is a block of its own, as a text of over 512 KB is
    items, rows = passages_benchmark, []
    it = _items_prepared(items)
    for i, text in _planted(items, 1.0, 300, True, 12):
        raw = text.encode()
        w, first = _words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        rows.append(any(x[1] == i for x in _search(it, w, first)))
    assert all(rows)


def test_windows_do_not_depend_on_the_neighbours(passages_benchmark):
    it = _items_prepared(passages_benchmark)
    cases = [x for _, x in _planted(passages_benchmark, 0.75, 60, True, 13)]

    def found(texts):
        raw = [t.encode() for t in texts]
        w, first = _words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
        return {(texts[x[0]], x[1]) for x in _search(it, w, first)}

    assert found(cases) == set().union(*(found([x]) for x in cases))


def _items_prepared(items):
    rng = np.random.default_rng(3)
    fold = rng.standard_normal((FEATURES, 64)).astype(np.float32)
    return _prepare(list(range(len(items))), items, fold, np.ones(FEATURES))


def test_decomposition_sums_over_all_passages(spark):
    # dense reference of A'(A Q): more documents than any sample, and their order must not matter
    r = random.Random(4)
    texts = [" ".join(f"w{r.randrange(300)}" for _ in range(r.randrange(1, 80))) for _ in range(2600)]
    idf, q = np.linspace(0.5, 2, FEATURES), np.random.default_rng(1).standard_normal((FEATURES, 5)).astype(np.float32)

    class Sent:
        def __init__(self, value):
            self.value = value

    parts = list(_gram_batches(Sent(q), Sent(idf))(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
    got = np.concatenate([np.frombuffer(x, np.float32).reshape(-1, 5) for x in parts[0].column("part").to_pylist()])
    want = np.zeros((FEATURES, 5))
    for t in texts:
        raw = t.encode()
        f = _feature(_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
        for k in range(0, len(f), PASSAGE_WORDS):
            feature, n = np.unique(f[k : k + PASSAGE_WORDS], return_counts=True)
            x = n * idf[feature]
            x /= np.linalg.norm(x)
            want[feature] += x[:, None] * (x @ q[feature])
    assert np.allclose(got, want, rtol=1e-3, atol=1e-3)


def test_words_outside_any_sample_have_latent_directions(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(semantic_decontam, "_latent", lambda passages, idf, rank: seen.append(passages.count()) or np.zeros((FEATURES, rank), np.float32))
    docs = spark.range(5000).selectExpr("id doc_id", "concat('some words of document ', id) text")
    items = spark.range(2500).selectExpr("id item_id", "concat('an item of the benchmark number ', id) text")
    contaminated(docs, items)
    assert seen == [7500]


def test_recall_with_a_benchmark_of_more_than_one_block(spark):
    r = random.Random(8)
    items = [" ".join(f"{r.choice('bdfgklmnprst')}{r.choice('aeiou')}{r.choice('bdfgklmnprst')}{r.choice('aeiou')}{r.randrange(9)}" for _ in range(30)) for _ in range(2100)]
    for share in (0.9, 0.7):
        cases = _accepted(items, _planted(items, share, 200, False, 9))
        assert len(cases) > 100 and _recall(spark, items, cases) >= 0.9
