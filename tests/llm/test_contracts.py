"""The registered queries on odd tables, and the cases that a document's contract names: groups, repeated ids, null scopes, languages."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridlake.llm.kd_shards import kd_shards
from gridlake.llm.minhash_dedup import near_duplicates
from gridlake.llm.ppm_language import LANGUAGE_BLOCK, predict, train
from gridlake.llm.queries import QUERIES, quoted_messages
from gridlake.llm.quote_threads import threads

LONG = " ".join(f"word{i % 977} and{i % 13}." for i in range(9_000))
DOCUMENTS = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t ", "en", "a", 4), (4, LONG, "en", "a", 1), (5, LONG, "en", "b", 1), (None, LONG, "en", "b", 1),
    (6, "The cat sat on the mat, as it did on most days.", "en", "a", 1), (6, "The cat sat on the mat, as it did on most days.", "en", "a", 1),
    (6, "Quite another text under the same number of a document.", "en", "a", 1), (7, "Die Katze saß auf der Matte.", "de", "c", 1), (None, None, None, None, None),
]
TABLES = {
    "documents": ("doc_id long, text string, lang string, source string, n_chars long, kept string, n_tokens string, shard string", [(*r, "x", "y", "z") for r in DOCUMENTS]),
    "benchmark": ("item_id long, text string", [(1, "Some words of an item that no document has at all."), (None, None), (2, "")]),
    "pages": ("page_id long, url string, html string, id string", [(1, "http://a", "<p>x</p>", "k"), (2, None, None, None), (None, "http://b", "<p>x</p>", "k"), (3, "http://c", "<p>x</p>", "k")]),
    "conversations": (
        "conv_id long, turn long, role string, text string, parent string",
        [(1, 0, "user", "How do I open the file?", "p"), (1, 1, "assistant", "With the open call.", "p"), (None, 0, "user", "Lost message.", "p"),
         (None, 1, "user", "Another lost one.", None), (2, None, "user", "no turn", "p"), (2, 0, None, None, "p"), (1, 1, "assistant", "With the open call.", "p")],
    ),
    "embeddings": ("vec_id long, embedding array<float>, label int", [(1, [0.1, 0.5, 0.25], 1), (2, None, None), (None, [0.2, 0.1, 0.0], 1), (3, [float("nan"), 0.0, 1.0], 0), (4, [0.9, 0.0, 0.3], 0)]),
}


@pytest.fixture(scope="module")
def odd_dir(spark):
    from gridlake.session import scratch_path

    root = scratch_path(spark, "odd")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{root}/empty/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_odd_and_empty_tables(spark, odd_dir, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    per_document = {"op3_minhash_dedup", "op4_kd_shards", "op5_ppm_language", "op7_line_quality", "op9_token_counts"}
    if name in per_document:
        assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in DOCUMENTS)
    assert QUERIES[name](spark, f"{odd_dir}/empty").collect() == []


def test_one_id_with_two_texts(spark):
    text = lambda seed: " ".join(f"w{random.Random(seed * 1000 + i).randrange(500)}" for i in range(60))
    a, b = text(1), text(2)
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (7, b), (8, ""), (8, a)], "doc_id long, text string")
    rows = near_duplicates(df, width=4)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in rows.collect())
    # one of its texts stands for document 5: it joins 1 or 7, with both rows alike
    assert sum(got.values()) == 6 and got[1, 1, True] == 1 and got[8, 1, False] == 2
    own = {k for k in got if k[0] == 5}
    assert own == {(5, 1, False)} and got[7, 7, True] == 1 or own == {(5, 5, True)} and got[7, 5, False] == 1


def test_large_classes_and_buckets(spark):
    """Groups above the size from which keys count as large, against equality and pairwise similarity."""
    r = random.Random(4)
    base = [f"w{r.randrange(400)}" for _ in range(80)]
    near = []
    for _ in range(400):
        x = list(base)
        x[r.randrange(80)] = f"z{r.randrange(10**6)}"
        near.append(" ".join(x))
    texts = [" ".join(base)] * 700 + near + [" ".join(f"u{r.randrange(10**6)}" for _ in range(30)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    rows = {x.doc_id: x for x in near_duplicates(df, width=4).collect()}
    assert len(rows) == len(texts) and all(rows[i].component_id == 0 for i in range(1100))
    assert all(rows[i].component_id == i and rows[i].kept for i in range(1100, 1400))


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())


def test_links_of_more_documents(spark):
    """All links of sf0.01 by brute force over pairs that share a shingle."""
    sf = "/root/testdata/sf0.01"
    sets = {r.doc_id: shingles(r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    at = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            at[x].append(d)
    pairs = {(a, b) for own in at.values() for a in own for b in own if a < b}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_minhash_dedup"](spark, sf).collect()}
    assert got == {d: (len(s), find(d)) for d, s in sets.items()}


def test_groups_stay_whole(spark):
    r = random.Random(5)
    texts = [f"group {g} " + "x" * 500 for g in range(7) for _ in range(100)]
    texts += ["".join(r.choices("abcdef \n", k=r.randrange(20, 600))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    rows = kd_shards(df, shards=8).collect()
    where, size = defaultdict(set), Counter()
    for x in rows:
        where[texts[x.doc_id]].add(x.shard)
        size[x.shard] += x.size
    assert all(len(s) == 1 for s in where.values()) and sorted(size) == list(range(8))
    # a cut moves by half of the group that it falls in, at most
    largest = max(n * (len(t) + 1) for t, n in Counter(texts).items())
    assert all(abs(n - sum(size.values()) / 8) <= 1.5 * largest for n in size.values())


def test_a_group_larger_than_a_shard_is_divided(spark):
    texts = ["the same text " * 10] * 600 + [f"text {i}" * 10 for i in range(300)]
    rows = kd_shards(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=8).collect()
    size = Counter()
    for x in rows:
        size[x.shard] += x.size
    assert max(size.values()) <= 1.5 * sum(size.values()) / 8


ALPHABETS = ["abcdef", "ghijkl", "mnopqr", "stuvwx"]


def test_more_languages_than_a_block(spark):
    n = LANGUAGE_BLOCK * 2 + 5
    r = random.Random(6)
    syllables = [[a + b for a in "bcdfghklmnprst" for b in "aeiou"][i::n] or ["xq"] for i in range(n)]
    words = [[f"{x}{y}{chr(97 + i % 26)}" for x in s for y in s] for i, s in enumerate(syllables)]
    text = lambda i: " ".join(r.choices(words[i], k=40))
    rows = [(k * n + i, f"l{i:03}", text(i)) for k in range(6) for i in range(n)]
    model = train(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert len(model["langs"]) == n
    test = spark.createDataFrame([(i, f"l{i:03}", text(i)) for i in range(n)] + [(n, None, "12 34"), (n + 1, None, None)], "doc_id long, lang string, text string")
    out = {x.doc_id: x for x in predict(test, model).collect()}
    assert sum(out[i].lang_pred == f"l{i:03}" for i in range(n)) >= 0.95 * n
    assert out[n].lang_pred == out[n + 1].lang_pred == "und" and all(0 < out[i].score <= 1 for i in range(n))


def test_null_ids_lose_no_language(spark):
    r = random.Random(7)
    rows = [(None, "en", " ".join(r.choices(["the", "house", "is", "red", "and", "old"], k=12))) for _ in range(3000)]
    rows += [(i, "de", " ".join(r.choices(["das", "haus", "ist", "rot", "und", "alt"], k=12))) for i in range(200)]
    rows += [(None, "fr", "la maison est rouge")] * 1500
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = train(df, max_rows=100)
    out = predict(df, model).groupBy("lang", "lang_pred").count().collect()
    assert {(x.lang, x.lang_pred) for x in out} == {("en", "en"), ("de", "de"), ("fr", "fr")}


def test_null_and_text_scopes(spark):
    first, second = "How do I open the file in this program?", "> How do I open the file in this program?\nWith the open call of the library."
    rows = [(None, 0, first), (None, 1, second), ("", 0, first), ("x", 0, second), ("x", 1, "own words")]
    out = {(r.scope, r.id): r.parent for r in threads(spark.createDataFrame(rows, "c string, i long, t string"), "i", "t", "c").collect()}
    assert out == {(None, 0): None, (None, 1): 0, ("", 0): None, ("x", 0): None, ("x", 1): None}


def test_quoted_turns_of_null_conversations(spark):
    df = spark.createDataFrame(TABLES["conversations"][1], TABLES["conversations"][0])
    got = {(r.conv_id, r.turn): r.body for r in quoted_messages(df).collect()}
    assert got[None, 1] == "> Lost message.\nAnother lost one." and got[2, None] == "no turn" and got[1, 1].startswith("> How")
    assert quoted_messages(df.filter(F.lit(False))).count() == 0


@pytest.mark.parametrize("name", ["op4_kd_shards", "op6_license_dice", "op7_line_quality"])
def test_native_plans_have_no_python(spark, capsys, name):
    QUERIES[name](spark, "/root/testdata/sf0.001").explain(mode="formatted")
    text = capsys.readouterr().out
    assert "Scan" in text and not [x for x in ("Python", "MapInArrow", "InPandas", "InArrow", "ArrowEval") if x in text]
