"""Nulls in any column, empty and long texts, ties, repeated rows, empty tables, extra and clashing columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from gridlake.llm.best_fit_pack import pack
from gridlake.llm.kd_shards import kd_shards
from gridlake.llm.license_dice import scan
from gridlake.llm.minhash_dedup import near_duplicates
from gridlake.llm.ppm_language import held_out, predict, train
from gridlake.llm.quality_lines import clean_lines
from gridlake.llm.quote_threads import threads
from gridlake.llm.semantic_decontam import contaminated
from gridlake.llm.token_transducer import count_tokens
from gridlake.llm.zip_warc import read_packages, write_packages

LONG = " ".join(f"word{i % 977} and{i % 13}." for i in range(20_000))
ROWS = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \n\t ", "en", "a"),
    (4, LONG, "en", "a"),
    (5, LONG, "en", "b"),
    (6, "The cat sat on the mat.", "en", "a"),
    (6, "The cat sat on the mat.", "en", "a"),
    (7, "Die Katze saß auf der Matte.", "de", "c"),
    (None, "The dog sat on the mat.", "en", "a"),
    (8, "1234 5678 !!!", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns whose names clash with those that operators add.
CLASH = "doc_id long, text string, lang string, source string, kept string, n_tokens string, score string, size string, shard string, id string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clash(spark):
    return spark.createDataFrame([(*r, "k", "t", "s", "z", "h", "i") for r in ROWS], CLASH)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "Completely other words stand in this one item of the benchmark."), (2, None), (None, "x"), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def model_of(df):
    return train(df.filter(~held_out(df.doc_id)))


OPERATORS = {
    "decontam": lambda d, b: contaminated(d, b),
    "pack": lambda d, b: pack(d),
    "dedup": lambda d, b: near_duplicates(d),
    "shards": lambda d, b: kd_shards(d),
    "language": lambda d, b: predict(d, model_of(d)),
    "license": lambda d, b: scan(d),
    "quality": lambda d, b: clean_lines(d),
    "threads": lambda d, b: threads(d, "doc_id", "text", "source"),
    "tokens": lambda d, b: count_tokens(d),
    "warc": lambda d, b: read_packages(write_packages(d, "doc_id", "source", "text")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_names(spark, docs, clash, bench, name):
    plain = OPERATORS[name](docs, bench)
    odd = OPERATORS[name](clash, bench)
    assert len({c.lower() for c in odd.columns}) == len(odd.columns)
    assert plain.count() == odd.count()


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(spark, docs, bench, name):
    empty = docs.limit(0)
    assert OPERATORS[name](empty, bench.limit(0)).count() == 0
    if name != "warc":
        assert OPERATORS[name](spark.createDataFrame([], SCHEMA), bench).count() == 0


def test_defined_results(spark, docs, bench):
    dedup = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, width=4).collect()}
    by_id = {x[0]: x for x in dedup}
    assert by_id[1][1:] == (0, 1, True) and by_id[2][1:] == (0, 2, True) and by_id[3][1:] == (0, 3, True)
    assert by_id[4][2:] == (4, True) and by_id[5][2:] == (4, False) and by_id[6][2:] == (6, True)
    assert by_id[None][2:] == (None, True)
    lang = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs, model_of(docs)).collect()}
    assert lang[1] == lang[2] == lang[3] == lang[8] == ("und", 0.0) and lang[7][0] in ("de", "en")
    quality = {r.doc_id: r for r in clean_lines(docs).collect()}
    assert quality[1].n_words == 0 and quality[1].base_failed and quality[1].clean_text is None and not quality[1].kept
    assert quality[4].n_words == 40_000
    tokens = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs).collect()}
    assert tokens[1] == (0, 0) and tokens[2] == (0, 0) and tokens[4] == tokens[5]
    pieces = pack(docs).collect()
    assert sorted(r.doc_tokens for r in pieces if r.doc_id in (1, 2)) == [1, 1]
    shards = kd_shards(docs).collect()
    assert len(shards) == len(ROWS) and next(r for r in shards if r.doc_id == 1)["size"] == 1
    pages = {r.id: r for r in read_packages(write_packages(docs, "doc_id", "source", "text")).collect()}
    assert pages[4].record_type == "revisit" and pages[4].refers_to == 5 and pages[5].record_type == "response"
    assert pages[1].payload_bytes == 0 and pages[1].refers_to == 2


def test_pipeline_on_odd_rows(spark, docs, bench, tmp_root):
    docs.withColumn("n_chars", docs.doc_id).write.parquet(f"{tmp_root}/documents.parquet")
    bench.write.parquet(f"{tmp_root}/benchmark.parquet")
    out = corpus_pipeline.run(spark, tmp_root)
    assert {r.doc_id for r in out.collect()} <= {r[0] for r in ROWS}
    docs.limit(0).withColumn("n_chars", docs.doc_id).write.parquet(f"{tmp_root}/none/documents.parquet")
    bench.limit(0).write.parquet(f"{tmp_root}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_root}/none").count() == 0
