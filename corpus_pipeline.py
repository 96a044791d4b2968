"""Corpus pipeline: language ID, line quality, near-duplicates, benchmark decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.best_fit_pack import cut_pieces, place
from gridlake.llm.common import materialize, sized, tables
from gridlake.llm.minhash_dedup import near_duplicates
from gridlake.llm.ppm_language import UNDETERMINED, held_out, predict, train
from gridlake.llm.quality_lines import clean_lines
from gridlake.llm.semantic_decontam import contaminated

#: A language must be more likely than all others together.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without one language that is likelier than the others together, go.

    ``lang`` becomes the predicted language.
    """
    out = predict(docs, train(docs.filter(~held_out(F.col("doc_id")))))
    out = out.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") > MIN_LANGUAGE_SCORE))
    return out.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lose too much text go; the others keep the lines that passed."""
    out = clean_lines(docs).filter("kept").withColumn("text", F.col("clean_text"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    Rows that repeat an id count as one document, of which one row stays; rows without an id all stay.
    """
    found = near_duplicates(docs, width=5, percent=80)
    gone = materialize(found.filter("not kept").select("doc_id").distinct(), "copies")
    left = docs.join(sized(gone), "doc_id", "left_anti").select(*docs.columns)
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return left
    return left.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(left.filter("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a paraphrase of one, go."""
    hits = contaminated(docs, tables(spark, sf_dir, "benchmark")).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(sized(materialize(hits, "contaminated")), "doc_id", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in training sequences."""
    pieces = cut_pieces(docs)
    placed = place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: Not SQL: language models, sketches, a decomposition and a tokenizer. Tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written below spark.checkpoint.dir and read again."""
    docs = tables(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
