"""The registered queries of the training-data operators: each applies its operator, with production parameters,
to its whole table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import tables
from .best_fit_pack import cut_pieces, place
from .bulk_best_fit import bulk_best_fit, window_pieces
from .eigen_whitening import whiten
from .kd_shards import kd_shards
from .license_dice import scan
from .minhash_dedup import near_duplicates
from .oracles import ORACLES
from .ppm_language import held_out, predict, train
from .quality_lines import clean_lines
from .quote_threads import threads
from .semantic_decontam import contaminated
from .spelling_variants import spelling_variants, vocabulary
from .token_transducer import count_tokens
from .zip_warc import read_packages, write_packages


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(tables(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    out = predict(docs, model, carry=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op1_semantic_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op6_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(tables(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(tables(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines"
    )


def op2_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut_pieces(tables(spark, sf_dir, "documents"))
    placed = place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(tables(spark, sf_dir, "documents"), width=4, percent=80)


def quoted_messages(conversations: DataFrame) -> DataFrame:
    """Mail-like messages from the turns: each quotes the turn before it, and one level deeper the turn before that."""
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    quote = lambda c, mark: F.concat(F.lit(mark), F.replace(F.col(c), F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))

    def earlier(k: int, name: str) -> DataFrame:
        # of repeated turns the first by text is quoted; turns without a number are quoted by none
        one = turns.filter("turn is not null").groupBy("conv_id", "turn").agg(F.min("text").alias(name))
        return one.select(F.col("conv_id").alias("c"), (F.col("turn") + k).alias("t"), name)

    def with_earlier(df: DataFrame, k: int, name: str) -> DataFrame:
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t"))
        return df.join(earlier(k, name), same, "left").drop("c", "t")

    both = with_earlier(with_earlier(turns, 1, "one"), 2, "two")
    body = F.concat(F.coalesce(quote("two", ">> "), F.lit("")), F.coalesce(quote("one", "> "), F.lit("")), "text")
    return both.select("conv_id", "turn", "role", body.alias("body"))


def op8_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = quoted_messages(tables(spark, sf_dir, "conversations"))
    linked = threads(messages, "turn", "body", scope_col="conv_id")
    return linked.select(
        F.col("scope").alias("conv_id"), F.col("id").alias("turn"), F.col("parent").alias("parent_turn"),
        F.col("root").alias("root_turn"), "depth", "position", "text",
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(tables(spark, sf_dir, "documents"), carry=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_packages(write_packages(tables(spark, sf_dir, "pages"), min_revisit_bytes=0))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(tables(spark, sf_dir, "documents")))


def op12_bulk_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = window_pieces(tables(spark, sf_dir, "documents"))
    placed = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids").join(bulk_best_fit(pieces), "key")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_eigen_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whiten(tables(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    explained = F.array(*map(F.lit, model["explained"])).cast("array<double>")
    each = rows.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model["n"]).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(model["identity_error"]).cast("double").alias("identity_error"),
    )


QUERIES = {
    "op11_spelling_variants": op11_spelling_variants,
    "op12_bulk_best_fit": op12_bulk_best_fit,
    "op13_eigen_whitening": op13_eigen_whitening,
    "op6_license_dice": op6_license_dice,
    "op8_quote_threads": op8_quote_threads,
    "op10_zip_warc": op10_zip_warc,
    "op4_kd_shards": op4_kd_shards,
    "op2_best_fit_pack": op2_best_fit_pack,
    "op9_token_counts": op9_token_counts,
    "op1_semantic_decontam": op1_semantic_decontam,
    "op5_ppm_language": op5_ppm_language,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op7_line_quality": op7_line_quality,
}

__all__ = ["ORACLES", "QUERIES"]
