"""Access to the driver's test tables (one Parquet file per table under an SF folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views named like the tables, for SQL-form operators."""
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
