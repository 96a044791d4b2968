"""Metrics kept per delivery and merged (DQ-01, A-03): a new delivery adds one row of state, older ones aren't read again.

The state of a delivery has exact counts (they add up) and sketches of its keys: HLL for distinct counts over any set of deliveries,
theta for how many keys two sets of deliveries share (keys that come again). Both are merged by Spark's own functions.
The relative standard error is 1.04 / sqrt(2^LG_HLL) and 1 / sqrt(2^LG_THETA): 0.8 % and 1.6 % at the defaults.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_HLL, LG_THETA = 14, 12


def delivery_state(df: DataFrame, delivery: Sequence[str], key: str, counts: Mapping[str, Column]) -> DataFrame:
    """One row per delivery: rows, each named count of rows, and the sketches of ``key``."""
    return df.groupBy(*delivery).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in counts.items()],
        F.hll_sketch_agg(key, F.lit(LG_HLL)).alias("keys_hll"),
        F.theta_sketch_agg(key, F.lit(LG_THETA)).alias("keys_theta"),
    )


def add_delivery(df: DataFrame, path: str, delivery: str, key: str, counts: Mapping[str, Column]) -> None:
    """Writes the state of the deliveries in ``df`` beside the others'; a repeated delivery replaces its own row."""
    state = delivery_state(df, [delivery], key, counts)
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(delivery).parquet(path)


def read_state(spark: SparkSession, path: str, delivery: str) -> DataFrame:
    """The stored rows; the delivery's name is text whatever it looks like."""
    one = spark.read.parquet(path)
    return spark.read.schema(one.schema).parquet(path).withColumn(delivery, F.col(delivery).cast("string"))


def merged_metrics(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, counts and estimated distinct keys over all deliveries (or per group of them); ``duplicates`` is what
    rows exceed distinct keys by."""
    sums = [c for c, t in state.dtypes if t == "bigint" and c not in by]
    merged = state.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums], F.hll_sketch_estimate(F.hll_union_agg("keys_hll")).alias("distinct_keys"))
    return merged.withColumn("duplicates", F.greatest(F.col("rows") - F.col("distinct_keys"), F.lit(0).cast("long")))


def returning_keys(state: DataFrame, delivery: str) -> DataFrame:
    """Per delivery, estimated keys that the delivery before it (in order of name) had too."""
    names = [r[0] for r in state.select(delivery).distinct().orderBy(delivery).collect()]  # one row per delivery
    order = state.sparkSession.createDataFrame(list(zip(names[1:], names)), f"{delivery} string, before string")
    earlier = state.select(F.col(delivery).alias("before"), F.col("keys_theta").alias("theta_before"))
    both = state.select(delivery, "keys_theta").join(order, delivery).join(earlier, "before")
    return both.select(delivery, "before", F.theta_sketch_estimate(F.theta_intersection("keys_theta", "theta_before")).alias("returning"))
