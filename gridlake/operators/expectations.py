"""Data-contract expectations (E-01 … E-11). Each returns a *violations* DataFrame
(empty = expectation holds), so checks compose, run distributed, and can be
written next to the table they guard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.expressions import full_match, path_period, total, trunc_wall
from gridlake.operators.joins import duplicate_keys


def _values_frame(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType(), False)])
    return spark.createDataFrame([(v,) for v in values], schema)


def missing_sources(df: DataFrame, source_expr, expected: Sequence[str], name: str = "source") -> DataFrame:
    """E-01: expected sources that delivered no file (``source_expr`` derives the source from a path)."""
    delivered = df.select(source_expr.alias(name)).distinct()
    exp = _values_frame(df.sparkSession, name, expected)
    return exp.join(delivered, name, "left_anti")


def formats_present(df: DataFrame, path_col: str, expected: Sequence[str]) -> DataFrame:
    """E-02: expected file extensions not present among delivered files."""
    ext = F.lower(F.regexp_extract(F.col(path_col), r"\.([A-Za-z0-9]+)$", 1))
    return missing_sources(df, ext, expected, name="format")


def missing_periods(
    df: DataFrame,
    ts: str,
    unit: str = "week",
    label: str = "period",
) -> DataFrame:
    """E-03: periods between the first and last delivery with no rows.

    The calendar is generated from the observed min/max (one ``sequence``,
    size = number of periods) and anti-joined with the delivered periods.
    """
    zone_free = isinstance(df.schema[ts].dataType, (T.TimestampNTZType, T.DateType))
    trunc = trunc_wall(ts, unit) if zone_free else F.date_trunc(unit, F.col(ts))
    delivered = df.select(trunc.alias("_p")).distinct()
    bounds = delivered.agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"))
    step = F.expr(f"INTERVAL 1 {unit.upper()}") if unit != "week" else F.expr("INTERVAL 7 DAY")
    cal = bounds.select(F.explode(F.sequence("lo", "hi", step)).alias("_p"))
    return cal.join(delivered, "_p", "left_anti").select(F.col("_p").alias(label))


def deliveries_per_period(files: DataFrame, path_col: str, expected: int = 1, pattern: str = r"(\d{4}-W\d{2})", label: str = "period") -> DataFrame:
    """E-03: periods (from the path) with another number of delivered files than ``expected``; files without a period
    in their path are counted under ''. (Periods without any file: :func:`missing_periods`.)"""
    counted = files.groupBy(path_period(path_col, pattern).alias(label)).agg(F.count(F.lit(1)).alias("deliveries"))
    return counted.filter(F.col("deliveries") != expected)


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """E-04: order-insensitive content fingerprint: row count + sum of 64-bit row hashes."""
    cols = list(cols) if cols else df.columns
    h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h).cast("string").alias("fingerprint"))


def format_violations(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """E-05: rows whose ``col`` does not fully match ``pattern`` (NULL/blank included)."""
    return df.filter(~total(full_match(col, pattern)))


def range_violations(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    """E-06: rows outside [lo, hi] (or NULL)."""
    ok = F.lit(True)
    c = F.col(col)
    if lo is not None:
        ok = ok & ((c >= lo) if inclusive else (c > lo))
    if hi is not None:
        ok = ok & ((c <= hi) if inclusive else (c < hi))
    return df.filter(~total(ok & c.isNotNull()))


def unique_violations(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """E-07: keys present more than once."""
    return duplicate_keys(df, keys, count_col)


def array_length_violations(df: DataFrame, arrays: Sequence[str], expected: int | None = None) -> DataFrame:
    """E-09: rows whose arrays are not of ``expected`` length or not equally long."""
    sizes = [F.size(F.col(a)) for a in arrays]
    ok = F.lit(True)
    for s in sizes[1:]:
        ok = ok & (s == sizes[0])
    if expected is not None:
        ok = ok & (sizes[0] == expected)
    return df.filter(~total(ok))


def closed_enum(df: DataFrame, col: str, allowed: Sequence[str], value_col: str = "value") -> DataFrame:
    """E-10: values outside the allowed set (``unexpected``) and allowed values never seen (``missing``)."""
    seen = df.select(F.col(col).cast("string").alias(value_col)).distinct()
    allowed_df = _values_frame(df.sparkSession, value_col, allowed)
    unexpected = seen.join(F.broadcast(allowed_df), value_col, "left_anti").withColumn("issue", F.lit("unexpected"))
    missing = allowed_df.join(seen, value_col, "left_anti").withColumn("issue", F.lit("missing"))
    return unexpected.unionByName(missing)


#: A delivery calendar is read by the driver; a column with more values is refused.
MAX_DELIVERIES = 100_000


def delivery_overlap(df: DataFrame, keys: Sequence[str], delivery: str) -> DataFrame:
    """E-11: per pair of consecutive deliveries, the number of keys present in both.

    One pass builds the distinct (key, delivery) pairs; a window per key then
    gives each pair the key's next delivery (a key's partition holds at most one
    row per delivery, so even the hottest key is bounded by the number of
    deliveries, not by its row count). A key counts for (d, next(d)) when its
    next delivery is the globally next one. The delivery calendar — one value
    per delivery, bounded metadata like a partition list — is read once (one
    column, map-side distinct) and turned into a small local frame of
    consecutive pairs. Pairs with no shared key report 0; no self-join of the
    data, no cross product.
    """
    spark = df.sparkSession
    kd = df.select(*keys, delivery).distinct()
    per_key = kd.withColumn("_next", F.lead(delivery).over(Window.partitionBy(*keys).orderBy(delivery)))
    calendar = sorted(r[0] for r in df.select(delivery).distinct().limit(MAX_DELIVERIES + 1).collect() if r[0] is not None)
    if len(calendar) > MAX_DELIVERIES:
        raise ValueError(f"more than {MAX_DELIVERIES} deliveries: {delivery} is no delivery column")
    dtype = df.schema[delivery].dataType
    pair_schema = T.StructType([T.StructField("delivery", dtype), T.StructField("next_delivery", dtype)])
    pairs = spark.createDataFrame(list(zip(calendar, calendar[1:])), pair_schema)
    shared = (
        per_key.join(F.broadcast(pairs), (per_key[delivery] == pairs["delivery"]) & (per_key["_next"] == pairs["next_delivery"]))
        .groupBy("delivery")
        .agg(F.count(F.lit(1)).alias("shared_keys"))
    )
    return pairs.join(shared, "delivery", "left").select(
        "delivery", "next_delivery", F.coalesce("shared_keys", F.lit(0)).cast("long").alias("shared_keys")
    )
