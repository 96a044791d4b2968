"""Table-layout jobs (M-01 … M-07) for plain Parquet tables.

* ``table_stats``: file count / size from a file *listing* as a DataFrame
  (``binaryFile`` projected to ``path, length`` reads no file content).
* ``compact``: ``coalesce`` to ceil(size ÷ target) partitions — merges
  neighbouring input splits without a shuffle.
* ``cluster_by``: one column → range partitioning + sort within files;
  several → Z-order (Morton) key over approximate-quantile buckets.
* ``pruning_report``: per-file min/max of a column (one column scanned) →
  how many files/rows a predicate must touch. Deterministic stand-in for
  before/after wall-clock timings.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.expressions import morton_key

MB = 1024.0 * 1024.0


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``path, length`` of the data files under ``path`` — no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def table_stats(spark: SparkSession, tables: Mapping[str, str], glob: str = "*.parquet") -> DataFrame:
    """Per table: number of files, MB, mean MB per file (``max(files, 1)`` guards empty tables)."""
    parts = []
    for name, path in tables.items():
        f = list_files(spark, path, glob)
        parts.append(
            f.agg(F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes")).select(
                F.lit(name).alias("table"), "num_files", "size_bytes"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        "table",
        "num_files",
        "size_bytes",
        F.round(F.col("size_bytes") / MB, 1).alias("size_mb"),
        F.round(F.col("size_bytes") / MB / F.greatest(F.col("num_files"), F.lit(1)), 2).alias("avg_file_mb"),
    )


def target_file_count(spark: SparkSession, path: str, target_bytes: int) -> int:
    r = table_stats(spark, {"t": path}).first()
    return max(1, math.ceil(int(r["size_bytes"]) / max(target_bytes, 1)))


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    target_bytes: int = 128 * 1024 * 1024,
) -> int:
    """Rewrite ``src`` into about size ÷ ``target_bytes`` files at ``dst`` (a new version dir).

    ``coalesce`` groups neighbouring input splits into one output task: no
    shuffle, content unchanged. Returns the number of output partitions.
    """
    n = target_file_count(spark, src, target_bytes)
    spark.read.parquet(src).coalesce(n).write.mode("overwrite").parquet(dst)
    return n


def quantile_buckets(df: DataFrame, col: str, bits: int, rel_error: float = 0.001) -> Column:
    """Integer bucket 0 … 2^bits-1 of ``col`` from approximate quantiles (a small driver result).

    The bucket is a sum of 2^bits - 1 compiled comparisons; ``bits`` around 6
    (64 buckets per column) keeps the generated code small.
    """
    return quantile_buckets_of(df, [col], bits, rel_error)[0]


#: Sampled rows per bucket for bounds of columns that aren't numbers.
SAMPLE_PER_BUCKET = 50
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def sampled_bounds(df: DataFrame, cols: Sequence[str], k: int) -> list[list]:
    """For columns of any orderable type, k - 1 bounds of about equal shares, from the rows of least hash: a sample of fixed
    size, drawn alike wherever a row lies (values that repeat are drawn as often as they occur in different rows)."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(h.alias("_h"), *[F.col(f"`{c}`") for c in cols]).orderBy("_h").limit(SAMPLE_PER_BUCKET * k).collect()
    out = []
    for c in cols:
        values = sorted(r[c] for r in rows if r[c] is not None)
        out.append([values[i * len(values) // k] for i in range(1, k)] if values else [])
    return out


def quantile_buckets_of(df: DataFrame, cols: Sequence[str], bits: int, rel_error: float = 0.001) -> list[Column]:
    """Quantile buckets of several columns: numbers by approximate quantiles, text, decimals, dates and times by sampled bounds, compared in their
    own order, so that a prefix that all values share doesn't matter."""
    k = 1 << bits
    numbers = [c for c in cols if isinstance(df.schema[c].dataType, _NUMBERS)]
    others = [c for c in cols if c not in numbers]
    bounds = dict(zip(others, sampled_bounds(df, others, k))) if others else {}
    if numbers:
        probs = [i / k for i in range(1, k)]
        casts = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in numbers])
        bounds |= dict(zip(numbers, casts.approxQuantile(numbers, probs, rel_error)))
    out = []
    for c in cols:
        value = F.col(f"`{c}`")
        bucket = F.lit(0)
        for b in sorted(set(bounds[c])):
            bucket = bucket + F.when(value >= F.lit(b).cast(df.schema[c].dataType) if c in others else value >= F.lit(b), 1).otherwise(0)
        out.append(bucket)
    return out


def cluster_by(
    df: DataFrame,
    cols: Sequence[str],
    num_files: int,
    bits: int = 6,
) -> DataFrame:
    """Co-locate rows by ``cols`` for file skipping (OPTIMIZE … ZORDER BY equivalent).

    One column: ``repartitionByRange`` (sampled range bounds, balanced files) +
    ``sortWithinPartitions`` (tight min/max and row-group stats per file).
    Several: rows are ordered by a Morton key interleaving ``bits``-bit
    quantile buckets of each column, so every column keeps some locality.
    """
    cols = list(cols)
    # The row hash is a second range column: the rows of one very frequent value (or cell) fill several files.
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    if len(cols) == 1:
        return df.repartitionByRange(num_files, F.col(cols[0]), spread).sortWithinPartitions(cols[0])
    keyed = df.withColumn("_z", morton_key(quantile_buckets_of(df, cols, bits), bits))
    return keyed.repartitionByRange(num_files, F.col("_z"), spread).sortWithinPartitions("_z", *cols).drop("_z")


def file_ranges(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Per data file: min, max and rows of ``col`` (only that column is scanned)."""
    return (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col(col).alias("_v"))
        .groupBy("file")
        .agg(F.min("_v").alias("min_v"), F.max("_v").alias("max_v"), F.count(F.lit(1)).alias("rows"))
    )


#: Values that a pruning report is asked for (a top-k list).
MAX_REPORT_VALUES = 1000


def pruning_report(
    spark: SparkSession,
    tables: Mapping[str, str],
    col: str,
    values: DataFrame | Sequence,
) -> DataFrame:
    """Files and rows a ``col IN values`` predicate must touch, per table version.

    ``values`` may be a DataFrame of one column (e.g. :func:`hot_keys`), of at
    most ``MAX_REPORT_VALUES`` values: they become a literal that each file's
    summary row is tested against, so nothing is joined.
    """
    if isinstance(values, DataFrame):
        values = [r[0] for r in values.select(values.columns[0]).distinct().limit(MAX_REPORT_VALUES + 1).collect()]
    wanted = [v for v in values if v is not None]
    if len(wanted) > MAX_REPORT_VALUES:
        raise ValueError(f"a pruning report takes at most {MAX_REPORT_VALUES} values")
    literal = F.array(*[F.lit(v) for v in wanted])
    out = None
    for name, path in tables.items():
        ranges = file_ranges(spark, path, col)
        inside = lambda v: (v >= F.col("min_v")) & (v <= F.col("max_v"))
        hit = F.exists(literal, inside) if wanted else F.lit(False)
        part = ranges.agg(
            F.count(F.lit(1)).alias("files_total"),
            F.count_if(hit).alias("files_touched"),
            F.sum("rows").alias("rows_total"),
            F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0)).alias("rows_touched"),
        ).select(F.lit(name).alias("table"), "files_total", "files_touched", "rows_total", "rows_touched")
        out = part if out is None else out.unionByName(part)
    return out


def table_location(spark: SparkSession, name: str) -> str:
    """Storage folder of a catalog table (catalog metadata, one small result)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    for r in rows:
        if r["col_name"] == "Location":
            return r["data_type"]
    raise ValueError(f"no location for table {name}")


def optimize(
    spark: SparkSession,
    name: str,
    base: str,
    cluster_cols: Sequence[str] | None = None,
    target_bytes: int = 128 * 1024 * 1024,
    bits: int = 6,
) -> str:
    """``OPTIMIZE name [ZORDER BY (cols)]`` for a plain Parquet catalog table.

    Rewrites the current version into about size ÷ ``target_bytes`` files —
    compacted without a shuffle, or clustered by ``cluster_cols`` — as a new
    version folder, then swaps the table location (readers of the old version
    are never disturbed). Returns the new version path.
    """
    from gridlake.sinks import publish

    src = table_location(spark, name)
    n = target_file_count(spark, src, target_bytes)
    df = spark.read.parquet(src)
    out = cluster_by(df, cluster_cols, n, bits) if cluster_cols else df.coalesce(n)
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return publish(out, name, base, partition_by=partitions)
