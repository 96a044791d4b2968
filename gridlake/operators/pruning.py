"""File pruning from statistics (M-04): zone maps from Parquet footers, and Bloom filters for columns that files aren't clustered by.

Zone maps read footers alone, each on the executor that has its path; no data page is touched. A Bloom filter costs one scan of
its column when it is built; afterwards an equality predicate asks the index, which has ``bits`` / 64 small rows a file at most.
Both only ever rule files out that can't hold a value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import gridlake
from gridlake.operators.layout import MAX_REPORT_VALUES, file_ranges, list_files

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(gridlake)

#: Types whose footer statistics order like their values, with what a footer value becomes.
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _footer_rows(columns: list[str], numeric: list[bool]):
    def run(batches):
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                uri = path.replace("file:///", "/").replace("file:/", "/")
                store, name = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
                with store.open_input_file(name) as f:
                    meta = pq.ParquetFile(f).metadata
                place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                for c, number in zip(columns, numeric):
                    stats = [meta.row_group(g).column(place[c]).statistics for g in range(meta.num_row_groups)]
                    n = [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]
                    known = all(s is not None and (s.has_min_max or s.null_count == k) for s, k in zip(stats, n))
                    ends = [s for s in stats if s is not None and s.has_min_max]
                    low = min((s.min for s in ends), default=None) if known else None
                    high = max((s.max for s in ends), default=None) if known else None
                    as_number = lambda x: None if x is None or not number else float(x)
                    as_text = lambda x: None if x is None or number else str(x)
                    rows.append((path, c, known, sum(n), as_number(low), as_number(high), as_text(low), as_text(high)))
            types = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string()]
            names = ["file", "column", "known", "rows", "min_number", "max_number", "min_text", "max_text"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return run


def zone_map(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Per data file and column: min, max and rows from the footer (``known`` is false where a row group has no statistics).

    Numbers (up to 2^53 exactly), and dates, times and text as text, whose order is theirs.
    """
    schema = spark.read.parquet(path).schema
    numeric = [isinstance(schema[c].dataType, _NUMERIC) for c in columns]
    files = list_files(spark, path).select("path")
    out = "file string, column string, known boolean, rows long, min_number double, max_number double, min_text string, max_text string"
    return files.mapInArrow(_footer_rows(list(columns), numeric), out)


def _report(parts: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, files in parts.items():
        part = files.agg(
            F.count(F.lit(1)).alias("files_total"),
            F.count_if("hit").alias("files_touched"),
            F.sum("rows").alias("rows_total"),
            F.coalesce(F.sum(F.when(F.col("hit"), F.col("rows"))), F.lit(0)).alias("rows_touched"),
        ).select(F.lit(name).alias("table"), "files_total", "files_touched", "rows_total", "rows_touched")
        out = part if out is None else out.unionByName(part)
    return out


def _wanted(values: DataFrame | Sequence) -> list:
    if isinstance(values, DataFrame):
        values = [r[0] for r in values.select(values.columns[0]).distinct().limit(MAX_REPORT_VALUES + 1).collect()]
    wanted = [v for v in values if v is not None]
    if len(wanted) > MAX_REPORT_VALUES:
        raise ValueError(f"a pruning report takes at most {MAX_REPORT_VALUES} values")
    return wanted


def _between(low: Column, high: Column):
    return lambda v: (v >= low) & (v <= high)


def zone_report(spark: SparkSession, tables: Mapping[str, str], col: str, values: DataFrame | Sequence) -> DataFrame:
    """Files and rows that ``col IN values`` must touch, per table version, from footers alone: the same table as
    ``layout.pruning_report`` gives by a scan."""
    wanted = _wanted(values)
    parts = {}
    for name, path in tables.items():
        number = isinstance(spark.read.parquet(path).schema[col].dataType, _NUMERIC)
        kind = "number" if number else "text"
        literal = F.array(*[F.lit(float(v) if number else str(v)) for v in wanted])
        low, high = F.col(f"min_{kind}"), F.col(f"max_{kind}")
        hit = F.exists(literal, _between(low, high)) if wanted else F.lit(False)
        parts[name] = zone_map(spark, path, [col]).withColumn("hit", ~F.col("known") | F.coalesce(hit, F.lit(False)))
    return _report(parts)


def bloom_size(values: int, false_share: float) -> tuple[int, int]:
    """Bits (a power of two) and hash functions of a filter for so many distinct values."""
    bits = max(64, 1 << math.ceil(math.log2(max(1.0, -values * math.log(false_share) / math.log(2) ** 2))))
    return bits, max(1, round(bits / max(values, 1) * math.log(2)))


def _positions(value: Column, bits: int, hashes: int) -> Column:
    """The places of a value in a filter (double hashing)."""
    a, b = F.xxhash64(value, F.lit(1)), F.xxhash64(value, F.lit(2)).bitwiseOR(F.lit(1).cast("long"))
    at = [F.shiftrightunsigned(F.xxhash64(a, b, F.lit(i)), 1) % F.lit(bits) for i in range(hashes)]
    return F.array(*at)


def bloom_index(spark: SparkSession, path: str, col: str, false_share: float = 0.01, values_per_file: int | None = None) -> tuple[DataFrame, int, int]:
    """``(file, word, mask)`` of a Bloom filter per data file over ``col``, with its bits and hash functions.

    Masks are ORed before they are shuffled. ``values_per_file``: distinct values to size for (default: measured, approximately).
    """
    own = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col(col).alias("v")).filter("v is not null")
    if values_per_file is None:
        values_per_file = own.groupBy("file").agg(F.approx_count_distinct("v").alias("n")).agg(F.max("n")).first()[0] or 1
    bits, hashes = bloom_size(values_per_file, false_share)
    at = own.select("file", F.explode(_positions(F.col("v"), bits, hashes)).alias("p"))
    masks = at.select("file", F.floor(F.col("p") / 64).alias("word"), F.expr("shiftleft(1L, cast(p % 64 AS INT))").alias("mask"))
    return masks.groupBy("file", "word").agg(F.bit_or("mask").alias("mask")), bits, hashes


def bloom_report(spark: SparkSession, tables: Mapping[str, str], col: str, values: DataFrame | Sequence, false_share: float = 0.01) -> DataFrame:
    """Files and rows that ``col IN values`` must touch by the Bloom filters of the files."""
    wanted = spark.createDataFrame([(v,) for v in _wanted(values)], T.StructType([T.StructField("v", spark.read.parquet(next(iter(tables.values()))).schema[col].dataType)]))
    parts = {}
    for name, path in tables.items():
        index, bits, hashes = bloom_index(spark, path, col, false_share)
        asked = wanted.select("v", F.explode(F.array_distinct(_positions(F.col("v"), bits, hashes))).alias("p"))
        need = asked.select("v", F.floor(F.col("p") / 64).alias("word"), F.expr("shiftleft(1L, cast(p % 64 AS INT))").alias("bit"))
        need = need.groupBy("v", "word").agg(F.bit_or("bit").alias("need"))
        words = need.groupBy("v").agg(F.count(F.lit(1)).alias("words"))
        met = index.join(F.broadcast(need), "word").filter(F.col("mask").bitwiseAND(F.col("need")) == F.col("need"))  # at most MAX_REPORT_VALUES x hashes rows
        held = met.groupBy("file", "v").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(words), "v").filter("n = words").select("file").distinct()
        files = zone_map(spark, path, [col]).select("file", "rows").withColumn("file", F.regexp_replace("file", "^file:/+", "/"))
        held = held.withColumn("file", F.regexp_replace("file", "^file:/+", "/")).withColumn("hit", F.lit(True))
        parts[name] = files.join(held, "file", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return _report(parts)


def scan_report(spark: SparkSession, tables: Mapping[str, str], col: str, values: DataFrame | Sequence) -> DataFrame:
    """What a perfect index would touch: files that hold one of the values (by a scan of the column)."""
    wanted = F.array(*[F.lit(v) for v in _wanted(values)])
    parts = {}
    for name, path in tables.items():
        own = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col(col).alias("v"))
        parts[name] = own.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.bool_or(F.coalesce(F.array_contains(wanted, F.col("v")), F.lit(False))).alias("hit"))
    return _report(parts)


__all__ = ["bloom_index", "bloom_report", "bloom_size", "file_ranges", "scan_report", "zone_map", "zone_report"]
