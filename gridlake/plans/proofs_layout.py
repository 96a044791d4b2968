"""Proofs for table-layout jobs (§2.11) and file-level expectations (E-01, E-02, E-04).

Layout jobs must not change content: their oracle is the source table itself.
Reports about files (counts, pruning) are rows-only checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators import expectations as ex
from gridlake.operators.aggregates import hot_keys
from gridlake.operators.layout import cluster_by, compact, list_files, pruning_report, table_stats
from gridlake.operators.pruning import bloom_report, scan_report, zone_report
from gridlake.plans.registry import proof
from gridlake.plans.tables import table
from gridlake.session import scratch_path
from gridlake.sources.batch import TEXT_WRITE_OPTIONS
from gridlake.streaming.ingest import source_name

LINEITEM_SQL = "SELECT * FROM lineitem"


def _small_files(spark: SparkSession, d: str, n: int = 64) -> str:
    """``lineitem`` landed as ``n`` small files (the many-small-files situation)."""
    path = scratch_path(spark, "lineitem-small")
    table(spark, d, "lineitem").repartition(n).write.parquet(path)
    return path


def _one_file_per(df: DataFrame, path: str, bucket: str) -> str:
    """The rows in one file per value of a SQL expression (a balanced remainder or range of the key)."""
    df.withColumn("b", F.expr(bucket)).repartition("b").write.partitionBy("b").parquet(path)
    return path


_STATS_BUCKETS = {"lineitem_small": "(l_orderkey * 7 + l_linenumber) % 32", "lineitem_half": "(l_orderkey * 7 + l_linenumber) % 16"}


@proof(
    "table_stats",
    " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(DISTINCT {b})::INT AS num_files, count(*) > 0 AS has_bytes FROM lineitem" for t, b in _STATS_BUCKETS.items()),
    ("M-01",),
)
def q_table_stats(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    stats = table_stats(spark, {t: _one_file_per(li, scratch_path(spark, t), b) for t, b in _STATS_BUCKETS.items()})
    name = stats.columns[0]
    return stats.select(F.col(name).alias("tbl"), F.col("num_files").cast("int").alias("num_files"), (F.col("size_bytes") > 0).alias("has_bytes"))


@proof("compact", LINEITEM_SQL, ("M-02",))
def q_compact(spark: SparkSession, d: str) -> DataFrame:
    src = _small_files(spark, d, 64)
    dst = scratch_path(spark, "lineitem-compact")
    compact(spark, src, dst, target_bytes=1 << 20)
    return spark.read.parquet(dst)


@proof("cluster_by", LINEITEM_SQL, ("M-03", "X-06"))
def q_cluster_by(spark: SparkSession, d: str) -> DataFrame:
    dst = scratch_path(spark, "lineitem-clustered")
    cluster_by(table(spark, d, "lineitem"), ["l_partkey"], num_files=16).write.parquet(dst)
    return spark.read.parquet(dst)


@proof("cluster_by_zorder", LINEITEM_SQL, ("M-03",))
def q_cluster_zorder(spark: SparkSession, d: str) -> DataFrame:
    dst = scratch_path(spark, "lineitem-zorder")
    cluster_by(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], num_files=16, bits=4).write.parquet(dst)
    return spark.read.parquet(dst)


#: Files of the two layouts, by row content: dealt by order line, and by ranges of the part key.
_DEALT, _RANGED = "(l_orderkey * 7 + l_linenumber) % 16", "floor(l_partkey * 16 / ({most} + 1))"

_REPORT_SQL = f"""
WITH v AS (SELECT l_partkey AS v FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 3),
f AS (
  SELECT 'no_zorder' AS version, {_DEALT} AS b, l_partkey FROM lineitem
  UNION ALL SELECT 'zordered', {_RANGED.format(most="(SELECT max(l_partkey) FROM lineitem)")}, l_partkey FROM lineitem),
r AS (SELECT version, b, min(l_partkey) AS lo, max(l_partkey) AS hi, count(*) AS n FROM f GROUP BY ALL),
h AS (SELECT *, EXISTS (SELECT 1 FROM v WHERE v BETWEEN lo AND hi) AS hit FROM r)
SELECT version, count(*) AS files_total, count(*) FILTER (hit) AS files_touched, sum(n)::BIGINT AS rows_total, coalesce(sum(n) FILTER (hit), 0)::BIGINT AS rows_touched
FROM h GROUP BY version"""


def _two_layouts(spark: SparkSession, li: DataFrame) -> dict[str, str]:
    most = li.agg(F.max("l_partkey")).first()[0]
    return {
        "no_zorder": _one_file_per(li, scratch_path(spark, "lineitem-dealt"), _DEALT),
        "zordered": _one_file_per(li, scratch_path(spark, "lineitem-ranged"), _RANGED.format(most=most)),
    }


@proof("pruning_report", _REPORT_SQL, ("M-04", "M-05", "M-07"))
def q_pruning_report(spark: SparkSession, d: str) -> DataFrame:
    """Files and rows a ``l_partkey IN (top-3 keys)`` predicate must open, by a scan of the column."""
    li = table(spark, d, "lineitem")
    top = hot_keys(li, ["l_partkey"], 3).select("l_partkey")
    return pruning_report(spark, _two_layouts(spark, li), "l_partkey", top).withColumnRenamed("table", "version")


@proof("pruning_zone_map", _REPORT_SQL, ("M-04", "M-05"))
def q_zone_map(spark: SparkSession, d: str) -> DataFrame:
    """The same report from footers alone."""
    li = table(spark, d, "lineitem")
    top = hot_keys(li, ["l_partkey"], 3).select("l_partkey")
    return zone_report(spark, _two_layouts(spark, li), "l_partkey", top).withColumnRenamed("table", "version")


@proof(
    "pruning_bloom",
    f"""WITH v AS (SELECT DISTINCT l_orderkey AS v FROM lineitem ORDER BY 1 LIMIT 2),
    f AS (SELECT {_DEALT} AS b, count(*) AS n, bool_or(l_orderkey IN (SELECT v FROM v)) AS held FROM lineitem GROUP BY 1)
    SELECT count(*) AS files_total, count(*) FILTER (held) AS files_held, 0::BIGINT AS files_lost, true AS few_false FROM f""",
    ("M-04",),
)
def q_bloom(spark: SparkSession, d: str) -> DataFrame:
    """Equality on a column that the files aren't clustered by: filters touch every file that holds a value, and hardly
    another one, where min and max rule out none."""
    li = table(spark, d, "lineitem")
    tables = {"dealt": _one_file_per(li, scratch_path(spark, "lineitem-dealt"), _DEALT)}
    keys = li.select("l_orderkey").distinct().orderBy("l_orderkey").limit(2)
    by_filter = bloom_report(spark, tables, "l_orderkey", keys).select("table", F.col("files_touched").alias("touched"))
    held = scan_report(spark, tables, "l_orderkey", keys).join(by_filter, "table")
    lost = F.greatest(F.col("files_touched") - F.col("touched"), F.lit(0).cast("long"))
    few = (F.col("touched") - F.col("files_touched")) <= F.ceil(F.col("files_total") * 0.1)
    return held.select("files_total", F.col("files_touched").alias("files_held"), lost.alias("files_lost"), few.alias("few_false"))


@proof("fingerprint", "SELECT count(*) AS n_rows, true AS same FROM lineitem", ("E-04",))
def q_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Same content → same fingerprint, whatever the file layout or row order."""
    li = table(spark, d, "lineitem")
    path = scratch_path(spark, "lineitem-shuffled")
    li.repartition(7, "l_suppkey").write.parquet(path)
    both = ex.table_fingerprint(li).unionByName(ex.table_fingerprint(spark.read.parquet(path)))
    return both.agg(F.min("n_rows").alias("n_rows"), (F.count_distinct("n_rows", "fingerprint") == 1).alias("same"))


#: Most folders that are expected by name; more are an error.
MAX_SOURCES = 1000


@proof("missing_sources", "SELECT 'event_type=' || min(event_type) AS source FROM events", ("E-01",))
def q_missing_sources(spark: SparkSession, d: str) -> DataFrame:
    """One folder per event type; the first type's folder is not delivered."""
    root = scratch_path(spark, "landing-zone")
    events = table(spark, d, "events")
    types = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").limit(MAX_SOURCES + 1).collect()]
    if len(types) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} event types: too many folders to expect")
    events.filter(F.col("event_type") != types[0]).write.partitionBy("event_type").options(**TEXT_WRITE_OPTIONS).json(root)
    missing = ex.missing_sources(list_files(spark, root, "part-*"), source_name("path", 2), [f"event_type={t}" for t in types])
    return missing.select(F.col(missing.columns[0]).alias("source"))


#: The format in which an order is delivered, by its key (the same rules in query and oracle); none is left out.
_FORMATS = {"csv": "o_orderkey % 3 = 0", "json": "o_orderkey % 3 = 1", "parquet": "o_orderkey % 3 = 2", "orc": "o_orderkey < 0"}


@proof(
    "formats_present",
    " UNION ALL ".join(f"SELECT '{f}' AS format WHERE NOT EXISTS (SELECT 1 FROM orders WHERE {rule})" for f, rule in _FORMATS.items()),
    ("E-02",),
)
def q_formats_present(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "landing-formats")
    for fmt, rule in _FORMATS.items():
        part = table(spark, d, "orders").filter(rule)
        if not part.isEmpty():
            part.write.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).save(f"{root}/{fmt}")
    missing = ex.formats_present(list_files(spark, root, "part-*"), "path", list(_FORMATS))
    return missing.select(F.col(missing.columns[0]).alias("format"))
