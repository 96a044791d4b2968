"""Proofs for sources and sinks (§2.1, §2.2, X-03).

Each proof writes a test table as a landing tree (CSV / JSON / Parquet) into a
fresh folder under the shared checkpoint root, ingests it with the operator
and returns the ingested table; the oracle reads the original table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.expressions import trunc_wall

from gridlake import contracts as C
from gridlake.functions.expressions import iso_week, path_period
from gridlake.operators.flatten import flatten_envelope
from gridlake.operators.layout import list_files, optimize
from gridlake.plans import defects
from gridlake.plans.marts import silver_flagged
from gridlake.plans.proofs_relational import SILVER_SPEC, SILVER_SQL, event_envelopes, raw_orders
from gridlake.plans.registry import proof
from gridlake.plans.tables import table
from gridlake.session import scratch_path
from gridlake.sinks import publish, read_batches, replace_periods, route_write
from gridlake.sources.batch import TEXT_WRITE_OPTIONS, preview_raw, read_csv, read_json, read_parquet, with_audit
from gridlake.sources.drift import SchemaLog, added_columns, probe_headers, read_csv_drifting
from gridlake.sources.rescue import cast_with_rescue
from gridlake.streaming.ingest import ingest_drifting_csv, ingest_stream

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
WEEK_SQL = "strftime(o_orderdate, '%G-W%V')"
# Fixed value: first ISO week delivered with the second header version (a Monday).
DRIFT_CUT = "1997-12-29"


def land_weekly_csv(df: DataFrame, root: str, sep: str = ";", mode: str = "overwrite") -> None:
    """Weekly extracts: CSV files under ISO-week folders ``wk=YYYY-Www``.

    Rows are range-partitioned on (date, key): each task writes a contiguous
    run of weeks, a week split between neighbouring tasks gets two files, and
    no task holds a whole group however skewed the dates are. The explicit
    partition count keeps the small files written in parallel.
    """
    wk = iso_week("o_orderdate")
    n = 4 * df.sparkSession.sparkContext.defaultParallelism
    (
        df.withColumn("wk", wk)
        .repartitionByRange(n, "o_orderdate", "o_orderkey")
        .write.mode(mode)
        .options(**TEXT_WRITE_OPTIONS)
        .option("header", True)
        .option("sep", sep)
        .partitionBy("wk")
        .csv(root)
    )


def _orders_with_week_sql(extra: str = "") -> str:
    return f"SELECT {', '.join(ORDER_COLS)}, {WEEK_SQL} AS _extract_week{extra} FROM orders"


@proof("ingest_csv_batch", _orders_with_week_sql(), ("S-04", "S-13", "S-12", "P-02", "C-02", "G-04"))
def q_ingest_csv_batch(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "landing-orders-csv")
    land_weekly_csv(table(spark, d, "orders"), root)
    df = read_csv(spark, root, C.ORDERS.schema, sep=";", glob="*.csv")
    return with_audit(df, period_col="_extract_week").select(*ORDER_COLS, "_extract_week")


@proof(
    "ingest_csv_infer",
    f"""WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders)
        SELECT o_orderkey, nullif(code, '') AS code, price FROM d""",
    ("S-04",),
)
def q_ingest_csv_infer(spark: SparkSession, d: str) -> DataFrame:
    """Inference fallback: numbers inferred, the code column protected as string (leading zeros kept)."""
    root = scratch_path(spark, "landing-infer")
    raw_orders(spark, d).select("o_orderkey", "code", "price").write.option("header", True).csv(root)
    df = read_csv(spark, root, infer=True, string_cols=["code"], provenance=False)
    return df.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "code", F.col("price").cast("double").alias("price"))


@proof("ingest_json_batch", "SELECT * FROM events", ("S-05", "S-13"))
def q_ingest_json_batch(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "landing-events-json")
    ev = table(spark, d, "events")
    ev.withColumn("day", F.to_date("ts")).repartition("day").write.options(**TEXT_WRITE_OPTIONS).partitionBy("day").json(root)
    return read_json(spark, root, C.EVENTS.schema, provenance=False)


@proof(
    "ingest_json_nested",
    """SELECT max(ts) OVER (PARTITION BY CAST(ts AS DATE), event_id // 16) AS pull_ts,
              event_id, ts, user_id, event_type, value FROM events""",
    ("S-05", "L-05", "C-07"),
)
def q_ingest_json_nested(spark: SparkSession, d: str) -> DataFrame:
    """Nested envelopes written as JSON, read back with a declared nested schema, flattened."""

    root = scratch_path(spark, "landing-envelopes")
    event_envelopes(spark, d).write.options(**TEXT_WRITE_OPTIONS).partitionBy("day").json(root)
    env = read_json(spark, root, C.EVENT_ENVELOPE, provenance=False)
    return flatten_envelope(env, "records", keep=["pull_ts"])


@proof(
    "scan_parquet",
    "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'",
    ("S-06", "S-08"),
)
def q_scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return read_parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_extendedprice"], F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))


@proof(
    "preview_raw",
    """SELECT CAST(o.o_orderkey AS VARCHAR) AS o_orderkey, CAST(o.o_custkey AS VARCHAR) AS o_custkey, o.o_orderstatus
       FROM orders o ORDER BY o.o_orderkey LIMIT 20""",
    ("S-07", "O-03"),
)
def q_preview_raw(spark: SparkSession, d: str) -> DataFrame:
    """First 20 lines of one delivered file, as text (no inference).

    The table is landed as key-ordered files (range partitions); the preview
    opens the first file of the delivery.
    """
    root = scratch_path(spark, "landing-preview")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    o.orderBy("o_orderkey").write.option("header", True).csv(root)
    first = list_files(spark, root, "*.csv").agg(F.min("path").alias("p")).first()["p"]
    return preview_raw(spark, first, 20)


@proof(
    "provenance_files",
    f"SELECT {WEEK_SQL} AS folder_week, count(*) AS n_rows, true AS same_week FROM orders GROUP BY 1",
    ("S-12", "P-02"),
)
def q_provenance_files(spark: SparkSession, d: str) -> DataFrame:
    """Every row is traced to the file it came from: rows per week folder of ``_source_file``,
    and each row's own date falls in the week its file path names."""
    root = scratch_path(spark, "landing-prov")
    land_weekly_csv(table(spark, d, "orders"), root)
    df = read_csv(spark, root, C.ORDERS.schema, sep=";", glob="*.csv")
    folder = path_period("_source_file")
    return df.groupBy(folder.alias("folder_week")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(iso_week("o_orderdate") == folder).alias("same_week")
    )


# --------------------------------------------------------------------------- streams (S-01, S-02, S-14)


def _stream_orders(spark: SparkSession, landing: str, target: str, ckpt: str) -> None:
    ingest_stream(
        spark,
        landing,
        target,
        ckpt,
        "csv",
        C.ORDERS.schema,
        {"sep": ";", "header": "true"},
        transform=lambda df: df.withColumn("_extract_week", path_period("_source_file")),
        glob="*.csv",
        max_files_per_trigger=200,
    )


@proof("ingest_csv_stream", _orders_with_week_sql(), ("S-01", "K-01", "K-03", "P-01", "C-03", "G-01"))
def q_ingest_csv_stream(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_path(spark, "stream-orders")
    land_weekly_csv(table(spark, d, "orders"), f"{base}/landing")
    _stream_orders(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt")
    return spark.read.parquet(f"{base}/bronze").select(*ORDER_COLS, "_extract_week")


@proof("ingest_rerun_idempotent", _orders_with_week_sql(), ("S-14", "K-06"))
def q_ingest_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Second run on the same checkpoint with no new files adds nothing."""
    base = scratch_path(spark, "stream-rerun")
    land_weekly_csv(table(spark, d, "orders"), f"{base}/landing")
    for _ in range(2):
        _stream_orders(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt")
    return spark.read.parquet(f"{base}/bronze").select(*ORDER_COLS, "_extract_week")


@proof("ingest_late_file", _orders_with_week_sql(), ("S-14",))
def q_ingest_late_file(spark: SparkSession, d: str) -> DataFrame:
    """Files arriving after a first run are picked up by the next run, and only they."""
    base = scratch_path(spark, "stream-late")
    orders = table(spark, d, "orders")
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    land_weekly_csv(orders.filter(F.col("o_orderdate") < cut), f"{base}/landing")
    _stream_orders(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt")
    land_weekly_csv(orders.filter(F.col("o_orderdate") >= cut), f"{base}/landing", mode="append")
    _stream_orders(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt")
    return spark.read.parquet(f"{base}/bronze").select(*ORDER_COLS, "_extract_week")


@proof(
    "ingest_json_stream",
    """SELECT max(ts) OVER (PARTITION BY CAST(ts AS DATE), event_id // 16) AS pull_ts,
              event_id, ts, user_id, event_type, value FROM events""",
    ("S-02", "L-05", "G-02", "K-01"),
)
def q_ingest_json_stream(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_path(spark, "stream-envelopes")
    event_envelopes(spark, d).write.options(**TEXT_WRITE_OPTIONS).partitionBy("day").json(f"{base}/landing")

    def explode(df: DataFrame) -> DataFrame:
        return flatten_envelope(df, "records", keep=("pull_ts", "_ingested_at", "_source_file"))

    ingest_stream(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", "json", C.EVENT_ENVELOPE, transform=explode, glob="*.json")
    return spark.read.parquet(f"{base}/bronze").select("pull_ts", "event_id", "ts", "user_id", "event_type", "value")


# --------------------------------------------------------------------------- drift + rescue (S-03, S-09, S-10, S-11)


def land_drifting_orders(spark: SparkSession, d: str, root: str) -> None:
    """v1 extracts (no priority column) before the cut week, v2 after it with a new column and
    a different column order."""
    orders = table(spark, d, "orders")
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    v1 = orders.filter(F.col("o_orderdate") < cut).select(*C.ORDERS_V1.fieldNames())
    v2 = orders.filter(F.col("o_orderdate") >= cut).select(
        "o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus"
    )
    land_weekly_csv(v1, root, sep=",")
    land_weekly_csv(v2, root, sep=",", mode="append")


DRIFT_SQL = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate >= TIMESTAMP '{DRIFT_CUT}' THEN o_orderpriority END AS o_orderpriority,
       {WEEK_SQL} AS _extract_week, CAST(NULL AS VARCHAR) AS _rescued_data
FROM orders"""


def _drift_ingest(spark: SparkSession, d: str, files: int | None = 100) -> str:
    base = scratch_path(spark, "stream-drift")
    land_drifting_orders(spark, d, f"{base}/landing")
    ingest_drifting_csv(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", C.ORDERS_V1, f"{base}/_schema_log", max_files_per_trigger=files
    )
    return base


@proof("ingest_csv_drift", DRIFT_SQL, ("S-03", "S-10", "K-02", "G-03"))
def q_ingest_csv_drift(spark: SparkSession, d: str) -> DataFrame:
    base = _drift_ingest(spark, d)
    return read_batches(spark, f"{base}/bronze").select(*C.ORDERS_V1.fieldNames(), "o_orderpriority", "_extract_week", "_rescued_data")


@proof(
    "drift_added_columns",
    f"SELECT DISTINCT 'o_orderpriority' AS column_name FROM orders WHERE o_orderdate >= TIMESTAMP '{DRIFT_CUT}'",
    ("E-08", "S-09", "S-10"),
)
def q_drift_added(spark: SparkSession, d: str) -> DataFrame:
    base = _drift_ingest(spark, d)
    return added_columns(SchemaLog(spark, f"{base}/_schema_log")).select("column_name")


@proof(
    "drift_added_one_batch",
    f"SELECT DISTINCT 'o_orderpriority' AS column_name FROM orders WHERE o_orderdate >= TIMESTAMP '{DRIFT_CUT}'",
    ("E-08", "S-09", "S-10"),
)
def q_drift_added_one_batch(spark: SparkSession, d: str) -> DataFrame:
    """Both header versions in one micro-batch: the log must be the same."""
    base = _drift_ingest(spark, d, files=None)
    return added_columns(SchemaLog(spark, f"{base}/_schema_log")).select("column_name")


@proof(
    "schema_versions",
    f"""SELECT 1 AS version, '' AS added
        UNION ALL SELECT DISTINCT 2, 'o_orderpriority' FROM orders WHERE o_orderdate >= TIMESTAMP '{DRIFT_CUT}'""",
    ("S-09",),
)
def q_schema_versions(spark: SparkSession, d: str) -> DataFrame:
    base = _drift_ingest(spark, d)
    return SchemaLog(spark, f"{base}/_schema_log").versions().select("version", F.array_join("added", ",").alias("added"))


@proof(
    "rescue_bad_fields",
    """SELECT o_orderkey,
              CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
              o_orderdate,
              CASE WHEN o_orderkey % 97 = 0 THEN '{"o_totalprice":"n/a"}' END AS _rescued_data
       FROM orders""",
    ("S-11",),
)
def q_rescue(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "landing-rescue")
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderdate",
    )
    land_weekly_csv(o, root, sep=",")
    # All files have one header here, so the folder is read as it is and no path is listed.
    names = probe_headers(spark, [list_files(spark, root, "*.csv").agg(F.min("path").alias("p")).first()["p"]])
    raw, _ = read_csv_drifting(spark, [root], ",", headers={root: next(iter(names.values()))}, recursive=True)
    contract = C.schema(("o_orderkey", C.L), ("o_totalprice", C.D), ("o_orderdate", C.NTZ))
    return cast_with_rescue(raw, contract).select("o_orderkey", "o_totalprice", "o_orderdate", "_rescued_data")


# --------------------------------------------------------------------------- sinks (K-04, K-05, K-08, X-03)


@proof(
    "publish_overwrite",
    "SELECT o_orderkey, upper(o_orderstatus) AS o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
    ("K-04", "K-05", "K-07"),
)
def q_publish(spark: SparkSession, d: str) -> DataFrame:
    """Publish a table, then replace it by a query over *itself* (no overwrite-while-reading)."""
    base = scratch_path(spark, "warehouse")
    name = f"gridlake_proofs.orders_{uuid.uuid4().hex[:8]}"
    publish(table(spark, d, "orders").select("o_orderkey", F.lower("o_orderstatus").alias("o_orderstatus"), "o_totalprice"), name, base)
    current = spark.table(name)
    publish(current.filter(F.col("o_orderstatus") != "p").withColumn("o_orderstatus", F.upper("o_orderstatus")), name, base)
    return spark.table(name)


@proof(
    "publish_schema_change",
    "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_regionkey FROM nation",
    ("K-04", "K-05"),
)
def q_publish_schema_change(spark: SparkSession, d: str) -> DataFrame:
    """Republish with an added, a dropped and a retyped column: the table shows the new columns."""
    base = scratch_path(spark, "warehouse")
    name = f"gridlake_proofs.nation_{uuid.uuid4().hex[:8]}"
    nation = table(spark, d, "nation")
    publish(nation.select("n_nationkey", "n_name"), name, base)
    publish(nation.select(F.col("n_nationkey").cast("string").alias("n_nationkey"), "n_regionkey"), name, base)
    return spark.table(name)


@proof(
    "optimize_partitioned",
    "SELECT o_orderkey, o_orderstatus, true AS new_version FROM orders",
    ("M-02", "X-06"),
)
def q_optimize_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """After ``optimize`` a partitioned table serves the new version's files, still partitioned."""
    base = scratch_path(spark, "warehouse")
    name = f"gridlake_proofs.parts_{uuid.uuid4().hex[:8]}"
    publish(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), name, base, partition_by=["o_orderstatus"])
    path = optimize(spark, name, base)
    new = F.col("_metadata.file_path").contains(path.rsplit("/", 1)[-1])
    return spark.table(name).select("o_orderkey", "o_orderstatus", new.alias("new_version"))


@proof("route_write_rerun", "SELECT o_orderkey, false AS quarantined FROM orders", ("K-08", "G-07"))
def q_route_write_rerun(spark: SparkSession, d: str) -> DataFrame:
    """A second run without bad rows leaves none of the first run's in quarantine."""
    path = f"{scratch_path(spark, 'routed')}/t"
    rows = table(spark, d, "orders").select("o_orderkey", F.array().cast("array<string>").alias("_dq_reasons"))
    route_write(rows.withColumn("_quarantined", F.col("o_orderkey") % 3 == 0), path)
    good, bad = route_write(rows.withColumn("_quarantined", F.lit(False)), path)
    return good.select("o_orderkey", F.lit(False).alias("quarantined")).unionByName(bad.select("o_orderkey", F.lit(True).alias("quarantined")))


@proof(
    "route_write",
    SILVER_SQL + "SELECT o_orderkey, reasons <> '' AS quarantined FROM s",
    ("K-08", "L-03", "G-07"),
)
def q_route_write(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "silver-orders")
    good, bad = route_write(silver_flagged(raw_orders(spark, d), SILVER_SPEC), path)
    g = good.select("o_orderkey", F.lit(False).alias("quarantined"))
    b = bad.select("o_orderkey", F.lit(True).alias("quarantined"))
    return g.unionByName(b)


@proof(
    "replace_period",
    """SELECT o_orderkey,
              CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
              CAST(year(o_orderdate) AS BIGINT) AS period
       FROM orders""",
    ("X-03",),
)
def q_replace_period(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "by-year")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("period"))
    o.write.partitionBy("period").parquet(path)
    redelivered = o.filter(F.col("period") == 1996).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_periods(redelivered, path, "period")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("period").cast("long").alias("period"))


@proof(
    "ingest_parallel_arrays",
    """SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS pos, embedding[i] AS v
       FROM embeddings, unnest(generate_series(1, len(embedding))) AS t(i)""",
    ("G-05", "S-05", "L-04", "C-08", "P-05"),
)
def q_ingest_parallel_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Weather-like documents: a struct of two parallel arrays, landed as JSON, read with a
    declared nested schema and zipped back to one row per index."""
    from pyspark.sql import types as T

    from gridlake.operators.flatten import flatten_parallel_arrays

    root = scratch_path(spark, "landing-arrays")
    emb = table(spark, d, "embeddings")
    doc = emb.select("vec_id", "label", F.struct(F.sequence(F.lit(0), F.size("embedding") - 1).alias("idx"), F.col("embedding").alias("values")).alias("series"))
    doc.write.json(root)
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("label", T.IntegerType()),
            T.StructField("series", T.StructType([T.StructField("idx", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.FloatType()))])),
        ]
    )
    raw = read_json(spark, root, schema, provenance=False)
    return flatten_parallel_arrays(raw, ["series.idx", "series.values"], keep=["vec_id", "label"], names=["pos", "v"])


@proof(
    "silver_latest_pull",
    """WITH b AS (SELECT max(ts) OVER (PARTITION BY CAST(ts AS DATE), event_id // 16) AS pull_ts, * FROM events)
       SELECT event_type, hour, event_id, value, pull_ts FROM (
         SELECT *, date_trunc('hour', ts) AS hour,
                row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY pull_ts DESC, event_id DESC) AS rn
         FROM b) WHERE rn = 1""",
    ("G-06", "L-01", "W-01"),
)
def q_silver_latest_pull(spark: SparkSession, d: str) -> DataFrame:
    """Silver grid: API bronze (exploded pulls) → latest pull per (entity, instant)."""
    from gridlake.operators.dedup import latest_per_key

    bronze = flatten_envelope(event_envelopes(spark, d), "records", keep=["pull_ts"]).withColumn(
        "hour", trunc_wall("ts", "hour")
    )
    latest = latest_per_key(bronze, ["event_type", "hour"], ["pull_ts"], ["event_id"])
    return latest.select("event_type", "hour", "event_id", "value", "pull_ts")
