"""Proofs of ingestion that loses nothing (S-01, S-02, S-04, S-09, S-10, S-11, K-01, K-06): typed drift, JSON fields that appear,
rescue inside plain streams, catalog tables, a start that fails."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import contracts as C
from gridlake.operators.flatten import flatten_envelope
from gridlake.plans.proofs_ingest import DRIFT_CUT, ORDER_COLS, land_weekly_csv
from gridlake.plans.registry import proof
from gridlake.plans.tables import table
from gridlake.session import scratch_path
from gridlake.sinks import read_batches, write_batch
from gridlake.sources.batch import TEXT_WRITE_OPTIONS, read_json
from gridlake.streaming.evolving import ingest_evolving_csv, ingest_evolving_json, read_evolved
from gridlake.streaming.ingest import ingest_stream, run_until_drained

#: Second week from which the whole-number column has fractions (fixed value, a Monday).
WIDE_CUT = "1998-03-02"


def _land_typed_drift(spark: SparkSession, d: str, root: str) -> None:
    """Before the first cut no extra columns; then a whole number, a code with leading zeros, a date; after the second
    cut the number has fractions."""
    orders = table(spark, d, "orders")
    cut, wide = (F.lit(x).cast("timestamp_ntz") for x in (DRIFT_CUT, WIDE_CUT))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    units = F.when(F.col("o_orderdate") < wide, F.col("o_custkey").cast("string")).otherwise((F.col("o_custkey") + 0.5).cast("string"))
    extra = [units.alias("units"), F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("site"), day.alias("due")]
    v1 = orders.filter(F.col("o_orderdate") < cut).select(*C.ORDERS_V1.fieldNames())
    v2 = orders.filter(F.col("o_orderdate") >= cut).select(*extra, *C.ORDERS_V1.fieldNames())
    land_weekly_csv(v1, root, sep=",")
    land_weekly_csv(v2, root, sep=",", mode="append")


_TYPED_SQL = f"""SELECT o_orderkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '{WIDE_CUT}' THEN o_custkey + 0.5::DOUBLE WHEN o_orderdate >= TIMESTAMP '{DRIFT_CUT}' THEN o_custkey::DOUBLE END AS units,
       CASE WHEN o_orderdate >= TIMESTAMP '{DRIFT_CUT}' THEN lpad(o_custkey::VARCHAR, 9, '0') END AS site,
       CASE WHEN o_orderdate >= TIMESTAMP '{DRIFT_CUT}' THEN o_orderdate::DATE END AS due
FROM orders"""


def _typed_drift(spark: SparkSession, d: str, files: int) -> DataFrame:
    base = scratch_path(spark, "typed-drift")
    _land_typed_drift(spark, d, f"{base}/landing")
    log = ingest_evolving_csv(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", C.ORDERS_V1, f"{base}/_types", max_files_per_trigger=files)
    return read_evolved(spark, f"{base}/bronze", C.ORDERS_V1, log).select("o_orderkey", "o_orderstatus", "o_totalprice", "units", "site", "due")


@proof("drift_typed_columns", _TYPED_SQL, ("S-09", "S-10"))
def q_typed_drift(spark: SparkSession, d: str) -> DataFrame:
    """New columns get types from their values; a whole-number column widens when fractions arrive, for old rows too."""
    return _typed_drift(spark, d, 100)


@proof("drift_typed_one_batch", _TYPED_SQL, ("S-09", "S-10"))
def q_typed_drift_one_batch(spark: SparkSession, d: str) -> DataFrame:
    """All files in one micro-batch: the same columns, types and values."""
    return _typed_drift(spark, d, 100_000)


@proof(
    "ingest_json_evolving",
    """SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 50 = 7 THEN NULL ELSE value END AS value,
              CASE WHEN event_id % 2 = 1 THEN event_id * 2 END AS score,
              CASE WHEN event_id % 50 = 7 THEN '{"value":"n/a"}' END AS _rescued_data
       FROM events
       UNION ALL
       SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{"_line":"broken ' || event_id || '"}' FROM events WHERE event_id % 100 = 3""",
    ("S-02", "S-10", "S-11"),
)
def q_json_evolving(spark: SparkSession, d: str) -> DataFrame:
    """A second delivery has a new field, values of a wrong type and lines that aren't JSON: a column, rescued
    values, rescued lines."""
    base = scratch_path(spark, "json-evolving")
    ev = table(spark, d, "events").select(*C.EVENT_RECORD.fieldNames())
    first, second = ev.filter("event_id % 2 = 0"), ev.filter("event_id % 2 = 1")
    first.write.options(**TEXT_WRITE_OPTIONS).json(f"{base}/landing/1")

    def drain():
        return ingest_evolving_json(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", C.EVENT_RECORD, f"{base}/_types", glob="part-*")

    drain()
    bad = F.col("event_id") % 50 == 7
    record = F.struct(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type",
        F.when(bad, F.lit("n/a")).alias("value_text"), F.when(~bad, F.col("value")).alias("value"), (F.col("event_id") * 2).alias("score"),
    )
    lines = second.select(F.replace(F.to_json(record), F.lit("value_text"), F.lit("value")).alias("value"))
    broken = second.filter("event_id % 100 = 3").select(F.concat(F.lit("broken "), F.col("event_id").cast("string")).alias("value"))
    lines.unionByName(broken).write.text(f"{base}/landing/2")
    out = read_evolved(spark, f"{base}/bronze", C.EVENT_RECORD, drain())
    return out.select("event_id", "ts", "user_id", "event_type", "value", "score", "_rescued_data")


_RESCUE_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 90 = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 40 = 0 THEN '{"o_custkey":"cust?"}'
            WHEN o_orderkey % 90 = 1 THEN '{"_line":"' || o_orderkey || ';' || o_custkey || '"}' END AS _rescued_data
FROM orders"""


def _land_bad_lines(spark: SparkSession, d: str, root: str, which: str = "true") -> None:
    """Lines with a customer that is no number, and lines that end after two fields."""
    o = table(spark, d, "orders").filter(which)
    cust = F.when(F.col("o_orderkey") % 40 == 0, F.lit("cust?")).otherwise(F.col("o_custkey").cast("string"))
    two = F.concat_ws(";", F.col("o_orderkey").cast("string"), cust)
    line = F.when((F.col("o_orderkey") % 90 == 1) & (F.col("o_orderkey") % 40 != 0), two).otherwise(F.concat_ws(";", two, "o_orderstatus"))
    o.select(line.alias("value")).write.text(root)


_BAD_CONTRACT = C.schema(("o_orderkey", C.L), ("o_custkey", C.L), ("o_orderstatus", C.S))


@proof("ingest_csv_stream_rescue", _RESCUE_SQL, ("S-01", "S-04", "S-11"))
def q_csv_stream_rescue(spark: SparkSession, d: str) -> DataFrame:
    """A plain CSV stream with bad numbers and short lines: every line lands, what doesn't fit is kept beside it."""
    base = scratch_path(spark, "stream-rescue")
    _land_bad_lines(spark, d, f"{base}/landing")
    ingest_stream(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", "csv", _BAD_CONTRACT, {"sep": ";", "header": "false"}, rescue=True)
    return spark.read.parquet(f"{base}/bronze").select("o_orderkey", "o_custkey", "o_orderstatus", "_rescued_data")


@proof(
    "rescue_conservation",
    """SELECT count(*) AS lines, count(*) FILTER (o_orderkey % 40 <> 0 AND o_orderkey % 90 <> 1) AS good,
              count(*) FILTER (o_orderkey % 40 = 0 OR o_orderkey % 90 = 1) AS rescued FROM orders""",
    ("S-01", "S-11", "DQ-01"),
)
def q_rescue_conservation(spark: SparkSession, d: str) -> DataFrame:
    """Lines delivered = good rows + rescued rows."""
    base = scratch_path(spark, "stream-conservation")
    _land_bad_lines(spark, d, f"{base}/landing")
    ingest_stream(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", "csv", _BAD_CONTRACT, {"sep": ";", "header": "false"}, rescue=True)
    delivered = spark.read.text(f"{base}/landing").select(F.lit("line").alias("kind"))
    rescued = F.when(F.col("_rescued_data").isNotNull(), F.lit("rescued")).otherwise(F.lit("good"))
    kinds = delivered.unionByName(spark.read.parquet(f"{base}/bronze").select(rescued.alias("kind")))
    own = lambda k: F.count_if(F.col("kind") == k)
    return kinds.agg(own("line").alias("lines"), own("good").alias("good"), own("rescued").alias("rescued"))


@proof("catalog_stream_table", f"SELECT {', '.join(ORDER_COLS)} FROM orders", ("K-01", "S-14", "K-03"))
def q_catalog_stream(spark: SparkSession, d: str) -> DataFrame:
    """Two drains into a catalog table: each row once, read by the table's name."""
    base = scratch_path(spark, "stream-catalog")
    name = f"gridlake_proofs.bronze_{uuid.uuid4().hex[:8]}"
    orders = table(spark, d, "orders")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    for i, part in enumerate((orders.filter(F.col("o_orderdate") < cut), orders.filter(F.col("o_orderdate") >= cut))):
        land_weekly_csv(part, f"{base}/landing", mode="append" if i else "overwrite")
        for _ in range(2):  # a drain without new files adds nothing
            ingest_stream(
                spark, f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt", "csv", C.ORDERS.schema, {"sep": ";", "header": "true"}, glob="*.csv", table=name
            )
    return spark.table(name).select(*ORDER_COLS)


@proof("ingest_restart_after_failure", f"SELECT {', '.join(ORDER_COLS)}, 1 AS restarts FROM orders", ("K-06", "S-14"))
def q_restart(spark: SparkSession, d: str) -> DataFrame:
    """The first start fails after a batch is written and before it is committed; the restart repeats that batch, and each row
    stands once. Another error than the expected one isn't retried (tests)."""
    base = scratch_path(spark, "stream-restart")
    land_weekly_csv(table(spark, d, "orders"), f"{base}/landing")
    stream = spark.readStream.schema(C.ORDERS.schema).option("sep", ";").option("header", True).option("enforceSchema", False)
    rows = stream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", 100).csv(f"{base}/landing")
    failures = []

    def batch(df: DataFrame, batch_id: int) -> None:
        write_batch(df, f"{base}/bronze", batch_id)
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("planned failure")

    def start():
        return rows.writeStream.foreachBatch(batch).option("checkpointLocation", f"{base}/_ckpt").trigger(availableNow=True).start()

    run_until_drained(start, retries=1, retry_on=lambda e: "planned failure" in str(e))
    return read_batches(spark, f"{base}/bronze").select(*ORDER_COLS, F.lit(len(failures)).alias("restarts"))


#: Events of one document.
_DOCUMENT = 4096


@proof("ingest_json_multiline", "SELECT event_id, ts, user_id, event_type, value FROM events", ("S-05", "S-13", "L-05"))
def q_json_multiline(spark: SparkSession, d: str) -> DataFrame:
    """One indented document a file, of many lines, in a folder tree: read whole, its records as rows."""
    root = scratch_path(spark, "landing-multiline")
    ev = table(spark, d, "events").select(*C.EVENT_RECORD.fieldNames(), F.floor(F.col("event_id") / _DOCUMENT).alias("part"))
    records = F.collect_list(F.struct(*C.EVENT_RECORD.fieldNames())).alias("records")  # at most _DOCUMENT of them
    documents = ev.groupBy("part").agg(records)
    text = F.to_json(F.struct("records"), TEXT_WRITE_OPTIONS | {"pretty": "true"}).alias("value")
    documents.select("part", text).repartition("part").write.partitionBy("part").text(root)
    schema = T.StructType([T.StructField("records", T.ArrayType(C.EVENT_RECORD))])
    return flatten_envelope(read_json(spark, root, schema, multiline=True, provenance=False), "records")
