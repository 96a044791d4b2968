"""Proofs for streaming latest-wins (T-01, T-02): the incremental result must equal the
full-refresh :func:`latest_per_key` over all rows.

``events`` stands in for grid API pulls: the key is (event type, hour) — the
event time is part of the key, like (region, instant) — and ``ts`` plays the
pull time. Events arrive as files of consecutive ids, several files per
trigger, so later batches revise keys written by earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.expressions import trunc_wall

from gridlake import contracts as C
from gridlake.plans.registry import proof
from gridlake.plans.tables import table
from gridlake.session import scratch_path
from gridlake.streaming.latest import latest_incremental, latest_stream_state

LATEST_SQL = """
SELECT event_type, hour, event_id, user_id, value FROM (
  SELECT *, date_trunc('hour', ts) AS hour,
         row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
"""


WAVES, FILES_PER_WAVE = 4, 3


def _land_event_files(spark: SparkSession, d: str, root: str, newest_first: bool = False) -> None:
    """Events arriving in ``WAVES`` time-ordered deliveries of ``FILES_PER_WAVE`` files each.

    Ids grow with time, so id ranges are time ranges; wave edges cut through
    hours, so later waves revise keys already written. Each wave is one
    append, so file modification times (the file source's order) follow time.
    """
    ev = table(spark, d, "events")
    bounds = ev.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"]) + 1
    step = max(1, -(-(hi - lo) // WAVES))
    for w in reversed(range(WAVES)) if newest_first else range(WAVES):
        a, b = lo + w * step, lo + (w + 1) * step
        part = ev.filter((F.col("event_id") >= a) & (F.col("event_id") < b))
        part.repartition(FILES_PER_WAVE).write.mode("append").parquet(root)


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", trunc_wall("ts", "hour")).withColumn("day", F.to_date("ts"))


@proof("latest_incremental", LATEST_SQL, ("T-01", "L-01"))
def q_latest_incremental(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_path(spark, "stream-latest")
    _land_event_files(spark, d, f"{base}/landing")
    stream = _keyed(spark.readStream.schema(C.EVENTS.schema).option("maxFilesPerTrigger", FILES_PER_WAVE).parquet(f"{base}/landing"))
    latest_incremental(stream, f"{base}/silver", f"{base}/_ckpt", ["event_type", "hour"], ["ts"], ["event_id"], "day")
    return spark.read.parquet(f"{base}/silver").select("event_type", "hour", "event_id", "user_id", "value")


@proof("latest_stream_state", LATEST_SQL, ("T-02",))
def q_latest_stream_state(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_path(spark, "stream-state")
    _land_event_files(spark, d, f"{base}/landing")
    stream = _keyed(spark.readStream.schema(C.EVENTS.schema).option("maxFilesPerTrigger", FILES_PER_WAVE).parquet(f"{base}/landing"))
    latest_stream_state(stream, f"{base}/silver", f"{base}/_ckpt", "hour", ["event_type"], ["ts", "event_id"], "day", delay="2 days")
    return spark.read.parquet(f"{base}/silver").select("event_type", "hour", "event_id", "user_id", "value")


@proof("latest_state_late", LATEST_SQL, ("T-02",))
def q_latest_state_late(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries in reverse order of time, far later than the default delay: no row is lost."""
    base = scratch_path(spark, "stream-late")
    _land_event_files(spark, d, f"{base}/landing", newest_first=True)
    stream = _keyed(spark.readStream.schema(C.EVENTS.schema).option("maxFilesPerTrigger", FILES_PER_WAVE).parquet(f"{base}/landing"))
    latest_stream_state(stream, f"{base}/silver", f"{base}/_ckpt", "hour", ["event_type"], ["ts", "event_id"], "day")
    return spark.read.parquet(f"{base}/silver").select("event_type", "hour", "event_id", "user_id", "value")
