"""Latest-wins on streams (T-01, T-02) and a lateness report (T-03).

T-01 ``upsert_latest``: each micro-batch touches some partitions of the silver
table (the partition column is derived from the event time, which is part of
the key). Only those partitions are read, unioned with the batch, reduced to
the latest row per key and rewritten with dynamic partition overwrite. The
result equals a full-refresh :func:`latest_per_key` over everything seen.

T-02 ``latest_stream_state``: when lateness is bounded, a watermarked
streaming aggregation keeps one state row per key (``max_by`` over the
ordering) and emits updated keys each trigger; the updates are upserted as in
T-01. State lives in the checkpoint, so it survives executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.expressions import trunc_wall
from gridlake.operators.dedup import latest_per_key
from gridlake.session import drop_path, path_exists, scratch_path
from gridlake.sinks import write_batch
from gridlake.streaming.ingest import run_until_drained


def upsert_latest(
    batch: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    tie_breakers: Sequence[str | Column] | None,
    partition_col: str,
) -> None:
    """Merge ``batch`` into the latest-per-key table at ``target`` (partitioned by ``partition_col``).

    The batch is evaluated once, into a scratch folder that is removed at the
    end. Touched partitions of the target are read, reduced together with the
    batch and replaced in one dynamic partition overwrite (new files are moved
    in at commit, after all reads). Columns that only one side has are kept,
    NULL on the other. A retried batch merges the same rows again and yields
    the same table (idempotent).
    """
    spark = batch.sparkSession
    stage = scratch_path(spark, "upsert-batch")
    batch.write.parquet(stage)
    staged = spark.read.schema(batch.schema).parquet(stage)
    # Partition pruning: the touched partition values (a handful per batch) become a literal
    # IN list — metadata, not data — so only those folders of the target are listed and read.
    touched = [r[0] for r in staged.select(partition_col).distinct().collect()]
    merged = staged
    if touched and path_exists(spark, target):
        values = [v for v in touched if v is not None]
        in_touched = F.col(partition_col).isin(values) if values else F.lit(False)
        if len(values) < len(touched):  # the NULL partition is touched too
            in_touched = in_touched | F.col(partition_col).isNull()
        existing = spark.read.option("mergeSchema", True).parquet(target).filter(in_touched)
        merged = existing.unionByName(staged, allowMissingColumns=True)
    if touched:
        latest = latest_per_key(merged, keys, order_by, tie_breakers)
        latest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(target)
    drop_path(spark, stage)


def latest_incremental(
    stream: DataFrame,
    target: str,
    checkpoint_dir: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    tie_breakers: Sequence[str | Column] | None,
    partition_col: str,
) -> None:
    """T-01: drain ``stream`` into ``target`` keeping the latest row per key."""

    def batch(df: DataFrame, batch_id: int) -> None:
        upsert_latest(df, target, keys, order_by, tie_breakers, partition_col)

    def start():
        return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()

    run_until_drained(start)


def latest_stream_state(
    stream: DataFrame,
    target: str,
    checkpoint_dir: str,
    event_time: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_col: str,
    delay: str = "7 hours",
    late_path: str | None = None,
) -> int:
    """T-02: watermark + one state row per (event time, key), latest by ``order_by``.

    ``event_time`` must be part of the key (as for a grid point ``(region,
    instant)``): state for a key is dropped once the watermark passes it.
    Rows later than ``delay``, which the state operator ignores, are not lost: a
    second query over the source writes them to ``late_path`` (default:
    ``<target>__late``, one folder per batch) and merges them into the target, so
    the table is the latest per key for any lateness. Returns the number of
    late rows stored so far.
    """
    payload = [c for c in stream.columns if c not in set(keys) | {event_time}]
    order = F.struct(*[F.col(c) for c in order_by])
    # Watermarks need a TIMESTAMP; a zone-free event time gets a TIMESTAMP twin for it.
    wm = "_event_ts"
    agg = (
        stream.withColumn(wm, F.col(event_time).cast("timestamp"))
        .withWatermark(wm, delay)
        .groupBy(wm, event_time, *keys)
        .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), order).alias("_latest"))
        .select(event_time, *keys, "_latest.*")
    )

    def batch(df: DataFrame, batch_id: int) -> None:
        upsert_latest(df, target, [event_time, *keys], list(order_by), None, partition_col)

    spark = stream.sparkSession
    late_path = late_path or f"{target.rstrip('/')}__late"
    marks = f"{checkpoint_dir.rstrip('/')}__marks"

    def late_batch(df: DataFrame, batch_id: int) -> None:
        """Rows at or before the watermark of the earlier batches, whose marks are kept per batch."""
        known = spark.read.schema("batch long, top timestamp").parquet(marks).filter(F.col("batch") < batch_id) if path_exists(spark, marks) else None
        top = known.agg(F.max("top")).first()[0] if known is not None else None
        stamped = df.withColumn(wm, F.col(event_time).cast("timestamp"))
        if top is not None:
            late = stamped.filter(F.col(wm) <= F.lit(top) - F.expr(f"INTERVAL {delay}")).drop(wm)
            write_batch(late, late_path, batch_id)
            stored = spark.read.schema(late.schema).parquet(f"{late_path}/ingest_batch={batch_id}")
            if not stored.isEmpty():
                upsert_latest(stored, target, [event_time, *keys], list(order_by), None, partition_col)
        mark = stamped.agg(F.lit(batch_id).cast("long").alias("batch"), F.max(wm).alias("top"))
        mark.write.mode("overwrite").parquet(f"{marks}/part_of={batch_id}")

    def start_late():
        return (
            stream.writeStream.foreachBatch(late_batch)
            .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}__late")
            .trigger(availableNow=True)
            .start()
        )

    def start():
        return (
            agg.writeStream.outputMode("update")
            .foreachBatch(batch)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start()
        )

    run_until_drained(start)
    run_until_drained(start_late)
    return spark.read.parquet(late_path).count() if path_exists(spark, late_path) else 0


def lateness_report(
    df: DataFrame,
    event_ts: str,
    arrival_ts: str,
    late_after_us: int = 30 * 60 * 1_000_000,
    unit: str = "hour",
) -> DataFrame:
    """T-03: per event-time bucket, rows, rows arriving later than the threshold, max lateness (µs)."""
    lag = F.timestamp_diff("MICROSECOND", F.col(event_ts), F.col(arrival_ts))
    return (
        df.select(trunc_wall(event_ts, unit).alias(unit), lag.alias("_lag"))
        .groupBy(unit)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("_lag") > late_after_us).alias("n_late"),
            F.max("_lag").alias("max_lateness_us"),
        )
    )
