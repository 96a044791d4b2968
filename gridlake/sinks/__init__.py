"""Sinks and publication (K-01 … K-08, X-03) for plain Parquet tables.

No transactional table format is assumed, so:
* a full refresh writes a **new version folder** and then points the catalog
  table at it (readers of the old version are never overwritten under them);
* a micro-batch writes its own ``ingest_batch=<id>`` folder in overwrite mode,
  so a retried batch replaces its earlier attempt (exactly-once by idempotence);
* a two-way routed output (good / quarantine) is **one** job writing one
  dataset partitioned by the flag.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.quarantine import QUARANTINED, REASONS

BATCH_COL = "ingest_batch"


def ensure_schema(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (K-07)."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def new_version_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name.replace('.', '/')}/v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"


def publish(
    df: DataFrame,
    name: str,
    base: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> str:
    """Full-refresh publish (K-04/K-05, CTAS equivalent): write a new version, swap the table location.

    Safe when ``df`` reads the table being replaced (the old files stay until
    the swap). A partitioned table, or one whose columns, types or partitioning
    change, gets its definition recreated on the new version (partitions
    recovered). Returns the version path.
    """
    spark = df.sparkSession
    path = new_version_path(base, name)
    out = df.coalesce(files) if files else df
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if "." in name:
        ensure_schema(spark, name.split(".")[0])
    exists = spark.catalog.tableExists(name)
    if exists and not partition_by and _same_columns(spark, name, df):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {name}")
        return path
    if exists:
        # Partition entries keep their own folders, and a definition keeps its columns:
        # for these a swap of the location would serve the old ones. Recreate the (external) definition.
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return path


def _same_columns(spark: SparkSession, name: str, df: DataFrame) -> bool:
    """Whether the table is unpartitioned and has exactly the columns and types of ``df``."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        return False
    plain = lambda s: [(f.name, f.dataType.simpleString()) for f in s.fields]
    return plain(spark.table(name).schema) == plain(df.schema)


def write_batch(df: DataFrame, target: str, batch_id: int) -> str:
    """Idempotent micro-batch output: ``target/ingest_batch=<id>`` overwritten on retry."""
    path = f"{target.rstrip('/')}/{BATCH_COL}={int(batch_id)}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """All micro-batch outputs, schemas merged (K-02), with the ``ingest_batch`` column."""
    return spark.read.option("mergeSchema", True).parquet(target)


def route_write(flagged: DataFrame, path: str, flag_col: str = QUARANTINED) -> tuple[DataFrame, DataFrame]:
    """Write good and quarantined rows in **one** job (K-08): a dataset partitioned by the flag.

    Returns (good, quarantine) as DataFrames reading the written dataset: the
    flag filter prunes to one folder, and the declared schema makes a side
    with no rows (no folder) read as empty instead of failing. The upstream
    plan (dedup shuffle included) runs once, and nothing is cached on
    executors.
    """
    # Folders starting with "_" are hidden from Spark's partition discovery.
    part = flag_col.lstrip("_") or "quarantined"
    routed = flagged.withColumnRenamed(flag_col, part)
    # Static: a side without rows must not keep the rows of an earlier run, whatever the session says.
    routed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(part).parquet(path)
    data_cols = [f for f in routed.schema.fields if f.name != part]
    schema = T.StructType(data_cols + [T.StructField(part, T.BooleanType(), True)])
    stored = flagged.sparkSession.read.schema(schema).parquet(path)
    good = stored.filter(~F.col(part)).drop(part, REASONS)
    bad = stored.filter(F.col(part)).drop(part)
    return good, bad


def replace_periods(df: DataFrame, path: str, period_col: str) -> None:
    """Re-delivered periods replace the stored ones (X-03): dynamic partition overwrite,
    only the periods present in ``df`` are rewritten."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period_col)
        .parquet(path)
    )
