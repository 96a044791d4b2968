"""Streams whose deliveries change: typed new columns (CSV) and new fields (JSON), nothing lost (S-02, S-09, S-10, S-11).

Both drain new files into ``ingest_batch=<id>`` folders (a retried batch replaces its own). Contract columns are
typed, values that don't fit stand in ``_rescued_data``; columns outside the contract are stored as text and read as
the narrowest type that holds all their values so far (``sources.typing``). ``read_evolved`` gives the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.sinks import BATCH_COL, write_batch
from gridlake.sources.batch import INGESTED_AT, SOURCE_FILE, with_audit
from gridlake.sources.drift import CORRUPT, probe_headers, read_csv_drifting
from gridlake.sources.rescue import RESCUED, cast_with_rescue
from gridlake.sources.typing import TypeLog, narrowest_types, stored_schema, typed_view
from gridlake.streaming.ingest import MAX_FILES_PER_TRIGGER, discover_files, run_until_drained

#: Columns that ingestion adds.
AUDIT = T.StructType(
    [
        T.StructField(RESCUED, T.StringType()),
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(INGESTED_AT, T.TimestampType()),
    ]
)


def read_evolved(spark: SparkSession, target: str, contract: T.StructType, log: TypeLog) -> DataFrame:
    """All batches under the schema that contract and log give: no footer is opened to find it."""
    schema = T.StructType([*stored_schema(contract, log, AUDIT).fields, T.StructField(BATCH_COL, T.LongType())])
    return typed_view(spark.read.schema(schema).parquet(target), log)


def _drain(files: DataFrame, batch, checkpoint_dir: str) -> None:
    run_until_drained(lambda: files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def ingest_evolving_csv(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    contract: T.StructType,
    type_log_dir: str,
    sep: str = ",",
    glob: str = "*.csv",
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> TypeLog:
    """CSV deliveries with headers of their own; returns the log of drifted columns."""
    log = TypeLog(spark, type_log_dir)

    def batch(paths_df: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in paths_df.collect())  # bounded by max_files_per_trigger
        headers = probe_headers(spark, paths, sep)
        paths = [p for p in paths if headers[p]]
        if not paths:
            return
        raw, _ = read_csv_drifting(spark, paths, sep, headers=headers)
        own = {*contract.fieldNames(), SOURCE_FILE, CORRUPT}
        log.record(batch_id, narrowest_types(raw, [c for c in raw.columns if c not in own]))
        typed = cast_with_rescue(raw, contract, keep=(SOURCE_FILE,))
        write_batch(with_audit(typed, source_col=SOURCE_FILE), target_dir, batch_id)

    _drain(discover_files(spark, source_dir, glob, max_files_per_trigger), batch, checkpoint_dir)
    return log


def _path(name: str) -> str:
    return '$["' + name.replace("\\", "\\\\").replace('"', '\\"') + '"]'


def _found_fields(rows: DataFrame, contract: T.StructType) -> dict[str, str | None]:
    """Top-level fields of a batch's objects outside the contract, with types of the lattice."""
    ddl = rows.filter("v is not null and schema_of_variant(v) like 'OBJECT<%'").agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if ddl is None or not ddl.startswith("OBJECT<"):
        return {}
    names = {
        T.LongType: "bigint", T.DoubleType: "double", T.FloatType: "double", T.DecimalType: "double", T.BooleanType: "boolean",
        T.DateType: "date", T.TimestampNTZType: "timestamp_ntz", T.NullType: None,
    }
    fields = T.StructType.fromDDL("s " + ddl.replace("OBJECT<", "STRUCT<"))[0].dataType.fields
    return {f.name: names.get(type(f.dataType), "string") for f in fields if f.name not in contract.fieldNames()}


def _json_columns(contract: T.StructType, new: list[str]) -> list[Column]:
    """Typed contract fields, new fields as text, and what doesn't fit as JSON."""
    v, cols, entries = F.col("v"), [], []
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT<"), F.lit(False))
    for f in contract.fields:
        raw = F.try_variant_get(v, _path(f.name), "variant")
        there = raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(False))
        typed = F.try_variant_get(v, _path(f.name), f.dataType.simpleString())
        if isinstance(f.dataType, T.TimestampNTZType):  # variants hold times as text here
            typed = F.try_variant_get(v, _path(f.name), "string").try_cast("timestamp_ntz")
        cols.append(typed.alias(f.name))
        entries += [F.lit(f.name), F.when(there & typed.isNull(), F.try_variant_get(v, _path(f.name), "string"))]
    cols += [F.coalesce(F.try_variant_get(v, _path(c), "string"), F.to_json(F.try_variant_get(v, _path(c), "variant"))).alias(c) for c in new]
    # a line that isn't an object is kept whole
    entries += [F.lit("_line"), F.when(~is_object, F.col("value"))]
    kept = F.map_filter(F.create_map(*entries), lambda k, x: x.isNotNull())
    return [*cols, F.when(F.size(kept) > 0, F.to_json(kept)).alias(RESCUED)]


def ingest_evolving_json(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    contract: T.StructType,
    type_log_dir: str,
    whole_files: bool = False,
    glob: str = "*.json",
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> TypeLog:
    """JSON objects (one a line, or one a file with ``whole_files``) as VARIANT: every field of every line lands in a
    column or in ``_rescued_data``; returns the log of fields outside the contract."""
    log = TypeLog(spark, type_log_dir)
    lines = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .text(source_dir, wholetext=whole_files)
        .select("value", F.col("_metadata.file_path").alias(SOURCE_FILE), F.try_parse_json("value").alias("v"))
        .filter(F.trim("value") != "")
    )

    def batch(rows: DataFrame, batch_id: int) -> None:
        log.record(batch_id, _found_fields(rows, contract))
        out = rows.select(*_json_columns(contract, list(log.current())), SOURCE_FILE)
        write_batch(with_audit(out, source_col=SOURCE_FILE), target_dir, batch_id)

    _drain(lines, batch, checkpoint_dir)
    return log
