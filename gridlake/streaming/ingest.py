"""Incremental file ingestion with Structured Streaming (S-01, S-02, S-03, S-14, K-01, K-03, K-06).

* Fixed-schema CSV / JSON: the file source + Parquet file sink. Both sides are
  tracked in the checkpoint (offsets, commits, sink log), so each file is
  ingested exactly once and a re-run with no new files adds nothing.
* Drifting CSV: the stream only *discovers* files (``binaryFile`` projected to
  ``path`` — content is not read by the source); ``foreachBatch`` reads the
  batch's files grouped by header, types them against the contract with
  rescue, and overwrites its own ``ingest_batch=<id>`` folder.

Every run uses ``Trigger.AvailableNow`` and waits for completion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.sinks import ensure_schema, write_batch
from gridlake.sources.batch import INGESTED_AT, SOURCE_FILE, with_audit
from gridlake.sources.drift import SchemaLog, probe_headers, read_csv_drifting
from gridlake.sources.rescue import cast_with_rescue


#: Files of one micro-batch unless set otherwise: their names (and headers) reach the driver.
MAX_FILES_PER_TRIGGER = 10_000
CORRUPT = "_corrupt_record"

BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def run_until_drained(
    start: Callable[[], StreamingQuery],
    retries: int = 1,
    retry_on: Callable[[Exception], bool] = lambda e: False,
) -> StreamingQuery:
    """Start, wait for completion, restart up to ``retries`` times on the listed errors (K-06)."""
    attempt = 0
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except Exception as e:  # noqa: BLE001 - re-raised unless whitelisted
            if attempt < retries and retry_on(e):
                attempt += 1
                continue
            raise


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    fmt: str,
    schema: T.StructType,
    options: dict[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    audit: bool = True,
    partition_by: tuple[str, ...] = (),
    rescue: bool = False,
    table: str | None = None,
) -> None:
    """Drain new ``fmt`` files under ``source_dir`` into a Parquet table at ``target_dir``.

    ``rescue``: fields are read as text and typed in the stream; values that don't fit ``schema``, and lines with too few or
    too many fields, stand in ``_rescued_data`` (CSV and JSON with flat schemas), so rows in = rows out.
    ``table``: a catalog table, made on the first run with its files in ``target_dir``, instead of a bare folder (K-01).
    """
    read_as = schema
    if rescue:
        read_as = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema.fields), T.StructField(CORRUPT, T.StringType())])
    r = spark.readStream.format(fmt).schema(read_as).option("recursiveFileLookup", True)
    if rescue:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        # A header that doesn't name the schema's columns in order is an error, never a silent swap of values.
        r = r.option("enforceSchema", False)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(source_dir)
    if audit:
        df = with_audit(df)
    if rescue:
        df = cast_with_rescue(df, schema, keep=(INGESTED_AT, SOURCE_FILE) if audit else (), corrupt_col=CORRUPT)
    if transform is not None:
        df = transform(df)

    def start() -> StreamingQuery:
        w = df.writeStream.format("parquet").option("path", target_dir).option("checkpointLocation", checkpoint_dir)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w = w.trigger(availableNow=True)
        return w.toTable(table) if table else w.start()

    if table and "." in table:
        ensure_schema(spark, table.split(".")[0])
    run_until_drained(start)


def discover_files(spark: SparkSession, source_dir: str, glob: str, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming list of new file paths (no content read)."""
    r = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir).select("path")


def ingest_drifting_csv(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    contract: T.StructType,
    schema_log_dir: str,
    sep: str = ",",
    glob: str = "*.csv",
    period_pattern: str | None = r"(\d{4}-W\d{2})",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    rescue_unknown: bool = False,
) -> None:
    """Incremental ingest of CSV deliveries with header drift and rescue (G-03 bronze)."""
    log = SchemaLog(spark, schema_log_dir)
    log.load()  # known columns kept in memory for this run; batches run one at a time on the driver

    def batch(paths_df: DataFrame, batch_id: int) -> None:
        # Only file names reach the driver, bounded by maxFilesPerTrigger.
        paths = sorted(r["path"] for r in paths_df.collect())
        headers_by_file = probe_headers(spark, paths, sep)
        paths = [p for p in paths if headers_by_file[p]]  # zero-byte / header-less files carry no rows
        if not paths:
            return
        raw, headers = read_csv_drifting(spark, paths, sep, headers=headers_by_file)
        typed = cast_with_rescue(raw, contract, rescue_unknown=rescue_unknown, keep=(SOURCE_FILE,))
        out = with_audit(typed, source_col=SOURCE_FILE, period_col="_extract_week" if period_pattern else None, period_pattern=period_pattern or "")
        # One entry per header, in file order, against the contract: the log is the same for any batch size.
        log.record(batch_id, contract.fieldNames(), paths[0], contract.json())
        for header in headers:
            new_cols = [c for c in header if c not in contract.fieldNames() and c != "_corrupt_record"]
            first = next(p for p in paths if headers_by_file[p] == header)
            log.record(batch_id, contract.fieldNames() + new_cols, first, out.schema.json())
        write_batch(out, target_dir, batch_id)

    files = discover_files(spark, source_dir, glob, max_files_per_trigger)

    def start() -> StreamingQuery:
        return (
            files.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start()
        )

    run_until_drained(start)


def source_name(path_col: str = SOURCE_FILE, depth_from_end: int = 2):
    """Folder name ``depth_from_end`` levels above the file (e.g. the source under the landing root)."""
    parts = F.split(F.col(path_col), "/")
    return F.element_at(parts, -depth_from_end)
