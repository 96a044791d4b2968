"""Delimited files whose headers drift between deliveries (S-03, S-09, S-10).

Spark's CSV reader maps columns by *position* under one schema: a folder of
files with different headers either loses the new columns or silently puts
values in the wrong columns. Here files are grouped by their own header, each
group is read with a schema built from that header (so Spark maps by name),
and the groups are combined with ``unionByName(allowMissingColumns=True)``.
Columns absent from a file are NULL; new columns are added (and logged).

Header probing opens each *new* file on an executor and reads its first bytes, no more (``HEADER_BYTES``, doubled
until a line ends). File systems that pyarrow can't open are probed by a job over the text of the new files.
Either way only file names and header strings reach the driver, bounded by
the files of one trigger (``maxFilesPerTrigger``).
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import gridlake
from gridlake.session import path_exists
from gridlake.sources.batch import SOURCE_FILE

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(gridlake)

CORRUPT = "_corrupt_record"


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        p = path[len("file:") :]
        while p.startswith("//"):
            p = p[1:]
        return p
    return path if "://" not in path else None


def parse_header(line: str, sep: str) -> list[str]:
    line = line.lstrip("﻿").rstrip("\r\n")
    cols = next(csv.reader(io.StringIO(line), delimiter=sep)) if line else []
    out, seen = [], defaultdict(int)
    for i, c in enumerate(cols):
        name = c.strip() or f"_c{i}"
        seen[name] += 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


#: Bytes of a first read, and of a header at most.
HEADER_BYTES, MAX_HEADER_BYTES = 1 << 14, 1 << 24
#: Schemes that pyarrow opens on an executor ("": a mounted path).
_RANGED = {"": "", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}
#: Files that one task probes.
_FILES_PER_TASK = 64


def _scheme(path: str) -> str:
    return path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else ""


def first_line(path: str) -> str:
    """The first line of a file, from its first bytes alone."""
    import pyarrow.fs as fs

    local = _local(path)
    if local is not None:
        store, name = fs.LocalFileSystem(), local
    else:
        scheme = _scheme(path)
        store, name = fs.FileSystem.from_uri(_RANGED[scheme] + path[len(scheme) :])
    size = HEADER_BYTES
    with store.open_input_file(name) as f:
        while True:
            raw = f.read_at(min(size, f.size()), 0)
            if b"\n" in raw or len(raw) < size:
                return raw.split(b"\n", 1)[0].decode("utf-8", "replace")
            if size >= MAX_HEADER_BYTES:
                raise ValueError(f"no line ends in the first {size} bytes of {path}")
            size *= 2


def _first_lines(batches):
    for batch in batches:
        paths = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([first_line(p) for p in paths], pa.string())], names=["path", "line"])


def header_lines(files: DataFrame) -> DataFrame:
    """``path, line`` for a frame of paths: each file is opened by the task that has its path."""
    return files.select("path").mapInArrow(_first_lines, "path string, line string")


def probe_headers(
    spark: SparkSession,
    paths: Sequence[str],
    sep: str = ",",
    mode: str = "auto",
) -> dict[str, list[str]]:
    """Header column names of each file, keyed by the path as given.

    ``mode``: ``"ranged"`` (first bytes, on executors), ``"text"`` (a job over the text), or ``"auto"``: ranged wherever
    the file system allows it.
    """
    if mode == "ranged" or (mode == "auto" and all(_scheme(p) in _RANGED for p in paths)):
        tasks = max(1, min(-(-len(paths) // _FILES_PER_TASK), 4 * spark.sparkContext.defaultParallelism))
        files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
        return {r["path"]: parse_header(r["line"], sep) for r in header_lines(files).collect()}
    # Distributed: first line of each file = first row of the split starting at byte 0.
    txt = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"),
        "value",
    )
    firsts = txt.filter(F.col("b") == 0).groupBy("f").agg(F.min_by("value", "i").alias("h")).collect()
    by_uri = {_canonical(r["f"]): parse_header(r["h"] or "", sep) for r in firsts}
    return {p: by_uri.get(_canonical(p), []) for p in paths}


def _canonical(p: str) -> str:
    """Comparable form of a path/URI (``/x``, ``file:/x`` and ``file:///x`` agree)."""
    loc = _local(p)
    return loc if loc is not None else p


def read_csv_drifting(
    spark: SparkSession,
    paths: Sequence[str],
    sep: str = ",",
    provenance: bool = True,
    headers: dict[str, list[str]] | None = None,
    probe_mode: str = "auto",
    recursive: bool = False,
) -> tuple[DataFrame, list[list[str]]]:
    """All-string DataFrame of the files, columns matched by header name.

    Returns the frame and the distinct headers met (in first-seen order). With ``recursive``, ``paths`` may be
    folders whose files share the header given for them.
    """
    headers = headers or probe_headers(spark, paths, sep, mode=probe_mode)
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        groups.setdefault(tuple(headers[p]), []).append(p)
    parts = []
    for hdr, files in groups.items():
        if not hdr:
            continue
        # A line whose field count does not match its file's header is kept whole in
        # the corrupt-record column (PERMISSIVE would otherwise drop extra tokens silently).
        fields = [T.StructField(c, T.StringType(), True) for c in hdr if c != CORRUPT]
        schema = T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("sep", sep)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("recursiveFileLookup", recursive)
            .csv(files)
        )
        if provenance:
            df = df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        parts.append(df)
    if not parts:
        raise ValueError("no readable header in the given files")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union, [list(h) for h in groups]


class SchemaLog:
    """Versioned column lists of a stream (S-09): one JSON row per schema change.

    A change is recorded with the micro-batch that first met it; a retried
    batch may append the same row twice, which readers collapse.
    """

    SCHEMA = T.StructType(
        [
            T.StructField("batch_id", T.LongType()),
            T.StructField("columns", T.ArrayType(T.StringType())),
            T.StructField("added", T.ArrayType(T.StringType())),
            T.StructField("first_file", T.StringType()),
            T.StructField("schema_json", T.StringType()),
        ]
    )

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._known: list[str] | None = None

    def load(self) -> list[str]:
        """Read the current column list once; later ``record`` calls keep it up to date."""
        self._known = self.current()
        return self._known

    def versions(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            empty = T.StructType([*self.SCHEMA.fields, T.StructField("version", T.IntegerType())])
            return self.spark.createDataFrame([], empty)
        df = self.spark.read.schema(self.SCHEMA).json(self.path)
        first = df.groupBy("columns").agg(F.min("batch_id").alias("batch_id"))
        rows = df.join(first, ["columns", "batch_id"]).dropDuplicates(["columns", "batch_id"])
        from pyspark.sql import Window

        return rows.withColumn("version", F.row_number().over(Window.orderBy("batch_id", F.size("columns"))))

    def current(self) -> list[str]:
        if not path_exists(self.spark, self.path):  # nothing known, no job needed
            return []
        r = self.versions().orderBy(F.col("version").desc()).select("columns").first()
        return list(r["columns"]) if r else []

    def record(self, batch_id: int, columns: Sequence[str], first_file: str, schema_json: str | None = None) -> list[str]:
        """Append a version when ``columns`` adds names to the current list; returns the added names.

        ``schema_json`` (``StructType.json()`` of the typed output) is stored with the version.
        """
        known = self._known if self._known is not None else self.current()
        added = [c for c in columns if c not in known]
        if added or not known:
            merged = known + added
            row = [(int(batch_id), merged, added if known else [], first_file, schema_json)]
            self.spark.createDataFrame(row, self.SCHEMA).coalesce(1).write.mode("append").json(self.path)
            if self._known is not None:
                self._known = merged
        return added


def added_columns(log: SchemaLog) -> DataFrame:
    """E-08: one row per column added after the first version, with the batch and file that introduced it."""
    v = log.versions()
    return v.filter(F.col("version") > 1).select(F.explode("added").alias("column_name"), "batch_id", "first_file")
