"""Shared helpers of the training-data operators: written lineage cuts, byte views of Arrow text, worker caches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import gridlake
from gridlake.session import drop_path, scratch_path

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(gridlake)

#: Upper bounds of one numpy block inside a task (a single longer text is a block of its own).
BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 2000
MAX_BROADCAST_IDS = 2_000_000


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def release(*written: DataFrame) -> None:
    """Removes tables of ``materialize`` that nothing reads any more: call it when what was made of them is written itself."""
    for table in written:
        drop_path(table.sparkSession, table.scratch)


def drop_garbage(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of results that nothing refers to any more; it waits for a collection of the
    driver's heap, which may be hours away. Call it after a job that shuffled much, when its frames are out of use."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def sized(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for a broadcast if it has at most MAX_BROADCAST_IDS rows (8 bytes each); a
    larger one is joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def worker_cache(key: str) -> dict:
    """A dictionary of this Python worker process: what a task builds in it serves the worker's later tasks.

    A worker holds one operator's cache at a time; the next operator's first task frees it.
    """
    held = sys.__dict__.setdefault("_gridlake_llm_cache", {})
    if key not in held:
        held.clear()
        gc.collect()
        give_back()
    return held.setdefault(key, {})


def give_back() -> None:
    """Returns the freed pages of this Python worker to the system: Arrow's pool and glibc keep them unless asked, and a worker
    that waits for its next task counts against its executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run, key: str | None = None):
    """``run``, a function over a task's batches, that at its end gives its memory back. With ``key``, the caches of other operators
    are dropped at its begin."""

    def own(batches):
        if key:
            worker_cache(key)
        yield from run(batches)
        give_back()

    return own


def whole_texts(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows in this session: rows are whole texts here, and Spark's default of 10,000
    rows makes batches of tens of MB on both sides of every task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches, rows: int = 1000):
    """The batches in parts of at most ``rows`` rows (views, no copies), so that what a task derives from one stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its values (null counts as empty)."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray, max_bytes: int = BLOCK_BYTES, max_docs: int = BLOCK_DOCS):
    """Ranges of documents that make numpy blocks of bounded size: a single longer text stands alone."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + max_bytes, "right")) - 1
        b = min(max(b, a + 1), a + max_docs, n)
        yield a, b
        a = b
