"""Session helpers: a tuned local session for tests/bench, and the shared scratch folder.

On a cluster the session is created by the platform; everything in this
library only *reads* its configuration. The one location we need for our
own files (landing copies in proofs, batch outputs of streams, lineage cuts)
is derived from ``spark.checkpoint.dir``, which a cluster points at shared
storage. Only where it is unset and the master is local (tests) do we create one
ourselves; on a cluster an unset folder is an error, since a folder of one
machine is invisible to the others.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "gridlake",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.schemaInference", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; created only where unset (tests)."""
    conf_dir = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if conf_dir:
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # SparkContext appends a per-application UUID folder; keep our files beside it.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="gridlake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/gridlake/{tag}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (to shared storage) — survives executor loss, unlike localCheckpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds visible files or folders (names that don't begin with ``_`` or ``.``); other errors are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(s.getPath().getName()[0] not in "_." for s in fs.listStatus(p))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that this library made."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
