"""Session helpers: building a session, and a shared checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared file system path set by whoever runs the cluster).  Only when it is
unset -- local runs and tests -- do we pick a fresh folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: With it, an execution's shuffle files go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gleaner") -> SparkSession:
    """Create (or fetch) a session with the settings every plan here assumes.

    AQE is on so shuffle partition counts coalesce at runtime and skewed join
    partitions are split; the UI is off (no server ports).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cpus = os.cpu_count() or 8
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("GLEANER_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  A local folder is set
    only where the whole session runs on this machine (tests); on a cluster
    other hosts could not see it, so there a missing setting is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gleaner-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """What is executed inside leaves no shuffle files."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP_CONF) if before is None else spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def materialize(df):
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it
    from there: lineage is cut, reuse by several branches costs one write and
    prunes columns, and a lost executor costs a re-read, not a recomputation.
    The shuffle files of the write go with it."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
