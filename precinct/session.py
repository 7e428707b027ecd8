"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_own = threading.local()

#: Most rows of a written table that Catalyst may broadcast.
BROADCAST_ROWS = 100_000


def get_session(app: str = "precinct", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the defaults this package is tuned for.

    Cluster sizing (executors, memory, shuffle partitions) is left to
    spark-submit; only a local master gets a small shuffle width.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Catalyst compares the estimated build side with this bound, so a
        # dimension that outgrows it falls back to a shuffled join.
        .config("spark.sql.autoBroadcastJoinThreshold", "64m")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.sql.shuffle.partitions", str(os.cpu_count() or 8))
            # small inputs still use every core after a shuffle
            builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="precinct-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str):
    """Write a (reduced) intermediate once to the shared folder and read it back.

    Later branches then share one computation, the lineage is cut by a table
    that outlives executors, and Catalyst knows the true size of the result,
    which is what its broadcast decision needs.
    """
    path = scratch_path(df.sparkSession, label)
    if getattr(_own, "paths", None) is not None:
        _own.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df):
    """A join side that grows with the input: joined by a shuffle.

    Left to Catalyst, it would be broadcast by the size of its compressed files or shuffle blocks, of which the driver holds many times as much.
    """
    return df.hint("merge")


def few_or_shuffled(written):
    """A written table as a join side: left to Catalyst while its rows are few, else joined by a shuffle."""
    return written if written.count() <= BROADCAST_ROWS else shuffled(written)


@contextmanager
def own_intermediates(spark: SparkSession):
    """What is materialized inside is removed at the end; nothing that reads it may be left by then."""
    outer, _own.paths = getattr(_own, "paths", None), []
    try:
        yield
    finally:
        files = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in _own.paths:
            at = files.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _own.paths = outer
