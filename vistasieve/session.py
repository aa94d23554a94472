"""Session construction and the shared checkpoint folder.

Cluster jobs get ``spark.checkpoint.dir`` from the cluster configuration; that
folder is shared by every executor, so it is the only place lineage is cut to.
A machine-local scratch folder is used only when the session runs in local mode
and the setting is absent (tests, the bench on one machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_scopes: list[list[str]] = []  # paths made inside the open ``scratch_scope`` blocks


def _driver_memory() -> str:
    """Local mode runs everything in the driver JVM: 60 % of RAM, between 1 and 16 GiB."""
    try:
        with open("/proc/meminfo") as fh:
            kib = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        gib = max(1, min(16, int(kib * 0.6 / (1024 * 1024))))
    except (OSError, StopIteration, ValueError):
        gib = 4
    return f"{gib}g"


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "vistasieve", event_log_dir: str | None = None
) -> SparkSession:
    """A local session tuned for tests and the single-machine bench (optionally with an event log)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VISTASIEVE_DRIVER_MEMORY") or _driver_memory())
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only in local mode.

    Order: a folder already set on the SparkContext, then the session setting
    ``spark.checkpoint.dir``; a fresh ``/tmp`` folder only when the master is
    ``local``. On a cluster without the setting this raises instead of silently
    writing to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vistasieve-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: set it to a folder shared by all executors "
        "(HDFS/S3/ABFS) before running iterative or ranked operators"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    for made in _scopes[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the scratch tables that are made inside the block when it ends.

    Results are lazy and read them, so what is needed later must be written elsewhere inside the block (or its path taken
    out of the list that the block is given).
    """
    from vistasieve.functions.files import delete_tree

    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.remove(made)
        for path in made:
            delete_tree(spark, path)

