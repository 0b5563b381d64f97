"""Session helpers: a local session for tests/bench, and the shared folder
that jobs use to cut lineage or keep streaming state."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kpool") -> SparkSession:
    """Local session for tests and the bench.  On a cluster, use the
    session the platform gives you; kpool reads its settings from there."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # checkpoint files go when the plans that read them do; set it on a cluster too
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` / the SparkContext).
    Where none is set and the master is ``local`` -- as in tests -- a folder is
    made and registered, so that ``DataFrame.checkpoint()`` and streaming
    checkpoints land in the same place; on a cluster that raises, as executors
    do not see the driver's folders.
    """
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = base or tempfile.mkdtemp(prefix="kpool-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base


def shared_dir(spark: SparkSession, *sub: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    path = ensure_checkpoint_dir(spark).rstrip("/")
    for s in sub:
        path = f"{path}/{s}"
    return f"{path}-{uuid.uuid4().hex[:12]}"
