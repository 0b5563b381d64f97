"""State of a ``foreachBatch`` stream in two alternating slots of a table.

Micro-batch b reads the version that batch b - 1 wrote and writes its own into
slot ``b % 2``.  A replayed batch finds the same previous version in the other
slot and rewrites its own, so replays change nothing.  A version that should be
there and is not raises; it is never taken for "nothing written yet".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpool.streaming.sample_stream import SLOT, VERSION, latest_version

HEAD = "_head"


def read_state(spark: SparkSession, table_dir: str, batch_id: int) -> DataFrame | None:
    """What batch ``batch_id - 1`` wrote; None for the first batch."""
    version = latest_version(spark, table_dir, before=batch_id)
    if batch_id > 0 and version != batch_id - 1:
        raise RuntimeError(f"batch {batch_id} needs version {batch_id - 1} of {table_dir}, found {version}")
    return None if version is None else _version(spark, table_dir, version)


def _version(spark: SparkSession, table_dir: str, version: int) -> DataFrame:
    rows = spark.read.parquet(f"{table_dir}/{SLOT}={version % 2}")
    return rows.filter((F.col(VERSION) == version) & ~F.col(HEAD)).drop(VERSION, HEAD)


def latest_state(spark: SparkSession, table_dir: str) -> DataFrame | None:
    version = latest_version(spark, table_dir)
    return None if version is None else _version(spark, table_dir, version)


def write_state(state: DataFrame, table_dir: str, batch_id: int) -> None:
    """Write ``state`` as the version of ``batch_id``; a marker row stands for an empty one."""
    head = state.sparkSession.createDataFrame([(batch_id, True)], f"{VERSION} long, {HEAD} boolean")
    rows = state.withColumn(VERSION, F.lit(batch_id).cast("bigint")).withColumn(HEAD, F.lit(False))
    rows.unionByName(head, allowMissingColumns=True).write.mode("overwrite").parquet(f"{table_dir}/{SLOT}={batch_id % 2}")
