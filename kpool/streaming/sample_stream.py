"""Continuous UPDATE over a stream (T1) and the merge of sampled streams (T3).

``stream_sample`` keeps one summary per key in a table under a shared
folder.  Each micro-batch is summarised on its own (partial top-k per
partition, <= k rows per key shuffled), merged with the previous version
(an exact merge: priorities are order-free, so the result equals the batch
sample of everything seen), and written with its batch id ``v`` into one of
two alternating slots, ``slot=<batchId % 2>``.

Replaying a batch after a failure reads the same previous version (it lives
in the other slot) and rewrites the same slot, so the table is
effectively-once although ``foreachBatch`` is at-least-once.  A batch whose
previous version is missing or cannot be read raises; it never starts anew.  Storage stays
at two versions, and finding the previous one reads two small folders
however long the stream has run.  State is bounded by k items per key; no
watermark is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpool.operators.merge import merge_summaries
from kpool.operators.sample import DEFAULT_SIZE, check_size
from kpool.operators.summary import build_summary
from kpool.session import shared_dir

VERSION = "v"
SLOT = "slot"
SALT = "_salt"


def complete_slots(spark: SparkSession, table_dir: str) -> list[str]:
    """Slots whose write was committed.  Folders are looked up, not read, so
    "nothing written yet" is never confused with "cannot be read"."""
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(table_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    slots = [f"{table_dir}/{SLOT}={i}" for i in (0, 1)]
    return [x for x in slots if files.exists(jvm.org.apache.hadoop.fs.Path(f"{x}/_SUCCESS"))]


def latest_version(spark: SparkSession, table_dir: str, before: int | None = None) -> int | None:
    """Batch id of the newest complete version (optionally: newest < before);
    None if nothing was written yet.  A table that cannot be read raises."""
    found = []
    for slot in complete_slots(spark, table_dir):
        rows = spark.read.parquet(slot)
        if before is not None:
            rows = rows.filter(F.col(VERSION) < before)
        found += [r["m"] for r in rows.agg(F.max(VERSION).alias("m")).collect() if r["m"] is not None]
    return int(max(found)) if found else None


def read_version(spark: SparkSession, table_dir: str, version: int) -> DataFrame:
    """Summaries as of batch ``version`` (read from its slot only)."""
    return (spark.read.parquet(f"{table_dir}/{SLOT}={version % 2}")
            .filter((F.col(VERSION) == version) & F.col("n").isNotNull()).drop(VERSION))


def latest_summary(spark: SparkSession, table_dir: str, before: int | None = None) -> DataFrame | None:
    """The newest summaries (optionally: newest with batch id < before)."""
    v = latest_version(spark, table_dir, before)
    return None if v is None else read_version(spark, table_dir, v)


def summary_batch_writer(keys: Sequence[str], k: int, value_cols, id_cols: Sequence, seed: int,
                         table_dir: str):
    keys = list(keys)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for the counts and for the items
        try:
            fresh = build_summary(batch, keys, k, value_cols, id_cols, seed=seed, strategy="window")
            # resolved before writing: the previous version sits in the other slot
            version = latest_version(spark, table_dir, before=batch_id)
            if batch_id > 0 and version != batch_id - 1:
                raise RuntimeError(f"batch {batch_id} needs version {batch_id - 1} of {table_dir}, found {version}")
            merged = fresh
            if version is not None:
                merged = merge_summaries(read_version(spark, table_dir, version).unionByName(fresh), keys, k, materialize_input=False)
            # an empty summary is written too: it is the version that the next batch looks for
            head = spark.createDataFrame([(batch_id,)], f"{VERSION} long")
            rows = merged.withColumn(VERSION, F.lit(batch_id).cast("bigint"))
            rows = rows.unionByName(head, allowMissingColumns=True)
            rows.write.mode("overwrite").parquet(f"{table_dir}/{SLOT}={batch_id % 2}")
        finally:
            batch.unpersist()

    return on_batch


def stream_sample(
    sdf: DataFrame,
    keys: Sequence[str],
    k: int = DEFAULT_SIZE,
    value_cols=(),
    id_cols: Sequence = (),
    seed: int = 0,
    table_dir: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    salt: int = 1,
):
    """Start the sampling stream; returns ``(query, table_dir)``.

    ``table_dir`` / ``checkpoint`` default to fresh folders under the shared
    checkpoint directory.  Read the current summaries with
    ``latest_summary(spark, table_dir)``.

    With ``salt`` above 1 the state has two levels: each key is kept as ``salt``
    sub-keys (by a hash of the identity), so that updates of one key are that
    many tasks; ``merged_summary`` merges them on read, exactly.
    """
    spark = sdf.sparkSession
    check_size("salt", salt)
    keys = list(keys)
    if salt > 1:
        names = [F.col(c) if isinstance(c, str) else c for c in id_cols]
        sdf = sdf.withColumn(SALT, F.pmod(F.xxhash64(*names), F.lit(salt)).cast("int"))
        keys = [*keys, SALT]
    table_dir = table_dir or shared_dir(spark, "summaries")
    checkpoint = checkpoint or shared_dir(spark, "stream-ckpt")
    writer = summary_batch_writer(keys, k, value_cols, id_cols, seed, table_dir)
    w = sdf.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(), table_dir


def merged_summary(spark: SparkSession, table_dir: str, keys: Sequence[str], k: int = DEFAULT_SIZE) -> DataFrame | None:
    """The newest summaries of a salted stream, one per key."""
    parts = latest_summary(spark, table_dir)
    return None if parts is None else merge_summaries(parts, keys, k, materialize_input=False)


def run_to_end(query) -> None:
    """Block until an ``availableNow`` stream has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_merge(spark: SparkSession, table_dirs: Sequence[str], keys: Sequence[str], m: int = DEFAULT_SIZE,
                 short: str = "cap") -> DataFrame:
    """The merged summary of several sampled streams, as of now (T3)."""
    parts = [latest_summary(spark, d) for d in table_dirs]
    for part, d in zip(parts, table_dirs):
        if part is None:
            raise ValueError(f"no summary has been written to {d} yet")
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return merge_summaries(allp, keys, m, short=short)
