"""Physical layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


# Inputs the optimizer holds to be at most this large are worth one exchange;
# larger ones are read in many splits anyway.
SPREAD_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate.  Plans only; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def estimated_partitions(df: DataFrame) -> int:
    """Scan splits the estimate amounts to."""
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(1, -(-estimated_bytes(df) // int(split)))


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input, which one task may read whole (a file with one
    row group), over the cores before heavy per-row work such as hashing.
    Inputs above ``SPREAD_BYTES``, and streams, stay as they are.
    """
    if df.isStreaming or estimated_bytes(df) > SPREAD_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it as files in the shared checkpoint
    folder (reliable ``checkpoint()``, one job).

    Used where a small intermediate -- summaries, pruned candidates -- is read
    by more than one branch of the plan that follows.  Unlike ``persist()`` it
    pins no executor memory for the rest of the session, and unlike a local
    checkpoint it survives the loss of the executors that computed it.
    """
    from kpool.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
