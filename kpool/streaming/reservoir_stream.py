"""Slot-replacement reservoirs over a stream (A4, T5): the pool goes on from its
stored state, and its history grows as it goes.

Each micro-batch numbers its elements after the stored counts, so their slots are
those of one replay over the whole stream, and overlays the stored pool by the
newest writer of each slot.  Items that were replaced leave as closed intervals,
written to ``batch=<id>`` of the output folder; open ones are the state.  A
replayed micro-batch rewrites both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpool.operators.reservoir import count_seen, reservoir_intervals
from kpool.operators.sample import DEFAULT_SIZE, check_size
from kpool.plans.layout import materialize
from kpool.streaming.changelog import ITEM, SEEN, WHAT, start_step
from kpool.streaming.slots import latest_state


def reservoir_step(batch: DataFrame, k: int, order: Sequence, value_cols: Sequence[str], keys: Sequence[str], seed: int, salt: str,
                   state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(closed intervals, next state) of one micro-batch."""
    keys = list(keys)
    seen = pool = None
    if state is not None:
        seen = state.filter(F.col(WHAT) == SEEN).select(*keys, F.col("n").alias("seen"))
        pool = state.filter(F.col(WHAT) == ITEM).select(*keys, "slot", "n", *value_cols)
    rows = materialize(reservoir_intervals(batch, k, order, value_cols, keys, seed, pool, seen, salt))
    counts = count_seen(batch, keys, seen).select(F.lit(SEEN).alias(WHAT), *keys, F.col("seen").alias("n"))
    held = rows.filter("to_n IS NULL").select(F.lit(ITEM).alias(WHAT), *keys, "slot", F.col("from_n").alias("n"), *value_cols)
    return rows.filter("to_n IS NOT NULL"), counts.unionByName(held, allowMissingColumns=True)


def stream_reservoir(sdf: DataFrame, k: int = DEFAULT_SIZE, order: Sequence = (), value_cols: Sequence[str] = (), keys: Sequence[str] = (),
                     seed: int = 0, salt: str = "", table_dir: str | None = None, out_dir: str | None = None, checkpoint: str | None = None,
                     trigger: dict | None = None):
    """Start the reservoirs of a stream; returns ``(query, out_dir)``.  Read them by
    ``stream_pool`` and ``stream_history``."""
    check_size("k", k)
    if not order:
        raise ValueError("order must name the columns that order the elements")

    def step(batch, state):
        return reservoir_step(batch, k, order, value_cols, keys, seed, salt, state)

    return start_step(sdf, step, table_dir, out_dir, checkpoint, trigger)


def stream_pool(spark: SparkSession, table_dir: str, value_cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The reservoirs now: ``keys..., slot, n, value_cols...``."""
    state = latest_state(spark, table_dir)
    if state is None:
        raise ValueError(f"nothing has been written to {table_dir} yet")
    return state.filter(F.col(WHAT) == ITEM).select(*keys, "slot", "n", *value_cols)


def stream_history(spark: SparkSession, table_dir: str, out_dir: str, value_cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The history so far, as ``reservoir_history`` gives it for a whole table:
    intervals that later micro-batches closed, and those still open."""
    cols = [*keys, "slot", "from_n", "to_n", *value_cols]
    held = stream_pool(spark, table_dir, value_cols, keys).withColumnRenamed("n", "from_n").withColumn("to_n", F.lit(None).cast("bigint"))
    return spark.read.parquet(out_dir).select(*cols).unionByName(held.select(*cols))
