"""Position of each row in a total order (1-based), optionally per key,
without an un-partitioned window (which would funnel all rows into one task).

Plan (one query, no caching):

1. ``repartitionByRange(P, keys..., order...)`` -- balanced, contiguous slices
   of the order; a hot key simply spans several slices.
2. ``sortWithinPartitions`` + ``monotonically_increasing_id()`` -- partition
   id in the upper bits, position within the partition in the lower 33.
3. Per (partition, key): first position and row count -- a table of at most
   ``P + #keys`` rows.  A running sum over partitions gives each slice the
   number of rows of its key that sit in earlier slices.
4. Join back on (partition, key) and add: ``n = before + pos - first + 1``.

The range bounds come from sampling seeded by the RDD id, and column pruning
makes the count branch and the row branch plan separate exchanges, so the
numbered rows are materialised once with ``checkpoint()`` into the shared
checkpoint folder before both branches read them: counts and rows always
agree, and a lost executor cannot change them.  The order must be total:
pass a unique id as the last order column.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpool.session import ensure_checkpoint_dir

# Largest per-(partition, key) table joined by broadcast.
MAX_BROADCAST_SLICES = 1_000_000

LOW_BITS = 33
LOW_MASK = (1 << LOW_BITS) - 1


def _cols(cs: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _local_rank(key_names: list[str], out: str):
    """mapInPandas function: 1-based position of each row within its key's
    run inside one partition (rows arrive sorted by key).  The running count
    of the last key is carried from one Arrow batch to the next."""

    def same_as_previous(cur, prev):
        eq = pd.Series(True, index=cur.index)
        for c in cur.columns:
            a, b = cur[c], prev[c]
            eq &= (a == b) | (a.isna() & b.isna())
        return eq

    def fn(batches):
        carry_key, carry_count = None, 0
        for pdf in batches:
            if len(pdf) == 0:
                yield pdf.assign(**{out: pd.Series([], dtype="int64")})
                continue
            k = pdf[key_names].reset_index(drop=True)
            prev = k.shift(1)
            if carry_key is not None:
                prev.iloc[0] = carry_key
            cont = same_as_previous(k, prev)
            if carry_key is None:
                cont.iloc[0] = False
            run = (~cont).cumsum()
            local = run.groupby(run).cumcount() + 1
            if cont.iloc[0]:  # first run continues the previous batch's run
                local = local + (run == run.iloc[0]) * carry_count
            res = pdf.reset_index(drop=True).assign(**{out: local.astype("int64").to_numpy()})
            carry_key = k.iloc[len(k) - 1].copy()
            carry_count = int(local.iloc[len(local) - 1])
            yield res

    return fn


def ordinal(
    df: DataFrame,
    order: Sequence,
    keys: Sequence[str] = (),
    out: str = "n",
    num_partitions: int | None = None,
    plan: str = "auto",
    start: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus a bigint column ``out`` = 1-based position in ``order``
    (within each key when ``keys`` are given).

    ``plan`` (keyed only): ``"broadcast"`` joins every row to the
    per-(partition, key) table of first positions and offsets, broadcast
    after its row count is checked (<= ``MAX_BROADCAST_SLICES``);
    ``"local"`` counts positions inside each sorted partition with a
    vectorised pandas pass (no shuffle) and broadcasts only the offsets of
    keys that continue from an earlier partition -- at most one per
    partition boundary; ``"auto"`` picks ``broadcast`` when the slice table
    is small enough, else ``local``.

    ``start`` (keys, ``seen``; one row a key at most) makes each key's
    positions go on after ``seen`` earlier rows.  It is added to the offsets of
    slices, so no row moves to meet it."""
    keys = list(keys)
    spark = df.sparkSession
    if plan not in ("auto", "broadcast", "local"):
        raise ValueError("plan must be 'auto', 'broadcast' or 'local'")
    sort_cols = _cols(keys) + _cols(order)
    # Without an explicit count the range exchange may be coalesced by AQE
    # into adjacent ranges sized by the data; positions are taken after that.
    by_range = (df.repartitionByRange(*sort_cols) if num_partitions is None
                else df.repartitionByRange(num_partitions, *sort_cols))
    ranged = (
        by_range
        .sortWithinPartitions(*sort_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    ranged = ranged.withColumn("_pid", F.shiftright(F.col("_mid"), LOW_BITS)) \
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(LOW_MASK)))
    slices = ranged.groupBy("_pid", *keys).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    alias = {c: f"_sk{i}" for i, c in enumerate(keys)}
    offsets = slices.select(
        F.col("_pid").alias("_spid"),
        *[F.col(c).alias(a) for c, a in alias.items()],
        "_first",
        F.coalesce(F.sum("_cnt").over(w), F.lit(0)).cast("bigint").alias("_before"),
    )
    if start is not None and keys:
        known = start.select(*[F.col(c).alias(f"_st{i}") for i, c in enumerate(keys)], F.col("seen").alias("_seen"))
        same = [F.col(alias[c]).eqNullSafe(F.col(f"_st{i}")) for i, c in enumerate(keys)]
        offsets = offsets.join(known, same, "left").withColumn("_before", F.col("_before") + F.coalesce(F.col("_seen"), F.lit(0)))
        offsets = offsets.select("_spid", *alias.values(), "_first", "_before")
    elif start is not None:
        row = start.agg(F.sum("seen").cast("bigint").alias("s")).first()  # one number
        offsets = offsets.withColumn("_before", F.col("_before") + F.lit(row["s"] or 0))
    cond = [F.col("_pid") == F.col("_spid")] + [F.col(c).eqNullSafe(F.col(a)) for c, a in alias.items()]
    drop = ["_mid", "_pid", "_pos", "_spid", "_first", "_before", "_local", *alias.values()]
    if keys and plan == "auto":
        # one small job over the checkpoint: is the slice table safe to broadcast?
        plan = "broadcast" if slices.limit(MAX_BROADCAST_SLICES + 1).count() <= MAX_BROADCAST_SLICES else "local"
    if not keys or plan == "broadcast":
        # without keys the table has one row per range partition: a proven bound
        joined = ranged.join(F.broadcast(offsets), cond, "inner")
        n = F.col("_before") + F.col("_pos") - F.col("_first") + 1
        return joined.withColumn(out, n.cast("bigint")).drop(*[c for c in drop if c != out])
    # local plan: positions inside each partition, offsets only where a key
    # continues from an earlier partition (at most num_partitions - 1 rows)
    local_schema = T.StructType(ranged.schema.fields + [T.StructField("_local", T.LongType())])
    local = ranged.mapInPandas(_local_rank(keys, "_local"), schema=local_schema)
    carried = offsets.filter(F.col("_before") > 0).drop("_first")
    # with earlier rows every key may have an offset: no bound, so the join is Spark's to choose
    joined = local.join(F.broadcast(carried) if start is None else carried, cond, "left")
    n = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_local")
    return joined.withColumn(out, n.cast("bigint")).drop(*[c for c in drop if c != out])
