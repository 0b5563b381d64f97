"""The slot-replacement reservoir (UPDATE one element at a time), replayed
relationally.

Element number n (1-based, in the given order) goes to slot n while n <= k;
later it draws i uniform in [1, n] and replaces slot i if i <= k.  The draw
depends only on (seed, salt, key, n), so every element's slot is a column
expression once n is known (see ``ordinal.py``).  An element is in the final
reservoir iff it is the last one written to its slot: a ``max_by`` per slot.

Only elements with slot <= k survive the filter -- about k (1 + ln(N / k))
of N -- so the shuffle before the per-slot aggregation is tiny.

``reservoir_history`` keeps every accepted element with the interval of n in
which it held its slot; ``reservoir_as_of`` reads the reservoir after any
prefix of the stream from it (the reference's per-element output, compact).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpool.functions.tags import draw, id_text
from kpool.operators.ordinal import ordinal
from kpool.operators.sample import check_size


SLOT_TAG = "slot-"  # marks a summary whose item order is that of slots


def slot_of(n: Column, k: int, seed: int, key_parts: Sequence[Column] = (), salt: str = "") -> Column:
    """Slot written by element n (may exceed k: then nothing is written)."""
    return F.when(n <= k, n).otherwise(draw(seed, "slot", F.lit(salt), *key_parts, n, bound=n) + 1).cast("bigint")


def reservoir_candidates(
    df: DataFrame,
    k: int,
    order: Sequence,
    keys: Sequence[str] = (),
    seed: int = 0,
    num_partitions: int | None = None,
    salt: str = "",
    seen: DataFrame | None = None,
) -> DataFrame:
    """Elements that are written to a slot at least once: ``df`` + n + slot.
    ``seen`` (keys, ``seen``): rows of each key that came before."""
    check_size("k", k)
    keys = list(keys)
    types = {f.name: f.dataType for f in df.schema.fields}
    numbered = ordinal(df, order, keys, out="n", num_partitions=num_partitions, start=seen)
    key_parts = [id_text(c, types.get(c)) for c in keys]
    return numbered.withColumn("slot", slot_of(F.col("n"), k, seed, key_parts, salt)).filter(F.col("slot") <= k)


def reservoir_replay(
    df: DataFrame,
    k: int,
    order: Sequence,
    value_cols: Sequence[str],
    keys: Sequence[str] = (),
    seed: int = 0,
    num_partitions: int | None = None,
    salt: str = "",
) -> DataFrame:
    """Final reservoir: ``keys..., slot, n, value_cols...`` (one row per slot)."""
    keys = list(keys)
    cand = reservoir_candidates(df, k, order, keys, seed, num_partitions, salt)
    best = F.max_by(F.struct(F.col("n"), *[F.col(c) for c in value_cols]), F.col("n"))
    return cand.groupBy(*keys, "slot").agg(best.alias("_b")).select(
        *keys, "slot", F.col("_b.n").alias("n"), *[F.col(f"_b.{c}").alias(c) for c in value_cols])


def count_seen(df: DataFrame, keys: Sequence[str] = (), seen: DataFrame | None = None) -> DataFrame:
    """``keys..., seen``: rows of each key, with those counted before."""
    now = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("seen"))
    if seen is not None:
        now = now.unionByName(seen.select(*keys, "seen")).groupBy(*keys).agg(F.sum("seen").cast("bigint").alias("seen"))
    return now


def reservoir_intervals(df: DataFrame, k: int, order: Sequence, value_cols: Sequence[str], keys: Sequence[str] = (), seed: int = 0,
                        pool: DataFrame | None = None, seen: DataFrame | None = None, salt: str = "",
                        num_partitions: int | None = None) -> DataFrame:
    """What ``df`` does to a stored pool: ``keys..., slot, from_n, to_n, value_cols...``
    of every item that was in ``pool`` or enters it; ``to_n`` is the last n before
    it was replaced, null while it is held.

    Elements get their n after the ``seen`` rows of their key, so their slots are
    those of one replay over everything; ``pool`` (``keys..., slot, n,
    value_cols...``) is overlaid by the newest writer of each slot."""
    keys = list(keys)
    cand = reservoir_candidates(df, k, order, keys, seed, num_partitions, salt, seen).select(*keys, "slot", "n", *value_cols)
    if pool is not None:
        cand = cand.unionByName(pool.select(*keys, "slot", "n", *value_cols))
    w = Window.partitionBy(*keys, "slot").orderBy("n")
    return cand.select(*keys, "slot", F.col("n").alias("from_n"), (F.lead("n").over(w) - 1).cast("bigint").alias("to_n"), *value_cols)


def reservoir_update(df: DataFrame, k: int, order: Sequence, value_cols: Sequence[str], keys: Sequence[str] = (), seed: int = 0,
                     pool: DataFrame | None = None, seen: DataFrame | None = None, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """(pool, seen) after ``df``: UPDATE of stored pools by the rows that arrived
    since, each key's in ``order``.  Starts empty without ``pool`` and ``seen``;
    rows given in any number of parts leave the pool of one replay."""
    if (pool is None) != (seen is None):
        raise ValueError("a stored pool goes with the counts of the rows it has seen")
    rows = reservoir_intervals(df, k, order, value_cols, keys, seed, pool, seen, salt)
    return rows.filter("to_n IS NULL").select(*keys, "slot", F.col("from_n").alias("n"), *value_cols), count_seen(df, keys, seen)


def reservoir_by_key(df: DataFrame, keys: Sequence[str], k: int, order: Sequence,
                     value_cols: Sequence[str], seed: int = 0, salt: str = "") -> DataFrame:
    """One reservoir per key (A5 with A4's algorithm)."""
    return reservoir_replay(df, k, order, value_cols, keys=keys, seed=seed, salt=salt)


def reservoir_history(
    df: DataFrame,
    k: int,
    order: Sequence,
    value_cols: Sequence[str],
    keys: Sequence[str] = (),
    seed: int = 0,
    num_partitions: int | None = None,
    salt: str = "",
) -> DataFrame:
    """Every accepted element with ``from_n`` (when it entered its slot) and
    ``to_n`` (last n before it was replaced; null while still held)."""
    keys = list(keys)
    cand = reservoir_candidates(df, k, order, keys, seed, num_partitions, salt)
    w = Window.partitionBy(*keys, "slot").orderBy("n")
    return cand.select(
        *keys, "slot", F.col("n").alias("from_n"),
        (F.lead("n").over(w) - 1).cast("bigint").alias("to_n"),
        *[F.col(c) for c in value_cols],
    )


def reservoir_as_of(history: DataFrame, n) -> DataFrame:
    """The reservoir after the first ``n`` elements (n: int or Column)."""
    n_col = n if isinstance(n, Column) else F.lit(int(n)).cast("bigint")
    return history.filter((F.col("from_n") <= n_col) & (F.col("to_n").isNull() | (F.col("to_n") >= n_col)))


def reservoir_summary(
    df: DataFrame,
    keys: Sequence[str],
    k: int,
    order: Sequence,
    value_col: str,
    seed: int = 0,
    salt: str = "",
) -> DataFrame:
    """Reservoirs as summaries: ``keys..., n, k, items`` with items in slot
    order (``priority`` holds ``slot-`` and the zero-padded slot, so it cannot
    pass for a comparable priority).  Slot order is not a random order (a
    prefix is biased); ``merge_weighted`` permutes such items first.  Reservoirs
    that will be merged need a ``salt`` each, or they take the same slot
    decisions at the same n.

    The stream size n comes from a count per key, combined with the slots by
    a union + one aggregation (each key holds at most k slots)."""
    keys = list(keys)
    res = reservoir_replay(df, k, order, [value_col], keys=keys, seed=seed, salt=salt)
    item = F.struct(F.concat(F.lit(SLOT_TAG), F.lpad(F.col("slot").cast("string"), 20, "0")).alias("priority"),
                    F.col(value_col).alias("value"))
    slots = res.select(*keys, F.lit(None).cast("bigint").alias("n"), item.alias("_item"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(
        *keys, "n", F.lit(None).cast(slots.schema["_item"].dataType).alias("_item"))
    return counts.unionByName(slots).groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n"),
        F.lit(k).cast("bigint").alias("k"),
        F.sort_array(F.collect_list("_item")).alias("items"),
    )
