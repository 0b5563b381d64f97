"""Fixed-size uniform samples without replacement (UPDATE on a bounded set).

A row's priority is a seeded md5 of its identity; the sample of size k is the
k rows with the smallest priorities, globally or per key.  Every subset of k
rows is equally likely, the answer does not depend on partitioning, and
samples of disjoint parts merge exactly (see ``merge.py``).

Physical plans
--------------
* ``strategy="window"`` -- ``row_number() over (partition by keys order by
  priority) <= k``.  Up to the session's group-limit threshold Catalyst plants
  a partial ``WindowGroupLimit`` below the exchange, so at most k rows per key
  per input partition are shuffled.  For the global sample
  ``orderBy(...).limit(k)`` becomes ``TakeOrderedAndProject``.
* ``strategy="prune"`` -- for k above that threshold (Spark then plants no
  partial limit), very many input splits or a hot key.  Priorities are
  uniform, so with the per-key count n known, only rows whose priority lies
  below ``(k + 8 sqrt(k) + 16) / n`` can be in the top k (with probability
  1 - 1e-15).  Counts are one small aggregate; the threshold filter runs
  before any shuffle; survivors are checked to hold at least min(k, n) rows
  per key, and if a key falls short the exact window plan is used instead,
  so the result is always exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpool.functions.tags import HEX_DIGITS_FOR_DRAW, hex_threshold, row_priority
from kpool.plans.layout import estimated_partitions, materialize, spread

PRIORITY = "priority"
RANK = "sample_rank"
DEFAULT_SIZE = 10  # fixed value: sample and merge size where none is given
GROUP_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"

# A per-key merge that would receive more rows than this switches to pruning.
PRUNE_ROWS = 2_000_000
# Most keys whose thresholds are broadcast: only keys holding more than
# total / MAX_BROADCAST_KEYS rows are pruned, so this bound always holds.
MAX_BROADCAST_KEYS = 200_000


def check_size(name: str, value: int) -> None:
    if not isinstance(value, int) or isinstance(value, bool) or value <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")


def too_short(n: Column, k: int) -> Column:
    """True, or an error where fewer than ``k`` rows exist."""
    return F.when(n < k, F.raise_error(F.lit(f"sample size k={k} exceeds the number of rows")).cast("boolean")).otherwise(F.lit(True))


def _order_cols(id_cols: Sequence) -> list[Column]:
    return [F.col(PRIORITY)] + [F.col(c) if isinstance(c, str) else c for c in id_cols]


def with_priority(df: DataFrame, id_cols: Sequence, seed: int) -> DataFrame:
    return df.withColumn(PRIORITY, row_priority(df, seed, id_cols))


def prune_margin(k: int) -> float:
    return k + 8.0 * math.sqrt(k) + 16.0


def group_limit(spark) -> int:
    """Largest rank for which Spark plants a partial group limit."""
    return int(spark.conf.get(GROUP_LIMIT_KEY, "1000"))


def choose_strategy(num_partitions: int, k: int, limit: int = 1000) -> str:
    return "prune" if k > limit or num_partitions * k > PRUNE_ROWS else "window"


def rank_rows(pdf: DataFrame, keys: Sequence[str], k: int, order: Sequence) -> DataFrame:
    """Rows of rank at most k per key by ``order``, ranked by range-partitioned
    ordinals: no task holds a key's rows, and no key all of a task's."""
    from kpool.operators.ordinal import ordinal

    return ordinal(pdf, order, keys, out=RANK).filter(F.col(RANK) <= k)


def _window_sample(pdf: DataFrame, keys: Sequence[str], k: int, id_cols: Sequence) -> DataFrame:
    order = _order_cols(id_cols)
    if k > group_limit(pdf.sparkSession):  # a key's sample may be too large for one task
        return rank_rows(pdf, keys, k, order)
    if not keys:
        top = pdf.orderBy(*order).limit(k)
        return top.withColumn(RANK, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = pdf.withColumn(RANK, F.row_number().over(w))
    return ranked.filter(F.col(RANK) <= k).withColumn(RANK, F.col(RANK).cast("bigint"))


def _u60(col: Column) -> Column:
    return F.conv(F.substring(col, 1, HEX_DIGITS_FOR_DRAW), 16, 10).cast("bigint")


def pruned_candidates(pdf: DataFrame, keys: Sequence[str], k: int, counts: DataFrame | None = None) -> DataFrame | None:
    """Exact top-k candidates per key, or None when pruning does not apply.

    Keeps only rows whose priority lies below the per-key threshold, then
    checks that every key kept at least min(k, rows) rows (else None).
    ``counts`` (keys, ``_n``, ``_rows``) says of how many rows (``_n``) those
    in ``pdf`` (``_rows``) are the smallest; by default they are all.
    """
    margin = prune_margin(k)
    if counts is None:
        counts = pdf.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_rows", F.col("_n"))
    if not keys:
        row = counts.first()
        n, rows = (row["_n"] or 0, row["_rows"] or 0) if row else (0, 0)
        if n <= margin:
            return pdf
        cand = materialize(pdf.filter(F.col(PRIORITY) < F.lit(hex_threshold(margin / n))))
        return cand if cand.count() >= min(k, rows) else None
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    total = counts.agg(F.sum("_n").alias("t")).first()["t"] or 0
    # Only keys above hot_floor are pruned.  At most total / hot_floor keys can
    # be above it, so the threshold table is provably <= MAX_BROADCAST_KEYS
    # rows and is broadcast; other keys pass whole (each holds <= hot_floor
    # rows, and the partial group limit bounds what they shuffle).
    hot_floor = max(margin, total / MAX_BROADCAST_KEYS)
    alias = {c: f"_key{i}" for i, c in enumerate(keys)}
    thresholds = counts.filter(F.col("_n") > F.lit(hot_floor)).select(
        *[F.col(c).alias(a) for c, a in alias.items()],
        F.least(F.col("_rows"), F.lit(k)).alias("_need"),
        (F.floor(F.lit(margin) / F.col("_n") * F.lit(float(2**60))).cast("bigint") + 1).alias("_t"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    if thresholds.count() == 0:
        counts.unpersist()
        thresholds.unpersist()
        return pdf
    cond = [F.col(c).eqNullSafe(F.col(a)) for c, a in alias.items()]
    joined = pdf.join(F.broadcast(thresholds.drop("_need")), cond, "left").drop(*alias.values())
    cand = joined.filter(F.col("_t").isNull() | (_u60(F.col(PRIORITY)) < F.col("_t"))).drop("_t")
    cand = materialize(cand)
    # exactness check, for the pruned (hot) keys only
    have = cand.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")) \
        .select(*[F.col(c).alias(f"{a}_h") for c, a in alias.items()], "_c")
    hcond = [F.col(a).eqNullSafe(F.col(f"{a}_h")) for a in alias.values()]
    short_keys = (thresholds.join(have, hcond, "left")
                  .filter(F.coalesce(F.col("_c"), F.lit(0)) < F.col("_need"))
                  .limit(1).count())
    counts.unpersist()
    thresholds.unpersist()
    return None if short_keys else cand


def sample_by_key(
    df: DataFrame,
    keys: Sequence[str],
    k: int = DEFAULT_SIZE,
    id_cols: Sequence = (),
    seed: int = 0,
    short: str = "cap",
    strategy: str = "auto",
    do_spread: bool = True,
) -> DataFrame:
    """Uniform sample of k rows per key (all rows of keys with fewer than k).

    Adds ``priority`` and ``sample_rank`` (1 = smallest priority).
    ``short="error"`` raises when a key has fewer than k rows (the batch
    rule); ``"cap"`` keeps such keys whole (the stream rule).  ``do_spread``
    spreads an input that arrives in fewer partitions than cores (see
    ``kpool.plans.layout.spread``).
    """
    check_size("k", k)
    if short not in ("cap", "error"):
        raise ValueError("short must be 'cap' or 'error'")
    if strategy not in ("auto", "window", "prune"):
        raise ValueError("strategy must be 'auto', 'window' or 'prune'")
    keys = list(keys)
    if strategy == "auto":
        strategy = choose_strategy(estimated_partitions(df), k, group_limit(df.sparkSession))
    if do_spread:
        df = spread(df)
    pdf = with_priority(df, id_cols, seed)
    source = pdf
    if strategy == "prune":
        source = pruned_candidates(pdf, keys, k)
        if source is None:
            source = pdf
    out = _window_sample(source, keys, k, id_cols)
    if short == "error":
        # counted on the input, also where it is empty; a filter, so that the
        # check runs whatever columns are read later
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(too_short(F.col("_rows"), k))
        kept = out.columns
        if keys:
            counts = counts.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)], "_rows")
            same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)]
            out = out.join(counts, same).filter("_rows > 0").select(*kept)
        else:  # ranks 1..k where the check passes; an outer join, as an empty sample must not skip it
            out = counts.withColumn(RANK, F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(k).cast("bigint")))) \
                .filter("_rows > 0").select(RANK).join(out, RANK, "left").select(*kept)
    return out


def sample_k(df: DataFrame, k: int = DEFAULT_SIZE, id_cols: Sequence = (), seed: int = 0, short: str = "cap",
             strategy: str = "auto") -> DataFrame:
    """Uniform sample of k rows of the whole DataFrame (A3)."""
    return sample_by_key(df, [], k, id_cols, seed=seed, short=short, strategy=strategy)
