"""Consume-once pairing of two keyed sequences (J1).

Per key, items of two sides (L, R) arrive in order.  At most one unmatched
item is held.  An arrival of the other side pairs with it and clears it; an
arrival of the same side replaces it (the older one is dropped); the
arriving item is not kept after a match.

One plan for all sizes.  The rows are range-partitioned by (keys, order), so a
key that holds a third of all rows spans many partitions; the rows of a key in
a partition are a *slice*.

*Within a slice*, cut the rows into maximal same-side runs 1, 2, ...  What is
held before the slice matters in one way only: either it is nothing or of the
first run's side (case A: no pair at run 1, which ends with an item held), or
it is of the other side (case B: it pairs with run 1's first item, and run 1
ends with an item held iff it has more).  Later runs end with an item held iff
they are longer than 1 or the run before did not.  So with j the last run <= i
longer than 1, run i ends held iff i - j is even; without such a j, iff i is
odd (A) or even (B).  A pair is emitted at run i >= 2 iff run i - 1 ended held,
joining the last item of run i - 1 with the first item of run i.

*Across slices*, the case of a slice is a function of the case of the key's
slice before: constant, equal or opposite.  The case is thus that of the last
constant, turned over by the number of opposites since: running windows over
one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpool.operators.ordinal import LOW_BITS
from kpool.plans.layout import materialize


def _even(c: Column) -> Column:
    return F.pmod(c, F.lit(2)) == 0


def pair_latest_unmatched(
    df: DataFrame,
    keys: Sequence[str],
    side: Column,
    order: Sequence,
    id_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Pairs ``keys..., left_id, right_id, right_first`` from rows of ``df``.

    ``side`` is a boolean Column: true = left side, false = right side
    (rows where it is null are ignored).  ``order`` must be a total order
    within a key.  ``right_first`` is true when the held item was the right
    one (the pair closed on a left arrival).  ``num_partitions`` fixes the
    number of range partitions (by default sized from the data).
    """
    keys = list(keys)
    ocols = [F.col(c) if isinstance(c, str) else c for c in order]
    onames = [f"_o{i}" for i in range(len(ocols))]
    e = df.select(*keys, side.alias("_left"), *[c.alias(n) for c, n in zip(ocols, onames)], F.col(id_col).alias("_id")) \
        .filter(F.col("_left").isNotNull())
    by = [*keys, *onames]
    ranged = e.repartitionByRange(*by) if num_partitions is None else e.repartitionByRange(num_partitions, *by)
    ranged = ranged.sortWithinPartitions(*by).select(*keys, "_left", "_id", F.monotonically_increasing_id().alias("_at"))
    # written once: range bounds come from a sample, and two readers could see different ones
    e = materialize(ranged).withColumn("_pid", F.shiftright("_at", LOW_BITS))

    in_slice = Window.partitionBy("_pid", *keys).orderBy("_at")
    prev = F.lag("_left").over(in_slice)
    e = e.withColumn("_new", F.when(prev.isNull() | (prev != F.col("_left")), 1).otherwise(0))
    e = e.withColumn("_run", F.sum("_new").over(in_slice.rowsBetween(Window.unboundedPreceding, 0)))
    runs = e.groupBy("_pid", *keys, "_run").agg(
        F.count(F.lit(1)).alias("_len"),
        F.first("_left").alias("_left"),
        F.min_by("_id", "_at").alias("_first_id"),
        F.max_by("_id", "_at").alias("_last_id"),
    )
    by_run = Window.partitionBy("_pid", *keys).orderBy("_run")
    upto = by_run.rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("_j", F.last(F.when(F.col("_len") >= 2, F.col("_run")), ignorenulls=True).over(upto))
    since = _even(F.col("_run") - F.col("_j"))
    runs = runs.withColumn("_held_a", F.coalesce(since, ~_even(F.col("_run")))) \
        .withColumn("_held_b", F.coalesce(since, _even(F.col("_run"))))
    inner = runs.select("_pid", *keys, "_left", "_first_id", F.lag("_last_id").over(by_run).alias("_other_id"),
                        F.lag("_held_a").over(by_run).alias("_pair_a"), F.lag("_held_b").over(by_run).alias("_pair_b")) \
        .filter(F.col("_pair_a") | F.col("_pair_b"))

    # one row per slice; the case of each: true = B
    end = F.max_by(F.struct("_held_a", "_held_b", "_left", "_last_id"), "_run")
    start = F.min_by(F.struct("_left", "_first_id"), "_run")
    slices = runs.groupBy("_pid", *keys).agg(start.alias("_start"), end.alias("_end"))
    by_pid = Window.partitionBy(*keys).orderBy("_pid") if keys else Window.orderBy("_pid")
    before = F.lag("_end").over(by_pid)
    turned = before["_left"] != F.col("_start._left")
    slices = slices.withColumn("_before", before) \
        .withColumn("_from_a", F.coalesce(before["_held_a"] & turned, F.lit(False))) \
        .withColumn("_from_b", F.coalesce(before["_held_b"] & turned, F.lit(False)))
    fixed, opposite = F.col("_from_a") == F.col("_from_b"), F.col("_from_a") & ~F.col("_from_b")
    so_far = by_pid.rowsBetween(Window.unboundedPreceding, 0)
    slices = slices.withColumn("_turns", F.sum(opposite.cast("int")).over(so_far))
    mark = F.last(F.when(fixed, F.struct(F.col("_from_a").alias("b"), F.col("_turns").alias("t"))), ignorenulls=True).over(so_far)
    slices = slices.withColumn("_mark", mark)
    slices = slices.withColumn("_case_b", F.col("_mark.b") != ~_even(F.col("_turns") - F.col("_mark.t")))

    cross = slices.filter("_case_b").select(*keys, F.col("_start._left").alias("_left"), F.col("_start._first_id").alias("_first_id"),
                                            F.col("_before._last_id").alias("_other_id"))
    cases = slices.select(F.col("_pid").alias("_spid"), *[F.col(c).alias(f"_sk{i}") for i, c in enumerate(keys)], "_case_b")
    same = [F.col("_pid") == F.col("_spid")] + [F.col(c).eqNullSafe(F.col(f"_sk{i}")) for i, c in enumerate(keys)]
    chosen = inner.join(cases, same).filter(F.when(F.col("_case_b"), F.col("_pair_b")).otherwise(F.col("_pair_a")))
    pairs = chosen.select(*keys, "_left", "_first_id", "_other_id").union(cross)
    return pairs.select(
        *keys,
        F.when(F.col("_left"), F.col("_first_id")).otherwise(F.col("_other_id")).alias("left_id"),
        F.when(F.col("_left"), F.col("_other_id")).otherwise(F.col("_first_id")).alias("right_id"),
        F.col("_left").alias("right_first"),
    )
