"""Summaries as rows, for sample sizes that no single row or task should hold.

A summary is two tables: ``stats`` (``keys..., n, k``; one row per key) and
``items`` (``keys..., priority, value, sample_rank``).  Built and merged without
``collect_list``: what can be in the sample is found by a priority threshold that
follows from n, and ranked by range-partitioned ordinals.  ``merge_summaries`` is
the array form, for k up to about 100 000.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpool.operators.merge import _comparable, _rule_r
from kpool.operators.sample import DEFAULT_SIZE, PRIORITY, RANK, check_size, pruned_candidates, rank_rows, sample_by_key
from kpool.operators.summary import value_column
from kpool.plans.layout import materialize

Rows = tuple[DataFrame, DataFrame]


def build_rows(df: DataFrame, keys: Sequence[str], k: int = DEFAULT_SIZE, value_cols: Sequence[str] | str = (), id_cols: Sequence = (),
               seed: int = 0, strategy: str = "auto") -> Rows:
    """(stats, items) of the samples of size k per key (A6 in row form)."""
    check_size("k", k)
    keys = list(keys)
    sampled = sample_by_key(df, keys, k, id_cols, seed=seed, strategy=strategy)
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(k).cast("bigint"))
    return stats, sampled.select(*keys, PRIORITY, value_column(value_cols).alias("value"), RANK)


def merge_rows(parts: Sequence[Rows], keys: Sequence[str], m: int = DEFAULT_SIZE, short: str = "cap") -> Rows:
    """MERGE of any number of summaries in row form (A8, A12), under Rule R:
    a part that does not hold its whole input (n > k) bounds m by its k."""
    check_size("m", m)
    keys = list(keys)
    if not parts:
        raise ValueError("no summaries to merge")
    stats, items = parts[0][0].select(*keys, "n", "k"), parts[0][1].select(*keys, PRIORITY, "value")
    for s, i in parts[1:]:
        stats, items = stats.unionByName(s.select(*keys, "n", "k")), items.unionByName(i.select(*keys, PRIORITY, "value"))
    stats = materialize(stats.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n"), F.min(F.when(F.col("n") > F.col("k"), F.col("k"))).cast("bigint").alias("_kmin"),
        F.sum(F.least("n", "k")).cast("bigint").alias("_rows")))
    sized = stats.withColumn("k", _rule_r(m, F.col("_kmin"), short, F.col("n")))
    if short == "error":  # a filter, so that the check runs whatever columns are read later
        sized = sized.filter("k > 0")
    items = items.withColumn(PRIORITY, _comparable(F.col(PRIORITY)))
    pruned = pruned_candidates(items, keys, m, stats.select(*keys, F.col("n").alias("_n"), "_rows"))
    top = rank_rows(items if pruned is None else pruned, keys, m, [PRIORITY, "value"])
    if keys:
        bound = sized.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)], F.col("k").alias("_m"))
        same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)]
        top = top.join(bound, same).filter(F.col(RANK) <= F.col("_m"))
    else:
        row = sized.first()  # one number
        top = top.filter(F.col(RANK) <= (row["k"] if row and row["k"] is not None else 0))
    return sized.select(*keys, "n", "k"), top.select(*keys, PRIORITY, "value", RANK)
