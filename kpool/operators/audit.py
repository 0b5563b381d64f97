"""Checks on samples that run as Spark jobs: per-origin counts of a merged
sample (A2/F2), set splitting by parity (F1/X1), and the inclusion audit
(how often each row is picked over many seeds; a uniform sampler picks each
of N rows in about k/N of the seeds)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpool.functions.tags import hex_threshold, identity_parts, priority
from kpool.operators.sample import check_size, prune_margin, sample_k
from kpool.plans.layout import materialize, spread


def parity(c) -> Column:
    """'odd' / 'even' of an integer column (pmod: also right for negatives)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.pmod(col, F.lit(2)) == 1, F.lit("odd")).otherwise(F.lit("even"))


def count_by(df: DataFrame, label: Column, name: str = "source", count_name: str = "cnt") -> DataFrame:
    """Rows per label in one pass (map-side combined)."""
    return df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).cast("bigint").alias(count_name))


def inclusion_top(df: DataFrame, k: int, id_cols: Sequence[str], seeds: int, n: int,
                  margin: float | None = None) -> DataFrame:
    """Per-seed top-k rows (``id_cols..., _seed, _p, _r``) among the candidate
    (row, seed) pairs whose priority lies below the threshold for n rows
    (``margin=inf`` keeps every pair).  Each row computes its ``seeds``
    priorities inside the row; only candidates are exploded."""
    ids = list(id_cols)
    base = df.select(*ids)
    parts = identity_parts(base, ids)
    margin = prune_margin(k) if margin is None else margin
    thr = hex_threshold(margin / max(n, 1))
    tagged = F.transform(F.sequence(F.lit(1), F.lit(seeds)),
                         lambda s: F.struct(s.alias("seed"), priority(s, *parts).alias("p")))
    cand = spread(base).select(*ids, F.explode(F.filter(tagged, lambda x: x["p"] < F.lit(thr))).alias("_t")) \
        .select(*ids, F.col("_t.seed").alias("_seed"), F.col("_t.p").alias("_p"))
    w = Window.partitionBy("_seed").orderBy("_p", *ids)
    return cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)


def inclusion_audit(df: DataFrame, k: int, id_cols: Sequence[str], seeds: int) -> DataFrame:
    """``id_cols..., times``: in how many of the seeds 1..seeds each row is
    in the size-k sample.

    Every row computes its ``seeds`` priorities inside the row (N x seeds
    hashes, no row replication).  With N known, a (row, seed) pair can only
    be in that seed's top k if its priority lies below (k + 8 sqrt(k) + 16)/N,
    so only those candidate pairs are exploded -- about seeds * (k + 8 sqrt(k))
    rows in all, not N * seeds.  A per-seed group limit then picks the exact
    top k.  Seeds that kept fewer than min(k, N) candidates (probability
    ~1e-15) are sampled again one by one from all rows, so the result is always
    exact.  Picks and rows meet in one aggregation, whatever seeds * k is."""
    check_size("k", k)
    check_size("seeds", seeds)
    ids = list(id_cols)
    base = df.select(*ids)
    n = base.count()
    if n == 0:
        return base.withColumn("times", F.lit(0).cast("bigint"))
    top = materialize(inclusion_top(base, k, ids, seeds, n))
    full = top.groupBy("_seed").count().filter(F.col("count") >= min(k, n)).select("_seed")
    picks = top.join(full, "_seed").select(*ids)
    if full.count() < seeds:
        short = base.sparkSession.range(1, seeds + 1).select(F.col("id").cast("int").alias("_seed")).join(full, "_seed", "left_anti")
        for row in short.collect():
            picks = picks.union(sample_k(base, k, ids, seed=row["_seed"]).select(*ids))
    rows = base.select(*ids, F.lit(0).alias("_t")).union(picks.select(*ids, F.lit(1).alias("_t")))
    return rows.groupBy(*ids).agg(F.sum("_t").cast("bigint").alias("times"))
