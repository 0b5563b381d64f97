"""The sample summary: one row per key with ``n`` (rows seen), ``k`` (sample
capacity) and ``items`` -- an array of ``struct<priority, value>`` sorted by
priority, so every prefix of ``items`` is itself a uniform sample.

``build_summary`` needs the key counts and the per-key top-k.  Both are
computed from the same input and brought together by a union + one
aggregation (no join, null keys stay a group).  Each key's item list is
bounded by k; the count side is pre-aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpool.operators.sample import DEFAULT_SIZE, PRIORITY, RANK, check_size, sample_by_key, too_short

ITEM = "item"


def value_column(value_cols: Sequence[str] | str) -> Column:
    """One value per row: the column itself, or a struct of several."""
    if isinstance(value_cols, str):
        return F.col(value_cols)
    value_cols = list(value_cols)
    if len(value_cols) == 1:
        return F.col(value_cols[0])
    return F.struct(*[F.col(c) for c in value_cols])


def build_summary(
    df: DataFrame,
    keys: Sequence[str],
    k: int = DEFAULT_SIZE,
    value_cols: Sequence[str] | str = (),
    id_cols: Sequence = (),
    seed: int = 0,
    short: str = "cap",
    strategy: str = "auto",
) -> DataFrame:
    """Summaries per key: ``keys..., n, k, items`` (A6).

    ``items`` holds min(k, n) items sorted by priority.
    """
    check_size("k", k)
    keys = list(keys)
    val = value_column(value_cols)
    if short not in ("cap", "error"):
        raise ValueError("short must be 'cap' or 'error'")
    sampled = sample_by_key(df, keys, k, id_cols, seed=seed, strategy=strategy)
    item_rows = sampled.select(
        *keys,
        F.lit(None).cast("bigint").alias("n"),
        F.struct(F.col(PRIORITY).alias("priority"), val.alias("value")).alias(ITEM),
    )
    count_rows = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "n", F.lit(None).cast(item_rows.schema[ITEM].dataType).alias(ITEM))
    )
    both = count_rows.unionByName(item_rows)
    out = both.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n"),
        F.lit(k).cast("bigint").alias("k"),
        F.sort_array(F.collect_list(ITEM)).alias("items"),
    )
    # a filter, so that the check runs whatever columns are read later
    return out.filter(too_short(F.col("n"), k)) if short == "error" else out


def explode_summary(summary: DataFrame, keys: Sequence[str] | None = None,
                    rank_col: str = RANK) -> DataFrame:
    """One row per item: ``keys..., n, k, sample_rank, priority, value``."""
    keep = [c for c in summary.columns if c not in ("items",)] if keys is None else list(keys) + ["n", "k"]
    return summary.select(*keep, F.posexplode("items").alias("_pos", "_item")).select(
        *keep,
        (F.col("_pos") + 1).cast("bigint").alias(rank_col),
        F.col("_item.priority").alias(PRIORITY),
        F.col("_item.value").alias("value"),
    )


# The text layout of a rendered summary (label, field names,
# the doubled blanks between fields, ", " between items, brackets).
RENDER_AT = " @ "
RENDER_STREAM = " stream size: "
RENDER_SAMPLE = " sample size: "
RENDER_DATA_SIZE = " sample data size: "
RENDER_DATA = " sample data: ["
RENDER_ITEM_SEP = ", "
RENDER_END = "]"
RENDER_NULL = "null"


def render_summary(n: Column, k: Column, items: Column, label: str = "SamplePool") -> Column:
    """Summary as text:
    ``SamplePool @  stream size: N  sample size: K  sample data size: M  sample data: [a, b]``.
    An empty summary renders ``[]``, a null item ``null``.
    """
    values = F.transform(items, lambda x: x["value"].cast("string"))
    return F.concat(
        F.lit(label + RENDER_AT),
        F.lit(RENDER_STREAM), n.cast("string"), F.lit(" "),
        F.lit(RENDER_SAMPLE), k.cast("string"), F.lit(" "),
        F.lit(RENDER_DATA_SIZE), F.size(items).cast("string"), F.lit(" "),
        F.lit(RENDER_DATA), F.array_join(values, RENDER_ITEM_SEP, RENDER_NULL), F.lit(RENDER_END),
    )
