"""Mixing sources to target weights: hierarchical token budgets.

The tree's levels are columns (say domain, language, source).  The corpus
budget flows from the root to the leaves: children share their parent's budget
by weight, none above its capacity (tokens below it times ``max_epochs``).
What a child cannot use is shared among its siblings, by weight, until they
are full too; as a parent's capacity is that of its subtree, only then does
the parent fall short and its own siblings take over.  This water level has a
closed form over a window of siblings ordered by capacity per weight.

A leaf of T tokens and budget b gives ``b // T`` whole epochs and, from the
seeded order of the next epoch, the longest prefix of rows within the rest.
Prefixes of large leaves are found from token sums of ``BUCKETS`` slices of the
order; only the slice in which a prefix ends is looked at row by row.

Defined cases: null level values form a child ``(none)``; a null text holds no
tokens; children without tokens or with weight 0 get nothing; a budget beyond
all capacity gives every leaf its capacity.  Rows of one id are ordered by
their text's MD5; equal rows are interchangeable.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from kpool.llm._io import cut

NONE = "(none)"
HEX = 4  # digits of the order that name a slice
BUCKETS = 16 ** HEX
BROADCAST_LEAVES = 100_000  # about 10 MB; more leaves are joined by a shuffle


def word_tokens(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, int]) -> Column:
    listed = F.lit(weights.get("*", 1))
    for name, w in weights.items():
        if name != "*":
            listed = F.when(F.col(level) == name, w).otherwise(listed)
    return listed.cast("long")


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], total: int | None = None,
            max_epochs: int = 4) -> DataFrame:
    """``leaves`` (levels, tokens) with their ``budget`` in tokens.

    ``weights``: for each level its values' relative weights (non-negative
    integers; ``"*"`` for values that are not listed, 1 by default).
    """
    if any(w < 0 or w != int(w) for by in weights.values() for w in by.values()) or max_epochs < 1:
        raise ValueError("weights are non-negative integers and max_epochs is at least 1")
    usable = leaves.filter("tokens > 0")
    for level in levels:
        usable = usable.filter(_weight(level, weights.get(level, {})) > 0)
    usable = usable.withColumn("_cap", F.col("tokens") * max_epochs).withColumn("_one", F.lit(1))
    at, above = None, ["_one"]
    for i, level in enumerate(levels):
        path = ["_one", *levels[:i + 1]]
        nodes = usable.groupBy(*path).agg(F.sum("_cap").alias("_c")).withColumn("_w", _weight(level, weights.get(level, {})))
        order = W.partitionBy(*above).orderBy(F.col("_c") / F.col("_w"), level)
        before = F.coalesce(F.sum("_c").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("_w").over(order.rowsBetween(0, W.unboundedFollowing))
        if at is None:  # the root's budget
            held = F.sum("_c").over(W.partitionBy("_one")) / max_epochs
            nodes = nodes.withColumn("_b", F.coalesce(F.lit(total), held).cast("double"))
        else:
            nodes = nodes.join(at, above)
        nodes = nodes.withColumn("_level", (F.col("_b") - before) / rest)
        nodes = nodes.withColumn("_water", F.max("_level").over(W.partitionBy(*above)))
        at = nodes.select(*path, F.least(F.col("_c").cast("double"), F.col("_water") * F.col("_w")).alias("_b"))
        above = path
    return (usable.join(at, above).withColumn("budget", F.floor(F.greatest(F.col("_b"), F.lit(0.0))).cast("long"))
            .select(*levels, "tokens", "budget"))


def _epoch_order(seed: int, id_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole").cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def select_epochs(docs: DataFrame, plan: DataFrame, levels: list[str], tokens: Column, seed: int,
                  id_col: str, tie: Column) -> DataFrame:
    """``docs`` (with the level columns) and ``copies``, how often each row is
    taken; rows never taken are left out."""
    placed = docs.join(plan, levels).withColumn("_o", _epoch_order(seed, id_col))
    placed = placed.withColumn("_slice", F.conv(F.substring("_o", 1, HEX), 16, 10).cast("int"))
    sure = F.col("_whole") + F.when(F.col("_slice") < F.col("_end"), 1).otherwise(0)
    rest = placed.filter(F.col("_slice") != F.col("_end")).withColumn("copies", sure)
    edge = placed.filter(F.col("_slice") == F.col("_end")).withColumn("_t", tokens)
    run = F.sum("_t").over(W.partitionBy(*levels).orderBy("_o", tie).rowsBetween(W.unboundedPreceding, 0))
    edge = edge.withColumn("copies", F.col("_whole") + F.when(run <= F.col("_room"), 1).otherwise(0)).drop("_t")
    return (rest.union(edge.select(*rest.columns)).filter("copies > 0")
            .drop("_whole", "_end", "_room", "_o", "_slice").withColumn("copies", F.col("copies").cast("int")))


def _slices(narrow: DataFrame, leaves: DataFrame, levels: list[str], seed: int) -> DataFrame:
    """For each leaf: whole epochs, the slice in which its prefix ends, and the
    room left for that slice's rows."""
    leaves = leaves.withColumn("_whole", F.floor(F.col("budget") / F.col("tokens")).cast("long"))
    leaves = leaves.select(*levels, "_whole", (F.col("budget") - F.col("_whole") * F.col("tokens")).alias("_r"))
    marked = narrow.join(leaves, levels).withColumn("_slice", F.conv(F.substring(_epoch_order(seed, "_id"), 1, HEX), 16, 10).cast("int"))
    sums = marked.groupBy(*levels, "_whole", "_r", "_slice").agg(F.sum("_tokens").alias("_t"))
    run = F.sum("_t").over(W.partitionBy(*levels).orderBy("_slice").rowsBetween(W.unboundedPreceding, 0))
    ends = sums.withColumn("_run", run).filter("_run > _r").groupBy(*levels, "_whole").agg(
        F.min("_slice").alias("_end"), F.min_by(F.col("_r") - F.col("_run") + F.col("_t"), "_slice").alias("_room"))
    # a leaf whose rest covers a whole epoch has no such slice; then b // T would be larger, so every leaf has one
    return ends


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], total: int | None = None,
        max_epochs: int = 4, seed: int = 42, id_col: str = "doc_id", text: str = "text", narrow_result: bool = False,
        copies: str = "copies") -> DataFrame:
    """Rows of ``docs`` with the times each is taken (column ``copies``, whose
    name ``docs`` must not use) after the budgets.

    ``levels`` names the tree's levels from the root and gives each as a
    column.  ``total`` is the budget in tokens (default: what the table holds).
    ``narrow_result``: id, levels, tokens and copies only, else all columns of
    ``docs`` (which may use the names of levels) and copies.
    """
    if copies in (levels if narrow_result else docs.columns):
        raise ValueError(f"{copies} is in use; name another column for the copies")
    names = list(levels)
    inner = [f"_level{i}" for i in range(len(names))]
    by = dict(zip(inner, (F.coalesce(c.cast("string"), F.lit(NONE)) for c in levels.values())))
    narrow = cut(docs.select(F.col(id_col).alias("_id"), *(c.alias(n) for n, c in by.items()), word_tokens(text).alias("_tokens"),
                             F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_tie")))
    leaves = narrow.groupBy(*inner).agg(F.sum("_tokens").alias("tokens"))
    plan = cut(budgets(leaves, inner, dict(zip(inner, (weights.get(n, {}) for n in names))), total, max_epochs))
    ends = cut(_slices(narrow, plan, inner, seed))
    if ends.count() <= BROADCAST_LEAVES:  # counted: texts need not move to meet their leaf
        ends = F.broadcast(ends)
    if narrow_result:
        got = select_epochs(narrow, ends, inner, F.col("_tokens"), seed, "_id", F.col("_tie"))
        return got.select(F.col("_id").alias(id_col), *(F.col(i).alias(n) for i, n in zip(inner, names)), F.col("_tokens").alias("tokens"), F.col("copies").alias(copies))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_id"), F.col(text).alias("_text"),
                       *(c.alias(n) for n, c in by.items()))
    got = select_epochs(rows, ends, inner, word_tokens("_text"), seed, "_id", F.md5(F.coalesce(F.col("_text"), F.lit(""))))
    return got.select("_row.*", F.col("copies").alias(copies))


def repeat_copies(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """One row for each copy."""
    kept = [c for c in mixed.columns if c != copies]
    return mixed.withColumn(copies, F.explode(F.sequence(F.lit(1), copies))).select(*kept)
