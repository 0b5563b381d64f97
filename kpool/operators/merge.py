"""MERGE of sample summaries.

``merge_summaries`` -- the exact merge.  Items carry priorities, so the
uniform sample of the union of the inputs is simply the m smallest
priorities of the union of their items, and ``n`` adds up.  Works for any
number of summaries per output key (merge trees, roll-ups to coarser keys).

``merge_weighted`` -- the two-sided merge for items whose priorities cannot
be compared (e.g. reservoirs filled by slot replacement): m times, take the
next item from side 1 with probability n1 / (n1 + n2), else from side 2, and
decrement that side's n.  The m steps run as one ``aggregate`` fold inside a
row; the draws are seeded tags, so the result is reproducible.

Rule R (both merges): a side is *complete* when it holds its whole input
(n = size(items)).  An exact merge of size m needs m <= k for every
incomplete side.  ``short="cap"`` lowers m to the smallest such k (and the
output ``k`` says so); ``short="error"`` raises.  m is also cut to n1 + n2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpool.functions.tags import draw, id_text, priority
from kpool.operators.reservoir import SLOT_TAG
from kpool.operators.sample import DEFAULT_SIZE, PRIORITY, check_size, group_limit, pruned_candidates
from kpool.plans.layout import materialize

ITEM = "item"
DRAWN_TAG = "drawn-"  # marks items of a weighted merge: their order is random, but not comparable
PRIORITY_LENGTH = 32  # digits of a comparable priority


def _comparable(tag: Column) -> Column:
    """The tag, or an error where it is no priority of a row."""
    return F.when(tag.isNull() | (F.length(tag) == PRIORITY_LENGTH), tag).otherwise(
        F.raise_error(F.lit("summaries of reservoirs or weighted merges have no comparable priorities; use merge_weighted")))


def one_row_each(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summaries with an error where a key (or, without keys, the side) has
    more than one row."""
    one = F.count(F.lit(1))
    cols = [c for c in df.columns if c not in keys]
    found = df.groupBy(*keys).agg(one.alias("_rows"), F.first(F.struct(*cols)).alias("_row"))
    found = found.filter(F.when(F.col("_rows") > 1, F.raise_error(F.lit("a side of merge_weighted has several summaries of one key"))
                                .cast("boolean")).otherwise(F.lit(True)))
    return found.filter("_rows > 0").select(*keys, "_row.*")


def _incomplete_k(n: Column, k: Column, items: Column) -> Column:
    return F.when(n > F.size(items), k)


def _rule_r(m: int, kmin: Column, short: str, n: Column) -> Column:
    m_eff = F.least(F.lit(m).cast("bigint"), F.coalesce(kmin, F.lit(m).cast("bigint")))
    if short == "error":
        none = F.raise_error(F.lit(f"merge size m={m} exceeds the rows of the inputs, or an input is empty"))
        return F.when((n <= 0) | (n < m), none).when(m_eff < m, F.raise_error(F.lit(
            f"merge size m={m} exceeds the capacity of an incomplete input summary"))).otherwise(m_eff)
    if short != "cap":
        raise ValueError("short must be 'cap' or 'error'")
    return m_eff


def merge_summaries(summaries: DataFrame, keys: Sequence[str], m: int = DEFAULT_SIZE, short: str = "cap",
                    materialize_input: bool = True) -> DataFrame:
    """Merge all summary rows sharing ``keys`` into one summary of size m.

    Input columns: ``keys..., n, k, items`` (other columns are ignored).
    Plan: explode items -> per-key top-m (partial WindowGroupLimit before the
    shuffle, so at most m items per key per partition move) -> union with
    per-key (sum n, min incomplete k), pre-aggregated map-side -> one
    aggregation.  Both branches read the input, so it is materialised once
    in the shared checkpoint folder (summaries hold at most k items per
    row); pass ``materialize_input=False`` when it is already a table scan.
    """
    check_size("m", m)
    keys = list(keys)
    if materialize_input:
        summaries = materialize(summaries)
    item_type = summaries.schema["items"].dataType.elementType
    stats = summaries.select(
        *keys,
        F.col("n").cast("bigint").alias("n"),
        _incomplete_k(F.col("n"), F.col("k"), F.col("items")).cast("bigint").alias("_kmin"),
        F.lit(None).cast(item_type).alias(ITEM),
    )
    exploded = summaries.select(*keys, F.explode("items").alias(ITEM))
    exploded = exploded.withColumn(ITEM, F.col(ITEM).withField("priority", _comparable(F.col(f"{ITEM}.priority"))))
    if m > group_limit(summaries.sparkSession):  # Spark plants no partial limit there: prune by priority first
        counts = summaries.groupBy(*keys).agg(F.sum("n").alias("_n"), F.sum(F.size("items")).cast("bigint").alias("_rows"))
        pruned = pruned_candidates(exploded.withColumn(PRIORITY, F.col(f"{ITEM}.priority")), keys, m, counts)
        exploded = exploded if pruned is None else pruned.drop(PRIORITY)
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    top = (
        exploded.withColumn("_r", F.row_number().over(w.orderBy(F.col(f"{ITEM}.priority"), F.col(ITEM))))
        .filter(F.col("_r") <= m)
        .select(*keys, F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("_kmin"), ITEM)
    )
    grouped = stats.unionByName(top).groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n"),
        F.min("_kmin").alias("_kmin"),
        F.sort_array(F.collect_list(ITEM)).alias("_items"),
    )
    m_eff = _rule_r(m, F.col("_kmin"), short, F.col("n"))
    if short == "error":  # a filter, so that the check runs whatever columns are read later
        grouped = grouped.filter(m_eff > 0)
    return grouped.select(
        *keys,
        "n",
        m_eff.alias("k"),
        F.slice(F.col("_items"), 1, m_eff.cast("int")).alias("items"),
    )


def _key_text(keys: Sequence[str], types: dict) -> Column:
    if not keys:
        return F.lit("")
    return F.concat_ws("|", *[id_text(c, types.get(c)) for c in keys])


def permute_items(items: Column, seed: int, salt: Column) -> Column:
    """Items re-ordered by a seeded tag of (salt, position): a uniform random
    order, so any prefix is a uniform sample (for slot-ordered reservoirs)."""
    tagged = F.transform(items, lambda x, i: F.struct(
        priority(seed, F.lit("perm"), salt, i.cast("string")).alias("_tag"), x.alias("_x")))
    return F.transform(F.array_sort(tagged), lambda t: t["_x"])


def merge_weighted(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    m: int = DEFAULT_SIZE,
    seed: int = 0,
    short: str = "cap",
    permute: bool | None = None,
) -> DataFrame:
    """Weighted MERGE of two summaries per key (A7/A8, intended semantics).

    Each side is ``keys..., n, k, items``; a key missing on one side merges
    with an empty summary (n = 0).  Output: ``keys..., n, k, c1, c2, items``
    where ``c1``/``c2`` items were taken from the front of left/right.
    Output items get fresh tags (seeded, of key, side and position) and are
    sorted by them, so the result is again in random order; the tags are
    marked, as they cannot be compared with rows' priorities.  Each side holds
    one summary per key, several raise.  ``permute=None`` brings items in slot
    order (reservoirs) into a seeded random order first and leaves others.
    """
    check_size("m", m)
    keys = list(keys)
    types = {f.name: f.dataType for f in left.schema.fields}
    left = one_row_each(left.select(*keys, "n", "k", "items"), keys)
    right = one_row_each(right.select(*keys, "n", "k", "items"), keys)
    l2 = left.select(*keys, F.col("n").alias("_n1"), F.col("k").alias("_k1"), F.col("items").alias("_i1"))
    r2 = right.select(*[F.col(c).alias(f"_rk_{c}") for c in keys],
                      F.col("n").alias("_n2"), F.col("k").alias("_k2"), F.col("items").alias("_i2"))
    if keys:
        cond = [F.col(c).eqNullSafe(F.col(f"_rk_{c}")) for c in keys]
        j = l2.join(r2, cond, "full_outer")
        j = j.select(*[F.coalesce(F.col(c), F.col(f"_rk_{c}")).alias(c) for c in keys],
                     "_n1", "_k1", "_i1", "_n2", "_k2", "_i2")
    else:
        # one summary per side: a union + aggregation instead of a join
        u = l2.select("_n1", "_k1", "_i1", *[F.lit(None).cast(t).alias(c) for c, t in
                                             (("_n2", "bigint"), ("_k2", "bigint"))],
                      F.lit(None).cast(r2.schema["_i2"].dataType).alias("_i2"))
        v = r2.select(*[F.lit(None).cast(t).alias(c) for c, t in (("_n1", "bigint"), ("_k1", "bigint"))],
                      F.lit(None).cast(l2.schema["_i1"].dataType).alias("_i1"), "_n2", "_k2", "_i2")
        j = u.unionByName(v).agg(*[F.first(c, ignorenulls=True).alias(c)
                                   for c in ("_n1", "_k1", "_i1", "_n2", "_k2", "_i2")])
    item_type = l2.schema["_i1"].dataType
    n1 = F.coalesce(F.col("_n1"), F.lit(0)).cast("bigint")
    n2 = F.coalesce(F.col("_n2"), F.lit(0)).cast("bigint")
    i1 = F.coalesce(F.col("_i1"), F.array().cast(item_type))
    i2 = F.coalesce(F.col("_i2"), F.array().cast(item_type))
    key_txt = _key_text(keys, types)
    if permute is not False:
        def shuffled(items: Column, side: str) -> Column:
            mixed = permute_items(items, seed, F.concat(key_txt, F.lit(side)))
            return mixed if permute else F.when(F.get(items, F.lit(0))["priority"].startswith(SLOT_TAG), mixed).otherwise(items)

        i1, i2 = shuffled(i1, "|L"), shuffled(i2, "|R")
    kmin = F.least(_incomplete_k(n1, F.col("_k1"), i1), _incomplete_k(n2, F.col("_k2"), i2))
    m_eff = F.least(_rule_r(m, kmin, short, n1 + n2), n1 + n2)
    if short == "error":
        empty = F.raise_error(F.lit("a side of the merge is empty")).cast("boolean")
        j = j.filter(F.when((n1 <= 0) | (n2 <= 0), empty).otherwise(m_eff > 0))
    j = j.select(*keys, n1.alias("_n1"), n2.alias("_n2"), i1.alias("_i1"), i2.alias("_i2"),
                 m_eff.alias("_m"), key_txt.alias("_kt"))

    def step(acc, i):
        j_draw = draw(seed, "merge", F.col("_kt"), i, bound=acc["a"] + acc["b"])
        take_left = j_draw < acc["a"]
        return F.struct(
            F.when(take_left, acc["a"] - 1).otherwise(acc["a"]).alias("a"),
            F.when(take_left, acc["b"]).otherwise(acc["b"] - 1).alias("b"),
            F.when(take_left, acc["c1"] + 1).otherwise(acc["c1"]).alias("c1"),
            F.when(take_left, acc["c2"]).otherwise(acc["c2"] + 1).alias("c2"),
        )

    init = F.struct(F.col("_n1").alias("a"), F.col("_n2").alias("b"),
                    F.lit(0).cast("bigint").alias("c1"), F.lit(0).cast("bigint").alias("c2"))
    steps = F.when(F.col("_m") >= 1, F.sequence(F.lit(1).cast("bigint"), F.col("_m"))) \
        .otherwise(F.array().cast("array<bigint>"))
    j = j.withColumn("_fold", F.aggregate(steps, init, step))
    c1 = F.col("_fold.c1")
    c2 = F.col("_fold.c2")
    taken_l = F.transform(F.slice(F.col("_i1"), 1, c1.cast("int")), lambda x, i: F.struct(
        F.concat(F.lit(DRAWN_TAG), priority(seed, F.lit("w"), F.col("_kt"), F.lit("L"), i.cast("string"))).alias("priority"),
        x["value"].alias("value")))
    taken_r = F.transform(F.slice(F.col("_i2"), 1, c2.cast("int")), lambda x, i: F.struct(
        F.concat(F.lit(DRAWN_TAG), priority(seed, F.lit("w"), F.col("_kt"), F.lit("R"), i.cast("string"))).alias("priority"),
        x["value"].alias("value")))
    return j.select(
        *keys,
        (F.col("_n1") + F.col("_n2")).alias("n"),
        F.col("_m").alias("k"),
        c1.alias("c1"),
        c2.alias("c2"),
        F.array_sort(F.concat(taken_l, taken_r)).alias("items"),
    )


def merge_sides(
    summaries: DataFrame,
    keys: Sequence[str],
    side: str,
    m: int = DEFAULT_SIZE,
    seed: int = 0,
    short: str = "cap",
    permute: bool | None = None,
) -> DataFrame:
    """Weighted MERGE of any number of summaries per key whose items' priorities
    cannot be compared (reservoirs): ``keys..., n, k, items``.

    ``summaries`` has ``keys..., side, n, k, items``, one row per key and side;
    several raise.  A sample of m of the union takes a multivariate
    hypergeometric number from each side.  It is drawn side after side: of the
    draws left, those that fall on this side and not on the later ones are counted
    by seeded draws without replacement; the rest go on.  This fold reads the
    sides' n only; items stay where they are until their side's number is known,
    and then the front of each side's (permuted) items is taken.

    Rule R, ``short`` and ``permute`` as in ``merge_weighted``, over all sides.
    """
    check_size("m", m)
    keys = list(keys)
    if short not in ("cap", "error"):
        raise ValueError("short must be 'cap' or 'error'")
    types = {f.name: f.dataType for f in summaries.schema.fields}
    rows = materialize(one_row_each(summaries.select(*keys, side, "n", "k", "items"), [*keys, side]))
    key_txt = _key_text(keys, types)
    side_txt = id_text(side, types.get(side))
    stats = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(side_txt.alias("s"), F.col("n").cast("bigint").alias("n")))).alias("_sides"),
        F.sum("n").cast("bigint").alias("_n"), F.min(F.col("n")).alias("_least"),
        F.min(_incomplete_k(F.col("n"), F.col("k"), F.col("items"))).cast("bigint").alias("_kmin"))
    m_eff = F.least(_rule_r(m, F.col("_kmin"), short, F.col("_n")), F.col("_n"))
    if short == "error":
        empty = F.raise_error(F.lit("a side of the merge is empty")).cast("boolean")
        stats = stats.filter(F.when(F.col("_least") <= 0, empty).otherwise(m_eff > 0))
    stats = stats.select(*keys, "_sides", "_n", m_eff.alias("_m"), key_txt.alias("_kt"))
    zero = F.lit(0).cast("bigint")

    def of_side(acc, s):
        """How many of the ``acc.m`` draws left fall on side ``s``; later sides hold ``acc.rest - s.n``."""
        def one(d, i):
            hit = draw(seed, "side", F.col("_kt"), s["s"], i, bound=d["a"] + d["b"]) < d["a"]
            return F.struct(F.when(hit, d["a"] - 1).otherwise(d["a"]).alias("a"), F.when(hit, d["b"]).otherwise(d["b"] - 1).alias("b"),
                            F.when(hit, d["c"] + 1).otherwise(d["c"]).alias("c"))

        steps = F.when(acc["m"] >= 1, F.sequence(F.lit(1).cast("bigint"), acc["m"])).otherwise(F.array().cast("array<bigint>"))
        drawn = F.aggregate(steps, F.struct(s["n"].alias("a"), (acc["rest"] - s["n"]).alias("b"), zero.alias("c")), one, lambda d: d["c"])
        # a one-element array binds the count, so that the draws are made once
        return F.get(F.transform(F.array(drawn), lambda c: F.struct(
            (acc["m"] - c).alias("m"), (acc["rest"] - s["n"]).alias("rest"),
            F.concat(acc["taken"], F.array(F.struct(s["s"].alias("s"), c.alias("c")))).alias("taken"))), F.lit(0))

    none = F.array().cast("array<struct<s:string,c:bigint>>")
    folded = F.aggregate("_sides", F.struct(F.col("_m").alias("m"), F.col("_n").alias("rest"), none.alias("taken")), of_side)
    counts = materialize(stats.select(*keys, "_n", "_m", "_kt", folded["taken"].alias("_taken")))
    taken = counts.select(*keys, "_kt", F.explode("_taken").alias("_t")).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_kt", F.col("_t.s").alias("_s"), F.col("_t.c").alias("_c")).filter(F.col("_c") > 0)
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)] + [side_txt == F.col("_s")]
    items = F.col("items")
    if permute is not False:
        mixed = permute_items(items, seed, F.concat("_kt", F.lit("|"), "_s"))
        items = mixed if permute else F.when(F.get(items, F.lit(0))["priority"].startswith(SLOT_TAG), mixed).otherwise(items)
    tag = lambda i: F.concat(F.lit(DRAWN_TAG), priority(seed, F.lit("s"), F.col("_kt"), F.col("_s"), i.cast("string")))
    chosen = rows.join(taken, same).select(*keys, "_kt", "_s", F.slice(items, 1, F.col("_c").cast("int")).alias("_items")) \
        .select(*keys, F.explode(F.transform("_items", lambda x, i: F.struct(tag(i).alias("priority"), x["value"].alias("value")))).alias(ITEM))
    heads = counts.select(*keys, F.col("_n").alias("n"), F.col("_m").alias("k"), F.lit(None).cast(chosen.schema[ITEM].dataType).alias(ITEM))
    tails = chosen.select(*keys, F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("k"), ITEM)
    return heads.unionByName(tails).groupBy(*keys).agg(F.max("n").alias("n"), F.max("k").alias("k"), F.sort_array(F.collect_list(ITEM)).alias("items"))
