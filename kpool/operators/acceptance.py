"""The element-by-element changelog of a sample, without a loop over elements.

The sample after n elements of a key is the k smallest (priority, n) among the
first n.  Element n changes it iff fewer than k earlier elements are smaller:
it is *accepted*.  The **acceptance log** holds the accepted elements, each with
``n`` (when it entered) and ``to_n`` (the n at which it was pushed out; null
while it is held), about k (1 + ln(N / k)) rows a key.  It is the compact form of
all N summaries: that after n is the rows with ``n`` <= n < ``to_n``.

How it is found
---------------
1. Elements get their n (``ordinal``), which cuts each key into blocks that
   double in length; the first holds the elements below 8 k.
2. The k smallest of each block give, merged over the blocks before, the sample
   held at a block's start.  Its largest item bounds what the block can accept;
   about k elements a block remain.
3. Within (key, block), *smaller and earlier* elements are counted by halving:
   on each level the group is cut into pairs of halves by its order in n, and in
   a window by priority each element of a second half counts those of its first
   half.  No pairs are formed, and a hot key is spread over its blocks.
4. Samples shrink from the top, so what acceptances push out falls in priority:
   the j-th acceptance after the sample is full pushes out the j-th largest
   item ever held.  Two row numbers give ``to_n``.

The same function goes on from a stored sample (``held``, ``seen``): the held
items are the sample at the start of every block, so micro-batches compose.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpool.operators.ordinal import MAX_BROADCAST_SLICES, ordinal
from kpool.operators.sample import DEFAULT_SIZE, PRIORITY, check_size, group_limit, pruned_candidates, with_priority
from kpool.operators.summary import value_column
from kpool.plans.layout import materialize

FIRST_BLOCK = 8        # times k: elements below this are one block
BIN = 1 << 12          # instants of a key that one task looks up together
DEALT = 1 << 18        # elements whose levels one task sorts


def _same(keys: Sequence[str], left: str, right: str) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in keys]


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence, value_cols: Sequence[str] | str, id_cols: Sequence, seed: int = 0,
                seen: DataFrame | None = None, num_partitions: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``keys..., n, priority, value, keep...``: rows with their place per key
    (after ``seen`` earlier ones) and their priority."""
    names = [c if isinstance(c, str) and c in keep else f"_by{i}" for i, c in enumerate(order)]  # kept columns go along once
    rows = with_priority(df, id_cols, seed).select(
        *keys, *keep, PRIORITY, value_column(value_cols).alias("value"),
        *[(F.col(c) if isinstance(c, str) else c).alias(o) for c, o in zip(order, names) if o not in keep])
    numbered = ordinal(rows, names, keys, out="n", num_partitions=num_partitions, start=seen)
    return numbered.select(*keys, "n", PRIORITY, "value", *keep)


def acceptance_log(numbered: DataFrame, keys: Sequence[str], k: int = DEFAULT_SIZE, held: DataFrame | None = None,
                   k_of: Column | None = None) -> DataFrame:
    """``keys..., n, priority, value, to_n, is_new`` of all items held at some n.

    ``numbered`` has ``keys..., n, priority, value`` (``number_rows``).  ``held``
    (same columns) is the sample before the first of them, complete for all keys;
    its items come out too, with ``is_new`` false.  ``k_of``, a column over the
    keys, gives keys a size of their own, of which ``k`` is then the largest.
    Null keys are a key.  Equal priorities (repeated identities) rank by n.
    """
    check_size("k", k)
    keys = list(keys)
    kcol = F.lit(k) if k_of is None else k_of
    by_key = Window.partitionBy(*keys)
    smallest = [F.col(PRIORITY), F.col("n")]
    block = F.when(F.col("n") < FIRST_BLOCK * k, 0).otherwise(F.length(F.bin(F.expr(f"n div {FIRST_BLOCK * k}"))))
    rows = numbered.select(*keys, "n", PRIORITY, "value").withColumn("_block", block)

    # 2. the sample at the start of each block
    narrow = rows.select(*keys, "_block", "n", PRIORITY)
    if k > group_limit(rows.sparkSession):  # Spark plants no partial limit there
        pruned = pruned_candidates(narrow, [*keys, "_block"], k)
        narrow = narrow if pruned is None else pruned
    in_block = Window.partitionBy(*keys, "_block").orderBy(*smallest)
    low = narrow.withColumn("_r", F.row_number().over(in_block)).filter(F.col("_r") <= k).drop("_r")
    if held is not None:
        low = low.unionByName(held.select(*keys, F.lit(-1).alias("_block"), "n", PRIORITY))
    low = low.withColumn("_end", F.max("_block").over(by_key)) \
        .withColumn("_begin", F.min(F.when(F.col("_block") >= 0, F.col("_block"))).over(by_key)) \
        .filter(F.col("_block") < F.col("_end"))
    later = F.sequence(F.greatest(F.col("_block") + 1, F.col("_begin")), F.col("_end"))
    before = low.select(*keys, F.explode(later).alias("_b"), "n", PRIORITY)
    in_start = Window.partitionBy(*keys, "_b").orderBy(*smallest)
    before = materialize(before.withColumn("_r", F.row_number().over(in_start)).filter(F.col("_r") <= kcol))
    bound = before.filter(F.col("_r") == kcol).select(*keys, F.col("_b").alias("_block"), F.col(PRIORITY).alias("_most"))

    size = bound.limit(MAX_BROADCAST_SLICES + 1).count()
    if size:
        bound = F.broadcast(bound) if size <= MAX_BROADCAST_SLICES else bound
        rows = rows.alias("r").join(bound.alias("t"), [*_same([*keys, "_block"], "r", "t")], "left") \
            .filter(F.col("t._most").isNull() | (F.col(f"r.{PRIORITY}") < F.col("t._most"))).select("r.*")
        rows = materialize(rows)
    found = rows  # without a bound, the rows as they are numbered

    # 3. smaller and earlier ones, by halving
    pool = found.select(*keys, F.col("_block").alias("_b"), "n", PRIORITY, F.lit(True).alias("is_new")) \
        .unionByName(before.select(*keys, "_b", "n", PRIORITY, F.lit(False).alias("is_new")))
    # a row becomes one per level, which its bytes before do not tell: tasks are cut by rows, and levels carry numbers only
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // DEALT))
    pool = pool.repartition(tasks, *keys, "_b")
    group = Window.partitionBy(*keys, "_b")
    pool = pool.withColumn("_size", F.row_number().over(group.orderBy(*smallest))) \
        .withColumn("_at", F.row_number().over(group.orderBy("n")) - 1).withColumn("_last", F.max("_at").over(group))
    levels = pool.select(*keys, "_b", "n", "is_new", "_size", "_at", F.explode(F.sequence(F.lit(0), F.length(F.bin("_last")) - 1)).alias("_level"))
    levels = levels.withColumn("_half", F.expr("shiftright(_at, _level) & 1")).withColumn("_pair", F.expr("shiftright(_at, _level + 1)"))
    by_size = Window.partitionBy(*keys, "_b", "_level", "_pair").orderBy("_size").rowsBetween(Window.unboundedPreceding, 0)
    firsts = F.sum(F.when(F.col("_half") == 0, 1).otherwise(0)).over(by_size)
    counted = levels.withColumn("_firsts", F.when(F.col("_half") == 1, firsts).otherwise(0)).filter("is_new") \
        .groupBy(*keys, "_b", "n").agg(F.sum("_firsts").alias("_smaller")).filter(F.col("_smaller") < kcol)
    accepted = found.alias("r").join(counted.alias("c"), _same([*keys, "n"], "r", "c"), "left_semi") \
        .select(*keys, "n", PRIORITY, "value", F.lit(True).alias("is_new"))

    # 4. what each acceptance pushes out
    items = accepted
    if held is not None:
        items = items.unionByName(held.select(*keys, "n", PRIORITY, "value", F.lit(False).alias("is_new")))
    # the j-th largest item and the j-th push meet in a window: both are numbered by key, and nothing moves again
    by_n = by_key.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    pushes = F.col("is_new") & (F.col("n") > kcol)
    ranked = items.withColumn("_turn", F.row_number().over(by_key.orderBy(F.desc(PRIORITY), F.desc("n")))) \
        .withColumn("_push", F.when(pushes, F.sum(pushes.cast("int")).over(by_n)))
    both = ranked.withColumn("_of_push", F.explode(F.when(pushes, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))) \
        .select(*keys, "n", *[F.when(~F.col("_of_push"), F.col(c)).alias(c) for c in (PRIORITY, "value")], "is_new", "_of_push",
                F.when(F.col("_of_push"), F.col("_push")).otherwise(F.col("_turn")).alias("_at"))
    to_n = F.max(F.when(F.col("_of_push"), F.col("n"))).over(Window.partitionBy(*keys, "_at"))
    return both.withColumn("to_n", to_n).filter(~F.col("_of_push")).select(*keys, "n", PRIORITY, "value", "to_n", "is_new")


def sample_changelog(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys..., n, entered, gone``: every change of the samples in ``log``;
    ``gone`` is null, and ``was_full`` false, while the sample still grows."""
    came = log.filter("is_new").alias("a")
    went = log.filter("to_n IS NOT NULL").alias("b")
    same = [*_same(keys, "a", "b"), F.col("a.n") == F.col("b.to_n")]
    return came.join(went, same, "left").select(
        *[F.col(f"a.{c}").alias(c) for c in (*keys, "n")], F.col("a.value").alias("entered"), F.col("b.value").alias("gone"),
        F.col("b.n").isNotNull().alias("was_full"))


def _bin(n: Column) -> Column:
    """Grows with n; below ``BIN`` by powers of two, as young samples change often."""
    return F.when(n < BIN, F.length(F.bin(n))).otherwise(F.floor(n / BIN) + BIN.bit_length()).cast("bigint")


def _lasting(log: DataFrame, ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``log`` with a row for each ``_bin`` that an item lasts, up to the instant
    ``_end`` of its key."""
    log = log.select(*keys, "n", PRIORITY, "value", "to_n")
    if keys:
        lasting = log.alias("l").join(ends.alias("e"), _same(keys, "l", "e")).select("l.*", "e._end")
    else:  # one number
        lasting = log.withColumn("_end", F.lit(ends.first()["_end"]).cast("bigint"))
    until = F.least(F.col("_end"), F.col("to_n") - 1)
    return lasting.filter(F.col("n") <= F.col("_end")).withColumn("_bin", F.explode(F.sequence(_bin(F.col("n")), _bin(until)))).drop("_end")


def items_at(log: DataFrame, instants: DataFrame, keys: Sequence[str], at: str = "at") -> DataFrame:
    """The items held at each instant: columns of ``instants`` (``keys...``, ``at``
    and others) with ``_bin``, ``priority``, ``value``; one row an item.

    Items and instants meet by key and bin of n: an item is repeated for the
    bins that it lasts, an instant is not, and a (key, bin) holds at most
    ``BIN`` different instants however often the key occurs."""
    keys = list(keys)
    items = _lasting(log, instants.groupBy(*keys).agg(F.max(at).alias("_end")), keys)
    met = instants.withColumn("_bin", _bin(F.col(at))).alias("w").join(items.alias("i"), _same([*keys, "_bin"], "w", "i")) \
        .filter((F.col("i.n") <= F.col(f"w.{at}")) & (F.col("i.to_n").isNull() | (F.col(f"w.{at}") < F.col("i.to_n"))))
    return met.select("w.*", f"i.{PRIORITY}", "i.value")


def _place(df: DataFrame, keys: Iterable[Column], at: Column) -> Column:
    """Key and bin as one column.  Its fields can be null on every side of a join:
    a type that differs there would cost an exchange."""
    place = F.struct(*keys, at.alias("_bin"))
    fields = df.select(place.alias("_place")).schema["_place"].dataType.fields
    return place.cast(T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])).alias("_place")


def binned(log: DataFrame, ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``log`` for look-ups (``held_at``): one row a (key, bin of n), with the items
    that are held at some instant of it, up to the last instant ``_end`` of the
    key (``ends``: ``keys...``, ``_end``).  A row has the items held at the bin's start
    and those accepted within it.  Key and bin are one struct, never null as a
    whole, so that joins on it meet the rows where this grouping left them."""
    items = F.sort_array(F.collect_list(F.struct(F.col(PRIORITY).alias("priority"), "value", "n", "to_n")))
    lasting = _lasting(log, ends, list(keys))
    return lasting.groupBy(_place(lasting, map(F.col, keys), F.col("_bin"))).agg(items.alias("_items"))


def held_at(bins: DataFrame, instants: DataFrame, keys: Sequence[Column], at: Column, out: str, most: int | None = None) -> DataFrame:
    """``instants`` with ``out``: the items (``priority, value``) held at ``at``, at
    most the ``most`` smallest.  ``keys`` spell the keys of ``bins``.  Only the
    instants move; their items are picked from the row of their bin."""
    there = instants.filter(at > 0).withColumn("_at", at)
    there = there.select("*", _place(there, keys, _bin(at)))
    there = there.repartition("_place").sortWithinPartitions("_place", "_at")  # alike summaries stay together
    met = there.alias("w").join(bins.alias("b"), F.col("w._place") == F.col("b._place"))
    now = F.filter("_items", lambda x: (x["n"] <= F.col("_at")) & (x["to_n"].isNull() | (F.col("_at") < x["to_n"])))
    now = F.transform(now if most is None else F.slice(now, 1, most), lambda x: F.struct(x["priority"].alias("priority"), x["value"].alias("value")))
    return met.select(*[F.col(f"w.{c}").alias(c) for c in instants.columns], now.alias(out))


def summaries_at(log: DataFrame, instants: DataFrame, keys: Sequence[str], k: Column, at: str = "at", bins: DataFrame | None = None) -> DataFrame:
    """The whole summary (``keys..., n, k, items``) after ``at`` elements, for each
    instant (distinct ``keys..., at``).  ``bins`` is ``binned(log)`` if it is there already."""
    keys = list(keys)
    if bins is None:
        bins = binned(log, instants.groupBy(*keys).agg(F.max(at).alias("_end")), keys)
    return held_at(bins, instants, [F.col(c) for c in keys], F.col(at), "items").select(*keys, F.col(at).alias("n"), k.cast("bigint").alias("k"), "items")
