"""Element-by-element streams as Spark jobs over micro-batches.

``stream_changelog`` (T1): after every element that changes a key's sample, what
entered and what it pushed out, for one stream.  ``stream_paired_changelog``
(T1, J1, T2): of two streams, the summary after every element, and the merged
summary at every consume-once pair.

Each micro-batch is one plan: elements get their n by range-partitioned
ordinals that go on from the stored count, changes come from the acceptance
log (``operators/acceptance.py``), pairs from runs and slices
(``operators/pairing.py``) after the one item that was held, and merged
summaries are assembled by a join of pair instants with the items' intervals.
No Python code sees an element, and the rows of a hot key are spread over tasks.

State (two alternating slots, see ``slots.py``): per key the count, the k items
of its sample with their n, and for pairs the one item held.  A micro-batch
writes its rows to ``batch=<id>`` of the output folder, overwriting what a lost
attempt left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpool.operators.acceptance import acceptance_log, binned, held_at, number_rows, sample_changelog, summaries_at
from kpool.operators.ordinal import ordinal
from kpool.operators.pairing import pair_latest_unmatched
from kpool.operators.sample import DEFAULT_SIZE, PRIORITY, check_size
from kpool.plans.layout import materialize
from kpool.session import shared_dir
from kpool.streaming.sample_stream import run_to_end
from kpool.streaming.slots import read_state, write_state

WHAT = "_what"
SEEN, ITEM, HELD = "seen", "item", "held"
SIDE = "_side"
BUCKETS = 1 << 20  # rows of a table that prunes before the last row of each key is taken


def _parts(state: DataFrame | None, keys: Sequence[str], extra: Sequence[str] = ()):
    """(counts, items, held) of a stored state; None each for the first batch."""
    if state is None:
        return None, None, None
    seen = state.filter(F.col(WHAT) == SEEN).select(*keys, *extra, F.col("n").alias("seen"))
    items = state.filter(F.col(WHAT) == ITEM).select(*keys, *extra, "n", PRIORITY, "value")
    held = state.filter(F.col(WHAT) == HELD).select(*keys, *extra, "n")
    return seen, items, held


def _add_up(seen: DataFrame | None, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per key after a batch: ``n`` of the largest element, or as before."""
    now = fresh.groupBy(*keys).agg(F.max("n").alias("n"))
    if seen is not None:
        now = now.unionByName(seen.select(*keys, F.col("seen").alias("n"))).groupBy(*keys).agg(F.max("n").alias("n"))
    return now.filter("n IS NOT NULL")


def _state(keys: Sequence[str], counts: DataFrame, log: DataFrame, held: DataFrame | None = None) -> DataFrame:
    rows = counts.select(F.lit(SEEN).alias(WHAT), *keys, "n").unionByName(
        log.filter("to_n IS NULL").select(F.lit(ITEM).alias(WHAT), *keys, "n", PRIORITY, "value"), allowMissingColumns=True)
    return rows if held is None else rows.unionByName(held.select(F.lit(HELD).alias(WHAT), *keys, "n"), allowMissingColumns=True)


# --- T1: one stream ---------------------------------------------------------

def changelog_step(batch: DataFrame, keys: Sequence[str], k: int, value_cols, id_cols: Sequence, order: Sequence, seed: int,
                   state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(changes, next state) of one micro-batch."""
    keys = list(keys)
    seen, items, _ = _parts(state, keys)
    numbered = number_rows(batch, keys, order, value_cols, id_cols, seed, seen)
    log = materialize(acceptance_log(numbered, keys, k, items))
    return sample_changelog(log, keys), _state(keys, _add_up(seen, numbered, keys), log)


def _batch_writer(step: Callable, table_dir: str, out_dir: str):
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = read_state(spark, table_dir, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, after = step(batch, state)
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{out_dir}/batch={batch_id}")
            write_state(after, table_dir, batch_id)
        finally:
            batch.unpersist()
    return on_batch


def start_step(sdf: DataFrame, step: Callable, table_dir: str | None, out_dir: str | None, checkpoint: str | None, trigger: dict | None):
    """Run ``step(batch, state) -> (rows, next state)`` on each micro-batch; returns ``(query, out_dir)``."""
    spark = sdf.sparkSession
    table_dir, out_dir = table_dir or shared_dir(spark, "changelog-state"), out_dir or shared_dir(spark, "changelog")
    writer = sdf.writeStream.foreachBatch(_batch_writer(step, table_dir, out_dir)) \
        .option("checkpointLocation", checkpoint or shared_dir(spark, "changelog-ckpt"))
    return writer.trigger(**(trigger or {"availableNow": True})).start(), out_dir


def stream_changelog(sdf: DataFrame, keys: Sequence[str], k: int = DEFAULT_SIZE, value_cols=(), id_cols: Sequence = (), order: Sequence = (),
                     seed: int = 0, table_dir: str | None = None, out_dir: str | None = None, checkpoint: str | None = None,
                     trigger: dict | None = None):
    """Start the stream of changes; returns ``(query, out_dir)``.  ``out_dir`` gets
    ``keys..., n, entered, gone, was_full`` and ``batch``.  Elements follow each
    other by micro-batch, then by ``order`` (total within a micro-batch).  Give
    ``table_dir``, ``out_dir`` and ``checkpoint`` to go on later."""
    check_size("k", k)
    if not order:
        raise ValueError("order must name the columns that order the elements")

    def step(batch, state):
        return changelog_step(batch, keys, k, value_cols, id_cols, order, seed, state)

    return start_step(sdf, step, table_dir, out_dir, checkpoint, trigger)


# --- J1: pairs of any two keyed streams -------------------------------------

def pair_step(batch: DataFrame, keys: Sequence[str], side: Column, order: Sequence, id_col: str,
              state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(pairs, next state) of one micro-batch.  The state is the one item held per
    key, with its side: it comes before the batch's first element, and what the
    batch leaves unpaired at its end is held next."""
    keys = list(keys)
    names = [f"_o{i}" for i in range(len(order))]
    rows = batch.select(*keys, side.alias("_left"), F.col(id_col).alias("_id"), F.lit(1).alias("_when"),
                        *[(F.col(c) if isinstance(c, str) else c).alias(o) for c, o in zip(order, names)]).filter(F.col("_left").isNotNull())
    if state is not None:
        rows = state.select(*keys, "_left", "_id", F.lit(0).alias("_when")).unionByName(rows, allowMissingColumns=True)
    pairs = materialize(pair_latest_unmatched(rows, keys, F.col("_left"), ["_when", *names], "_id"))
    # a key's last element is held, unless it closed a pair
    last = rows.groupBy(*keys).agg(F.max_by(F.struct("_left", "_id"), F.struct("_when", *names)).alias("_last")).select(*keys, "_last.*")
    closed = pairs.select(*keys, F.col("right_first").alias("_left"), F.when(F.col("right_first"), F.col("left_id")).otherwise(F.col("right_id")).alias("_id"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "_left", "_id")]
    return pairs, last.alias("a").join(closed.alias("b"), same, "left_anti").filter(F.col("_left").isNotNull())


def stream_pairs(sdf: DataFrame, keys: Sequence[str], side: Column, order: Sequence, id_col: str, table_dir: str | None = None,
                 out_dir: str | None = None, checkpoint: str | None = None, trigger: dict | None = None):
    """Start consume-once pairing (J1) of two keyed streams, given as one with a
    boolean ``side`` (true: left; null: ignored); returns ``(query, out_dir)``.
    ``out_dir`` gets ``keys..., left_id, right_id, right_first`` and ``batch``.
    ``id_col`` names each element of a key once."""
    def step(batch, state):
        return pair_step(batch, keys, side, order, id_col, state)

    return start_step(sdf, step, table_dir, out_dir, checkpoint, trigger)


# --- T2: two sampled streams and their merged summaries ---------------------

def paired_step(batch: DataFrame, keys: Sequence[str], side: Column, k1: int, k2: int, m: int, value_cols, id_cols: Sequence, order: Sequence,
                seed: int, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(summaries, next state) of one micro-batch."""
    keys = list(keys)
    both = [*keys, SIDE]
    names = [f"_o{i}" for i in range(len(order))]
    rows = batch.withColumn(SIDE, F.when(side, 1).otherwise(2))
    for c, o in zip(order, names):
        rows = rows.withColumn(o, F.col(c) if isinstance(c, str) else c)
    seen, items, held = _parts(state, keys, [SIDE])
    numbered = number_rows(rows, both, names, value_cols, id_cols, seed, seen, keep=names)
    size = F.when(F.col(SIDE) == 1, k1).otherwise(k2)
    log = materialize(acceptance_log(numbered, both, max(k1, k2), items, size))

    # J1 over the numbers of the elements; the item held before comes first
    elements = numbered.select(*both, "n", *names, F.lit(1).alias("_when"))
    if held is not None:
        elements = held.select(*both, "n", F.lit(0).alias("_when")).unionByName(elements, allowMissingColumns=True)
    elements = elements.withColumn("_element", F.struct(SIDE, "n"))
    pairs = materialize(pair_latest_unmatched(elements, keys, F.col(SIDE) == 1, ["_when", *names], "_element"))
    last = elements.groupBy(*keys).agg(F.max_by("_element", F.struct("_when", *names)).alias("_element"))
    closed = pairs.select(*keys, F.when(F.col("right_first"), F.col("left_id")).otherwise(F.col("right_id")).alias("_element"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "_element")]
    held = last.alias("a").join(closed.alias("b"), same, "left_anti").select(*keys, f"_element.{SIDE}", "_element.n")

    # the summary after each element, and the merged one at each pair
    counts = materialize(_add_up(seen, numbered, both))
    bins = binned(log, counts.select(*both, F.col("n").alias("_end")), both)
    sampled = summaries_at(log, numbered.select(*both, F.col("n").alias("at")), both, size, bins=bins)
    sampled = sampled.select(*keys, F.concat(F.lit("sampled"), F.col(SIDE).cast("string")).alias("kind"),
                             F.when(F.col(SIDE) == 1, F.col("n")).alias("n1"), F.when(F.col(SIDE) == 2, F.col("n")).alias("n2"), "n", "k", "items")
    pooled = pairs.select(*keys, F.col("left_id.n").alias("n1"), F.col("right_id.n").alias("n2"))
    for s in (1, 2) if k1 <= k2 else (2, 1):  # the smaller side's items go along to the other's
        pooled = held_at(bins, pooled, [*map(F.col, keys), F.lit(s).alias(SIDE)], F.col(f"n{s}"), f"_items{s}", m)
    pooled = pooled.withColumn("items", F.sort_array(F.concat("_items1", "_items2")))
    # Rule R: a side that does not hold its whole input bounds the exact merge
    most = F.least(F.lit(m), F.when(F.col("n1") > k1, k1), F.when(F.col("n2") > k2, k2))
    merged = pooled.select(*keys, F.lit("merged").alias("kind"), "n1", "n2", (F.col("n1") + F.col("n2")).alias("n"), most.cast("bigint").alias("k"),
                           F.slice("items", 1, most).alias("items"))
    return sampled.unionByName(merged), _state(both, counts, log, held)


def stream_paired_changelog(sdf: DataFrame, keys: Sequence[str], side: Column, value_cols, id_cols: Sequence, order: Sequence, k1: int = DEFAULT_SIZE,
                            k2: int = DEFAULT_SIZE, m: int = DEFAULT_SIZE, seed: int = 0, table_dir: str | None = None, out_dir: str | None = None,
                            checkpoint: str | None = None, trigger: dict | None = None):
    """Start the paired stream over one stream of both sides (``side`` true: 1,
    else 2); returns ``(query, out_dir)``.

    ``out_dir`` gets every summary that the element-level operator emits:
    ``keys..., kind, n1, n2, n, k, items`` with ``kind`` sampled1 / sampled2 (after
    element n1 / n2 of that side) or merged (at the pair of elements n1 and n2)."""
    for name, v in (("k1", k1), ("k2", k2), ("m", m)):
        check_size(name, v)

    def step(batch, state):
        return paired_step(batch, keys, side, k1, k2, m, value_cols, id_cols, order, seed, state)

    return start_step(sdf, step, table_dir, out_dir, checkpoint, trigger)


def latest(rows: DataFrame, keys: Sequence[str], by: str, *cols: str) -> DataFrame:
    """``keys..., cols...`` of each key's row of largest ``by`` (a number, not null).

    A first pass over ``keys`` and ``by`` alone finds, for each of ``BUCKETS`` groups
    of keys, the least of their largest; rows below it are no key's last and go
    before anything is sorted or moved.  The table has at most ``BUCKETS`` rows
    however many keys there are."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("_bucket")
    least = rows.groupBy(*keys).agg(F.max(by).alias("_last")).groupBy(bucket).agg(F.min("_last").alias("_least"))
    late = rows.select(*keys, by, *[c for c in cols if c != by], bucket).join(F.broadcast(least), "_bucket").filter(F.col(by) >= F.col("_least"))
    return late.groupBy(*keys).agg(F.max_by(F.struct(*cols), by).alias("_row")).select(*keys, "_row.*")


# --- arrivals ---------------------------------------------------------------

def arrivals(spark: SparkSession, df: DataFrame, order: Sequence, parts: int) -> Iterator[str]:
    """A table as a stream: a folder that gets the next of ``parts`` equal parts of
    ``order`` each time the iterator moves on."""
    folder = shared_dir(spark, "arrivals")
    numbered = ordinal(df, order, out="_arrival")
    total = numbered.count()
    for i in range(parts):
        at = F.col("_arrival")
        part = numbered.filter((at > total * i // parts) & (at <= total * (i + 1) // parts)).drop("_arrival")
        part.write.mode("append").parquet(folder)
        yield folder


def run_arrivals(spark: SparkSession, df: DataFrame, order: Sequence, parts: int, start: Callable) -> dict[str, str]:
    """Run a stream over the arrivals of ``df``, stopping and going on from its
    checkpoint between them.  ``start(sdf, table_dir=, out_dir=, checkpoint=)``
    starts it; returns these three folders."""
    places = {name: shared_dir(spark, f"arrivals-{name}") for name in ("table_dir", "out_dir", "checkpoint")}
    for folder in arrivals(spark, df, order, parts):
        query, _ = start(spark.readStream.schema(df.schema).parquet(folder), **places)
        run_to_end(query)
    return places
