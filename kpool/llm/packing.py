"""Packing token sequences into as few fixed-length sequences as possible.

Minimum bin slack on the histogram of piece lengths.  A bin takes the longest
piece left; a bitset of reachable sums (one Python integer, bit s = sum s)
over the lengths still available then gives the fullest feasible combination
for the rest, which is removed.  As bins differ only in lengths, the same
combination stays the fullest until one of its lengths runs short, so it is
removed as often as the counts allow in one step: every step uses up a length,
and the driver's work is bounded by the sequence length, not by the corpus.

Spark does the rest: pieces are numbered within their length (per partition,
then by prefix sums, so a length that holds a third of all rows is spread) and
number r of a length is looked up in the plan.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from kpool.llm._io import cut, ship, text_bytes
from kpool.llm.tokens import END_ID, encoder

PIECE_FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id", text: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """Ids of whole texts with the end id, cut into pieces of ``capacity``
    (the last piece may be shorter).  A null text is an empty one: one piece
    that holds the end id.  Rows with a null or repeated id are documents of
    their own."""
    ship(docs.sparkSession)
    end = np.array([END_ID], "<u4").tobytes()
    fields = PIECE_FIELDS[:6 if with_ids else 5]

    def cut_up(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.ids(data.as_py()) + end
                for p, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a:a + 4 * capacity]
                    rows.append((doc_id, p, a // 4, len(part) // 4, zlib.crc32(part),
                                 np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f[1]) for c, f in zip(zip(*rows), fields)],
                                                 schema=pa.schema(fields))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text).alias("data"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(cut_up, kind)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The combination of available lengths with the largest sum up to
    ``room``, as (length, times); longer lengths are tried first."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(size, left)
            grown = (reach | reach << take * length) & mask
            if grown != reach:
                steps.append((length, take, grown & ~reach))
                reach = grown
            left, size = left - take, size * 2
        if reach >> room & 1:
            break
    target, used = reach.bit_length() - 1, {}
    for length, take, new in reversed(steps):
        if new >> target & 1:
            used[length] = used.get(length, 0) + take
            target -= take * length
    return sorted(used.items(), reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Steps (bins, [(length, pieces of it in each bin)]) that use up the histogram."""
    counts, plan = {k: v for k, v in histogram.items() if v > 0}, []
    while counts:
        top = max(counts)
        counts[top] -= 1
        rest = dict(fullest(counts, capacity - top))
        counts[top] += 1
        rest[top] = rest.get(top, 0) + 1
        times = min(counts[x] // m for x, m in rest.items())
        for x, m in rest.items():
            counts[x] -= times * m
            if not counts[x]:
                del counts[x]
        plan.append((times, sorted(rest.items(), reverse=True)))
    return plan


def _slots(plan) -> dict[int, np.ndarray]:
    """For each length: rows (first number, first bin, pieces a bin, offset of the first)."""
    slots, given, first = {}, {}, 0
    for times, parts in plan:
        at = 0
        for length, m in parts:
            slots.setdefault(length, []).append((given.get(length, 0), first, m, at))
            given[length] = given.get(length, 0) + times * m
            at += m * length
        first += times
    return {k: np.array(v, np.int64) for k, v in slots.items()}


def pack(pieces: DataFrame, capacity: int = 4096, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row of ``pieces``.

    Lengths must lie in 1..capacity; others raise.  Rows of equal length are
    interchangeable, so ties (equal ``order``) may be placed either way.
    Columns with clashing names (``sequence_id``, ``offset``) are replaced.
    """
    ship(pieces.sparkSession)
    pieces = cut(pieces.drop("sequence_id", "offset").withColumn("_pid", F.spark_partition_id()))
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}  # at most ``capacity`` rows
    if any(x is None or not 1 <= x <= capacity for x in histogram):
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    slots = _slots(plan_bins(histogram, capacity))

    runs = pieces.groupBy(length, "_pid").count()
    before = W.partitionBy(length).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("_base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = W.partitionBy(length, "_pid").orderBy(*order)
    ranked = (pieces.withColumn("_rank", F.row_number().over(own) - 1).join(runs, [length, "_pid"])
              .withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_pid", "_base"))
    kept = [c for c in ranked.columns if c != "_rank"]

    def place(batches):
        for batch in batches:
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            size = batch.column(length).to_numpy(zero_copy_only=False).astype(np.int64)
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(size):
                at = np.flatnonzero(size == x)
                table = slots[int(x)]
                row = table[np.searchsorted(table[:, 0], rank[at], "right") - 1]
                nth = rank[at] - row[:, 0]
                seq[at] = row[:, 1] + nth // row[:, 2]
                off[at] = row[:, 3] + nth % row[:, 2] * x
            names = [*kept, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(seq), pa.array(off)], names=names)

    schema = ranked.select(*kept).withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return ranked.mapInArrow(place, schema)
