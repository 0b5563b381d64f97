"""SimHash near-duplicates: exact search for fingerprints within a Hamming radius.

Fingerprints are made in Arrow batches; documents of one fingerprint then
become one row.  Cut into ``radius + j`` bit fields, two fingerprints that differ
in at most ``radius`` bits agree on at least j of them, so each goes to one cell
for every choice of j fields (j grows with the number of fingerprints, so that
cells stay small).  Every cell is cut into tiles of one population count; pairs
of tiles whose counts differ by more than the radius are skipped, as such
fingerprints cannot be close, and the other pairs are compared whole, with numpy
exclusive-or and bit counts.  No cell, tile or partner is capped: a crowded cell
is dealt to tasks by pairs of bands of population counts.

Of the links in a batch of tile pairs only a spanning forest leaves the task;
it has the same components.

Defined cases: a null or wordless text has fingerprint zero and is linked like
any other.  Rows with a null id take part but give no component its name; a
component without any id has a null name.  Repeated rows share a fingerprint.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from kpool.llm._io import cut, fresh, ship, text_bytes
from kpool.llm.components import connected_components, spanning_links

TILE = 4096          # fingerprints of a cell, or of a band, in one task
CELL = 256           # fingerprints that a cell holds by chance, above which more fields must agree
COMPARED = 1 << 20   # comparisons made at once
SEED = 42


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, A-Z lower-cased; words are
    split at space, tab and the other ASCII white space."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[:len(words) - shingle + 1].tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[i:i + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` with its signed 64-bit fingerprint in column ``name`` (replaced
    if it exists); column ``text`` must be a string."""
    ship(docs.sparkSession)
    docs = docs.drop(name) if name in docs.columns else docs
    kept = docs.columns

    data = fresh([*kept, name], "data")

    def add(batches):
        for batch in batches:
            found = [simhash(x.as_py(), shingle) for x in batch.column(batch.num_columns - 1)]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=[*kept, name])

    schema = docs.withColumn(name, F.lit(0).cast("long")).schema
    return docs.withColumn(data, text_bytes(text)).mapInArrow(add, schema)


def _close(a: np.ndarray, b: np.ndarray, radius: int, same: bool):
    """Index pairs of close fingerprints between two tiles (or within one)."""
    step = max(1, (1 << 20) // max(1, len(b)))
    for i in range(0, len(a), step):
        x, y = np.nonzero(np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius)
        x += i
        if same:
            x, y = x[x < y], y[x < y]
        yield x, y


def tile_pairs(group: np.ndarray, side: np.ndarray, count: np.ndarray, radius: int):
    """Pairs of tiles to compare, as (begin, size, begin, size) columns, and how
    many pairs of the same groups are skipped.

    Rows are sorted by (group, side, population count).  A tile is a run of rows
    of one population count; tiles of side 0 meet each other, those of side 1
    meet those of side 2.  Counts further apart than the radius are skipped."""
    if not len(group):
        return np.zeros((0, 4), np.int64), 0
    change = (np.diff(group) != 0) | (np.diff(side) != 0) | (np.diff(count) != 0)
    begin = np.concatenate([[0], np.flatnonzero(change) + 1])
    size = np.diff(np.append(begin, len(group)))
    number = np.cumsum(np.concatenate([[0], np.diff(group[begin]) != 0]))
    key = (number * 4 + side[begin]) * 256 + count[begin] + 64  # ascending; counts may be looked for below and above
    pairs = []
    for apart in range(-radius, radius + 1):
        for mine, other in ((0, 0), (1, 2)):
            if mine == other and apart < 0:
                continue
            own = np.flatnonzero(side[begin] == mine)
            want = key[own] + (other - mine) * 256 + apart
            at = np.searchsorted(key, want)
            hit = (at < len(key)) & (key[np.minimum(at, len(key) - 1)] == want)
            pairs.append(np.column_stack([begin[own[hit]], size[own[hit]], begin[at[hit]], size[at[hit]]]))
    found = np.concatenate(pairs)
    tiles = np.zeros((number[-1] + 1, 3), np.int64)
    np.add.at(tiles, (number, side[begin]), 1)
    return found, int((tiles[:, 0] * (tiles[:, 0] + 1) // 2 + tiles[:, 1] * tiles[:, 2]).sum()) - len(found)


def _compare(group: np.ndarray, side: np.ndarray, fps: np.ndarray, radius: int):
    """Spanning links of all groups in a batch, by comparing tile pairs."""
    count = np.bitwise_count(fps).astype(np.int64)
    order = np.lexsort((count, side, group))
    group, side, fps, count = group[order], side[order].astype(np.int64), fps[order], count[order]
    pairs, _ = tile_pairs(group, side, count, radius)
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def keep(x, y):
        x, y = spanning_links(fps[x].view(np.int64), fps[y].view(np.int64))
        found_a.append(x)
        found_b.append(y)

    cost = pairs[:, 1] * pairs[:, 3]
    for a, n, b, m in pairs[cost > COMPARED].tolist():  # large tiles, as matrices
        for x, y in _close(fps[a:a + n], fps[b:b + m], radius, a == b):
            keep(x + a, y + b)
    pairs, cost = pairs[cost <= COMPARED], cost[cost <= COMPARED]
    cuts = np.flatnonzero(np.diff(np.cumsum(cost) // COMPARED, prepend=0)) if len(cost) else []
    for part, total in zip(np.split(pairs, cuts), np.split(cost, cuts)):  # small ones, many at once
        which = np.repeat(np.arange(len(part)), total)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
        x, y = part[which, 0] + nth // part[which, 3], part[which, 2] + nth % part[which, 3]
        hit = (np.bitwise_count(fps[x] ^ fps[y]) <= radius) & ((part[which, 0] != part[which, 2]) | (x < y))
        if hit.any():
            keep(x[hit], y[hit])
    return spanning_links(np.concatenate(found_a), np.concatenate(found_b))


def fields_for(n: int, radius: int) -> int:
    """Bit fields to cut fingerprints into: of more fields more must agree, so that
    cells stay small as ``n`` grows; at most 64 cells a fingerprint."""
    fields = radius + 1
    while n >> (64 * (fields - radius) // fields) >= CELL and math.comb(fields + 1, radius) <= 64:
        fields += 1
    return fields


def cells_of(fp: str, radius: int, fields: int) -> Column:
    """The cells of a fingerprint: one for each choice of ``fields - radius`` fields,
    named by the choice and the bits in them.  Of fingerprints within the radius at
    least one choice has no differing bit."""
    edges = np.linspace(0, 64, fields + 1).astype(int).tolist()
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    cells = []
    for i, chosen in enumerate(combinations(masks, fields - radius)):
        mask = sum(chosen)
        cells.append(F.xxhash64(F.lit(i), F.col(fp).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    return F.array(*cells)


def close_links(distinct: DataFrame, radius: int = 3, fp: str = "fp", tile: int = TILE, fields: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most ``radius`` bits
    apart, thinned to forests that keep every component."""
    if not 0 <= radius <= 15:
        raise ValueError("radius must lie in 0..15")
    fields = fields_for(distinct.count(), radius) if fields is None else fields
    if fields <= radius:
        raise ValueError("more fields than differing bits are needed")
    rows = distinct.select(F.col(fp).alias("fp"), F.bit_count(fp).cast("int").alias("pc"), F.explode(cells_of(fp, radius, fields)).alias("cell"))

    # cells of more than ``tile`` are dealt to tasks by pairs of bands of population counts
    counts = rows.groupBy("cell", "pc").count()
    counts = counts.withColumn("total", F.sum("count").over(W.partitionBy("cell")))
    crowded = counts.filter(F.col("total") > tile)
    before = F.coalesce(F.sum("count").over(W.partitionBy("cell").orderBy("pc").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bands = cut(crowded.select("cell", "pc", (before / tile).cast("int").alias("first"),
                               F.greatest(F.lit(1), F.ceil(F.col("count") / tile)).cast("int").alias("n")))
    tiles = (bands.select("cell", "pc", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("t"))
             .groupBy("cell", "t").agg(F.min("pc").alias("lo"), F.max("pc").alias("hi")))
    left = tiles.select("cell", F.col("t").alias("t1"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
    right = tiles.select("cell", F.col("t").alias("t2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    near = (left.join(right, "cell").filter((F.col("t1") <= F.col("t2")) & (F.col("lo2") - F.col("hi1") <= radius)
                                            & (F.col("lo1") - F.col("hi2") <= radius)).select("cell", "t1", "t2"))
    seats = (near.select("cell", F.col("t1").alias("t"), "t1", "t2", F.when(F.col("t1") == F.col("t2"), 0).otherwise(1).alias("side"))
             .union(near.filter("t1 < t2").select("cell", F.col("t2").alias("t"), "t1", "t2", F.lit(2).alias("side"))))

    marked = rows.join(bands, ["cell", "pc"], "left")
    light = marked.filter(F.col("first").isNull()).select(F.col("cell").alias("g"), F.lit(0).alias("side"), "fp")
    heavy = (marked.filter(F.col("first").isNotNull())
             .withColumn("t", F.col("first") + F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
             .join(seats, ["cell", "t"]).select(F.xxhash64("cell", "t1", "t2").alias("g"), "side", "fp"))

    def compare(batches):
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            cut_at = np.searchsorted(now[0], now[0][-1]) if len(now[0]) else 0  # the last group may go on
            held = [x[cut_at:] for x in now]
            yield from out(*[x[:cut_at] for x in now])
        if held is not None:
            yield from out(*held)

    def out(group, side, fps):
        if len(group):
            a, b = _compare(group, side, fps.astype(np.int64).view(np.uint64), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    grouped = light.union(heavy).repartition("g").sortWithinPartitions("g")
    return grouped.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the least id reachable over links of at most ``radius`` bits."""
    fps = cut(fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")), "t", shingle).select("id", "fp"))
    distinct = cut(fps.groupBy("fp").agg(F.min("id").alias("least")))
    roots = connected_components(close_links(distinct.select("fp"), radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every near-duplicate component: the one of the
    least id (null ids last), then of the least text hash; of rows equal in
    both, any one.  Columns are unchanged."""
    kept = docs.columns
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("hash"), F.col(text).alias("t"))
    rows = cut(fingerprints(narrow, "t", shingle).select("id", "hash", "fp"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    distinct = cut(rows.groupBy("fp").agg(F.min(order).alias("best")))
    roots = connected_components(close_links(distinct.select("fp"), radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("best", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min("best").alias("best")).select("best.id", "best.hash")
    held = rows.groupBy("id", "hash").count()
    same = held["id"].eqNullSafe(best["id"]) & (held["hash"] == best["hash"])
    uid, mark, copies = (fresh(kept, n) for n in ("uid", "hash", "copies"))
    winners = cut(best.join(held, same).select(best["id"].alias(uid), best["hash"].alias(mark), F.col("count").alias(copies)))

    found = docs.withColumn(fresh([*kept, uid, mark, copies], "key"), F.xxhash64(F.col(text)))
    key = found.columns[-1]
    found = found.join(winners, F.col(id_col).cast("long").eqNullSafe(F.col(uid)) & (F.col(key) == F.col(mark)))
    single = found.filter(F.col(copies) == 1).select(*kept)
    first = W.partitionBy(uid, mark).orderBy(F.lit(0))  # repeated rows: cut to one of each before the shuffle as well
    again = found.filter(F.col(copies) > 1).withColumn(key, F.row_number().over(first)).filter(F.col(key) == 1).select(*kept)
    return single.union(again)
