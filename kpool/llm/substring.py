"""Exact substring dedup: words inside a repeated window of ``window`` words go.

Prefix-partitioned suffix trees over sampled suffixes, cut at depth
``window`` (deeper nodes cannot change which windows repeat):

1. *Sampling.*  Of the ``window - prefix + 1`` word prefixes that start inside
   a window, the one of the least hash is its anchor.  Equal windows have equal
   anchors, so only suffixes at anchors (about a fourteenth of all) are
   indexed, and nothing is lost.
2. *Partitioning by prefixes of variable length.*  Suffixes are grouped by the
   hash of their first ``prefix`` words; a prefix that occurs once has no
   repeat below it and is dropped by a grouped count.  Groups that fit in
   memory are built whole.  A group of more than ``group_limit`` suffixes is
   split by the longest useful prefix, the whole window, and its leaves are
   counted by aggregation, so a passage in a third of all texts is combined
   before the shuffle and never gathered in one task.
3. *Subtrees.*  Windows of a group are paths through its prefix, spelled by a
   64-bit fingerprint below the 64-bit prefix hash.  They are sorted; a run of
   two or more equal paths is an internal node of depth ``window``, and its
   leaves are occurrences of a repeat.  Overlapping occurrences join to
   maximal repeats, whose words are removed from the text.

Which windows repeat depends on the input alone, never on what was removed
elsewhere.  Words are maximal runs without ASCII white space and compared as
they are.  Two hashes of 64 bits stand for a window's words.

Which words go is a function of the text, so copies of one text share their
result, and a task indexes a text's first two copies only: two occurrences are
all that a repeat needs, and a third of all rows may be copies of one text.

Defined cases: a null text has no words; texts shorter than the window lose
nothing; repeated rows repeat all their windows.  Null and repeated ids are
allowed, and equal rows get equal results.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpool.llm._io import cut, fresh, Scratch, ship, text_bytes

WINDOW = 35
PREFIX = 10
GROUP_LIMIT = 50_000  # at most 26 paths of 8 bytes each: about 10 MB

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 15), base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Hashes of all runs of a given number of words of one text (polynomials
    modulo 2^64 over 64-bit word hashes, from one running sum)."""

    def __init__(self, data: bytes):
        from xxhash import xxh64_intdigest

        words = data.split()
        self.n = len(words)
        hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, self.n)
        self.up, down = _powers(self.n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down[:self.n], dtype=np.uint64)])

    def runs(self, length: int) -> np.ndarray:
        if self.n < length:
            return np.empty(0, np.uint64)
        return _mixed((self.sums[length:] - self.sums[:-length]) * self.up[:self.n - length + 1])


def anchors_of(hashes: WordHashes, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix hash, first window, windows) for each run of windows that share an anchor."""
    starts = hashes.runs(prefix)
    inner = window - prefix + 1
    if len(starts) < inner:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    at = np.lib.stride_tricks.sliding_window_view(starts, inner).argmin(axis=1) + np.arange(len(starts) - inner + 1)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return starts[at[first]].view(np.int64), first.astype(np.int32), np.diff(np.append(first, len(at))).astype(np.int32)


def _keys(text: str) -> tuple[Column, Column]:
    """Two hashes that together stand for a text."""
    return F.xxhash64(F.col(text)), F.xxhash64(F.lit(WINDOW), F.col(text))


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    key, other = _keys(text)
    return docs.select(F.col(id_col).cast("long").alias("id"), key.alias("key"), other.alias("key2"), text_bytes(text).alias("data"))


def _anchors(rows: DataFrame, window: int, prefix: int) -> DataFrame:
    names = ["id", "key", "h", "s", "c"]

    def find(batches):
        copies: dict[tuple[int, int], int] = {}
        for batch in batches:
            found, rows = [], []
            for i, key in enumerate(zip(batch.column("key").to_pylist(), batch.column("key2").to_pylist())):
                copies[key] = copies.get(key, 0) + 1
                if copies[key] <= 2:
                    found.append(anchors_of(WordHashes(batch.column("data")[i].as_py()), window, prefix))
                    rows.append(i)
            where = np.repeat(np.array(rows, np.int64), [len(f[0]) for f in found])
            if len(where):
                cols = [batch.column(c).take(pa.array(where)) for c in ("id", "key")]
                cols += [pa.array(np.concatenate([f[i] for f in found])) for i in range(3)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(find, "id long, key long, h long, s int, c int")


def _paths(rows: DataFrame, window: int) -> DataFrame:
    """For every surviving anchor its windows' fingerprints."""
    fields = pa.schema([("h", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("key2", pa.int64()), ("s", pa.int32()),
                        ("f", pa.list_(pa.int64()))])

    def spell(batches):
        for batch in batches:
            keys, h, n, s, f, sizes, of = [batch.column(c) for c in ("key", "key2")], [], [], [], [], [], []
            for i, (data, marks) in enumerate(zip(batch.column("data"), batch.column("marks"))):
                paths = WordHashes(data.as_py()).runs(window).view(np.int64)
                # copies of one row bring each other's marks; each needs them once
                for first, (m_h, m_n, m_c) in {m["s"]: (m["h"], m["n"], m["c"]) for m in marks.as_py()}.items():
                    h.append(m_h)
                    n.append(m_n)
                    s.append(first)
                    f.append(paths[first:first + m_c])
                    sizes.append(m_c)
                    of.append(i)
            if of:
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                of = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(n, pa.int64()), *(k.take(of) for k in keys), pa.array(s, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(f)))], schema=fields)

    return rows.mapInArrow(spell, "h long, n long, key long, key2 long, s int, f array<long>")


def deep_nodes(group: np.ndarray, path: np.ndarray) -> np.ndarray:
    """True for each (group, path) that occurs at least twice: leaves of an
    internal node of full depth in that group's subtree."""
    order = np.lexsort((path, group))
    g, p = group[order], path[order]
    equal = (g[1:] == g[:-1]) & (p[1:] == p[:-1])
    deep = np.zeros(len(group), bool)
    deep[order[1:]] = equal
    deep[order[:-1]] |= equal
    return deep


def _subtrees(paths: DataFrame) -> DataFrame:
    """Repeated windows of groups that are in memory one after another, as
    (key, key2, first window, windows) runs."""

    def build(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            if held is not None:
                now = pa.concat_tables([held, now])
            h = now.column("h").to_numpy()
            at = int(np.searchsorted(h, h[-1])) if len(h) else 0  # the last group may go on
            held = now.slice(at).combine_chunks()
            yield from runs(now.slice(0, at))
        if held is not None:
            yield from runs(held)

    def runs(rows):
        if not rows.num_rows:
            return
        rows = rows.combine_chunks()
        lists = rows.column("f").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(rows.num_rows), sizes)
        deep = deep_nodes(rows.column("h").to_numpy()[row], lists.flatten().to_numpy(zero_copy_only=False))
        nth = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = np.flatnonzero(deep)
        if len(hit):
            new = np.flatnonzero((np.diff(hit, prepend=-2) > 1) | (np.diff(row[hit], prepend=-1) != 0))
            first = hit[new]
            of = pa.array(row[first])
            start = rows.column("s").to_numpy()[row[first]] + nth[first]
            cols = [rows.column(c).take(of).combine_chunks() for c in ("key", "key2")]
            cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(start.astype(np.int32)), pa.array(np.diff(np.append(new, len(hit))).astype(np.int32))],
                                             names=["key", "key2", "s", "c"])

    return paths.repartition("h").sortWithinPartitions("h").mapInArrow(build, "key long, key2 long, s int, c int")


def _split_groups(paths: DataFrame) -> DataFrame:
    """The same for crowded groups, by aggregation over whole windows.  Equal
    segments are combined first, so copies cost one row."""
    paths = cut(paths.withColumn("g", F.xxhash64("f", F.reverse("f"))))
    segments = paths.groupBy("h", "g").agg(F.count("*").alias("m"), F.first("f").alias("f"))
    leaves = segments.select("h", "g", "m", F.posexplode("f").alias("i", "p"))
    deep = leaves.groupBy("h", "p").agg(F.sum("m").alias("m")).filter("m > 1").select("h", "p")
    hits = leaves.join(deep, ["h", "p"], "left_semi").groupBy("h", "g").agg(F.collect_list("i").alias("at"))
    return paths.join(hits, ["h", "g"]).select("key", "key2", F.explode("at").alias("i"), "s").select(
        "key", "key2", (F.col("s") + F.col("i")).cast("int").alias("s"), F.lit(1).alias("c"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
                     prefix: int = PREFIX, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(key, key2, spans) for texts with repeats: ``spans`` holds (first window,
    windows) runs; the keys are hashes of the text."""
    ship(docs.sparkSession)
    if not 1 <= prefix <= window:
        raise ValueError("1 <= prefix <= window")
    rows = _keyed(docs, id_col, text)
    tables = Scratch()
    anchors = tables.write(_anchors(rows, window, prefix), "anchors")
    # written out, so that the join below has an exchange on both sides and hot prefixes can be split
    often = cut(anchors.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"))
    marks = (anchors.join(often, "h").groupBy("id", "key")
             .agg(F.collect_list(F.struct("h", "n", "s", "c")).alias("marks")))
    texts = rows.filter(F.length("data") > 0)
    joined = texts.join(marks, marks["id"].eqNullSafe(texts["id"]) & (marks["key"] == texts["key"]))
    paths = tables.write(_paths(joined.select(texts["key"], "key2", "data", "marks"), window), "paths")
    found = _subtrees(paths.filter(F.col("n") <= group_limit).drop("n")).union(_split_groups(paths.filter(F.col("n") > group_limit).drop("n")))
    spans = cut(found.groupBy("key", "key2").agg(F.collect_set(F.struct("s", "c")).alias("spans")))
    tables.drop()
    return spans


def removed_words(n: int, spans, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for span in spans or ():
        edge[span["s"]] += 1
        edge[min(n, span["s"] + span["c"] + window - 1)] -= 1
    return np.cumsum(edge[:n]) > 0


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
                     group_limit: int = GROUP_LIMIT, digest: bool = False) -> DataFrame:
    """``docs`` without the words of repeated windows.

    ``digest=False``: the same columns, ``text`` without the removed words and
    the white space after each; texts without repeats (and nulls) unchanged.
    ``digest=True``: id, n_words, n_removed and kept_sha256 (of the kept words
    joined by one space).
    """
    ship(docs.sparkSession)
    spans = repeated_windows(docs, window, id_col, text, group_limit=group_limit)
    kept = docs.columns
    key, key2, marks, data = (fresh(kept, n) for n in ("key", "key2", "spans", "data"))
    spans = spans.select(F.col("key").alias(key), F.col("key2").alias(key2), F.col("spans").alias(marks))
    narrow = docs.select(id_col, text) if digest else docs
    rows = narrow.withColumns(dict(zip((key, key2), _keys(text)))).join(spans, [key, key2], "left")

    def measure(batches):
        for batch in batches:
            out = []
            for data, marks in zip(batch.column(1), batch.column(2)):
                words = data.as_py().split()
                gone = removed_words(len(words), marks.as_py(), window) if marks.is_valid else None
                left = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string())))],
                                             names=[id_col, "n_words", "n_removed", "kept_sha256"])

    def strip(batches):
        for batch in batches:
            out = []
            for value, found in zip(batch.column(data), batch.column(marks)):
                value = value.as_py()
                words = list(_WORD.finditer(value))
                gone = removed_words(len(words), found.as_py(), window)
                ends = [m.start() for m in words[1:]] + [len(value)]
                out.append(value[:words[0].start()] + b"".join(value[m.start():e] for m, e, g in zip(words, ends, gone.tolist()) if not g))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(out, pa.binary())], names=[*others, data])

    if digest:
        rows = rows.select(id_col, text_bytes(text).alias(data), marks)
        return rows.mapInArrow(measure, f"`{id_col}` {narrow.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string")
    others = [c for c in kept if c != text]
    hit = rows.filter(F.col(marks).isNotNull()).select(*others, text_bytes(text).alias(data), marks)
    stripped = hit.mapInArrow(strip, hit.drop(marks).schema).withColumn(text, F.col(data).cast("string")).select(*kept)
    return rows.filter(F.col(marks).isNull()).select(*kept).union(stripped)
