"""Byte-level BPE: texts to token ids and back.

A text is cut by a pattern; each match is encoded by itself.  A match that is a
token is that token.  Others start as one token a byte; then, again and again,
the leftmost pair of neighbours whose joint bytes have the least rank becomes
one token, until no pair of neighbours is a token.

Matches that a worker has not met before are encoded together: they are put by
byte length into buckets, each a padded numpy matrix with one match a row.  A
round looks up the ranks of pairs in a hash table of (left, right), merges in
every row and closes the gaps; rows without a pair left leave the matrix.  A
round merges the leftmost pair of least rank and those later copies of it whose
turn would come next in any case: up to the first one that brings forth a pair
of a smaller rank.  So a match of a million letters takes few rounds.

Defined cases
-------------
* A null text is an empty one; an empty text has no ids, no ids have no bytes.
  Null ids decode to no bytes; a row that holds an id (or a null) that is no
  token decodes to null.
* Texts of any length: they are read in parts, cut where white space follows
  something else (no match spans that place), and ids leave a task in batches
  of bounded size.  Bytes that are no UTF-8 become U+FFFD, as in any decoder.
* Repeated rows come out as often as they go in; an empty table stays empty.
* All other columns are carried along.  A column that has the name of the
  output is replaced, as in ``withColumn``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpool.llm._io import ship, text_bytes

NONE = np.int32(2**31 - 1)  # rank of a pair that is no token
CELLS = 1 << 20             # of a matrix
PART = 1 << 20              # characters cut at once
GROUP = 1 << 22             # characters, or bytes, that leave a task at once
MATCHES = 400_000           # matches a worker remembers
IDS = 1 << 22               # ids of matches a worker remembers


class PairTable:
    """Hash table from pairs of token ids to the id of their joint bytes."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joint: np.ndarray):
        self.bits = max(4, int(2 * max(len(left), 1) - 1).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.joint = np.full(1 << self.bits, NONE, np.int32)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        place = self.home(key)
        while len(key):
            free = self.keys[place] < 0
            self.keys[place[free]] = key[free]  # of several for one place, the last stays
            put = self.keys[place] == key
            self.joint[place[put]] = joint[put]
            key, joint, place = key[~put], joint[~put], (place[~put] + 1) & ((1 << self.bits) - 1)

    def home(self, key: np.ndarray) -> np.ndarray:
        mixed = (key.astype(np.uint64) ^ (key.astype(np.uint64) >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joint tokens, ``NONE`` where there is none or a side is padding (negative)."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(len(left), NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left[todo].astype(np.int64) << 32) | right[todo].astype(np.int64)
        place = self.home(key)
        while len(todo):
            met = self.keys[place]
            hit = met == key
            out[todo[hit]] = self.joint[place[hit]]
            go_on = ~hit & (met >= 0)
            todo, key, place = todo[go_on], key[go_on], (place[go_on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


class Vocabulary:
    """Tokens and their ranks, from lines of a base64 token and its rank."""

    def __init__(self, lines: bytes):
        self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        missing = [b for b in range(256) if bytes([b]) not in self.ids]
        if missing:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        left, right, joint = [], [], []
        for token, rank in self.ids.items():
            for i in range(1, len(token)):
                a, b = self.ids.get(token[:i]), self.ids.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    joint.append(rank)
        self.pairs = PairTable(*(np.array(x, np.int32) for x in (left, right, joint)))
        size = 1 + max(self.ids.values())
        self.known = np.zeros(size, bool)
        self.length = np.zeros(size, np.int64)
        for token, rank in self.ids.items():
            self.known[rank], self.length[rank] = True, len(token)
        by_id = sorted(self.ids.items(), key=lambda x: x[1])
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.bytes = np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)

    def merged(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of byte tokens, padded by -1 at their ends, with all merges done:
        the tokens of all rows, one row after another, and their counts."""
        rows = len(tokens)
        counts = np.zeros(rows, np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        active = np.arange(rows)
        ranks = self.pairs.ranks(tokens[:, :-1], tokens[:, 1:])
        while len(active):
            least = ranks.min(axis=1) if ranks.shape[1] else np.full(len(active), NONE)
            over = least == NONE
            if over.any():
                mask = tokens[over] >= 0
                counts[active[over]] = mask.sum(axis=1)
                done.append((active[over], tokens[over][mask]))
                active, tokens, ranks, least = active[~over], tokens[~over], ranks[~over], least[~over]
                if not len(active):
                    break
            line, at = np.nonzero(self._next(tokens, ranks, least))
            tokens[line, at] = least[line]
            keep = tokens >= 0
            keep[line, at + 1] = False
            place = np.cumsum(keep, axis=1) - 1
            left = place[:, -1] + 1
            width = int(left.max())
            new = np.full((len(active), width), -1, np.int32)
            row, column = np.nonzero(keep)
            new[row, place[row, column]] = tokens[row, column]
            old = np.full((len(active), width), NONE, np.int32)  # ranks stay, but beside merges
            inner = column < ranks.shape[1]
            old[row[inner], place[row[inner], column[inner]]] = ranks[row[inner], column[inner]]
            tokens, ranks = new, old[:, :-1]
            at = place[line, at]
            if width > 1:
                for where in (at - 1, at):
                    fits = (where >= 0) & (where < width - 1)
                    i, j = line[fits], where[fits]
                    ranks[i, j] = self.pairs.ranks(tokens[i, j], tokens[i, j + 1])
        if not done:
            return np.zeros(0, np.int32), counts
        order = np.concatenate([r for r, _ in done])
        flat = np.concatenate([f for _, f in done])
        begin = np.zeros(rows, np.int64)
        begin[order] = np.concatenate([[0], np.cumsum(counts[order])])[:-1]
        return flat[ranges(begin, counts)], counts

    def _next(self, tokens: np.ndarray, ranks: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Where each row merges now: its leftmost pair of least rank, and the
        later copies that follow it whatever the merges before them bring."""
        hit = ranks == least[:, None]
        at = np.arange(ranks.shape[1])
        gap = np.maximum.accumulate(np.where(hit, -1, at), axis=1)
        hit &= (at - gap) % 2 == 1  # of overlapping pairs (a run of one token) every other one
        many = np.flatnonzero(hit.sum(axis=1) > 1)
        if not len(many):
            return hit
        some, token, rank = hit[many], tokens[many], least[many]
        line, at = np.nonzero(some)
        joint = rank[line]
        before = np.where(at > 0, token[line, np.maximum(at - 1, 0)], -1)
        merged_before = (at > 1) & some[line, np.maximum(at - 2, 0)]
        before = np.where(merged_before, joint, before)
        after = np.where(at + 2 < token.shape[1], token[line, np.minimum(at + 2, token.shape[1] - 1)], -1)
        early = (self.pairs.ranks(before, joint) < joint) | (self.pairs.ranks(joint, after) < joint)
        stop = np.zeros(some.shape, np.int32)
        stop[line, at] = early
        hit[many] = some & (np.cumsum(stop, axis=1) - stop == 0)
        return hit

    def encode_matches(self, matches: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of matches, one after another, and their counts."""
        counts = np.ones(len(matches), np.int64)
        first = np.array([self.ids.get(m, -1) for m in matches], np.int64)
        parts = [(np.flatnonzero(first >= 0), first[first >= 0].astype(np.int32))]
        rest = np.flatnonzero(first < 0)
        sizes = np.array([len(matches[i]) for i in rest], np.int64)
        bucket = np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
        for b in np.unique(bucket):
            chosen = rest[bucket == b]
            step = max(1, CELLS >> int(b))
            for i in range(0, len(chosen), step):
                part = chosen[i:i + step]
                raw = [matches[j] for j in part]
                long = np.array([len(m) for m in raw])
                tokens = np.full((len(raw), int(long.max())), -1, np.int32)
                tokens[np.arange(tokens.shape[1]) < long[:, None]] = self.single[np.frombuffer(b"".join(raw), np.uint8)]
                flat, counts[part] = self.merged(tokens)
                parts.append((part, flat))
        order = np.concatenate([p for p, _ in parts])
        flat = np.concatenate([f for _, f in parts])
        begin = np.zeros(len(matches), np.int64)
        begin[order] = np.concatenate([[0], np.cumsum(counts[order])])[:-1]
        return flat[ranges(begin, counts)], counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of tokens, one after another."""
        return self.bytes[ranges(self.start[ids], self.length[ids])]


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(lines: bytes) -> Vocabulary:
    """Parsed once a worker."""
    key = hashlib.sha256(lines).hexdigest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(lines)
    return _VOCABULARIES[key]


class Encoder:
    """Ids of texts; remembers the matches it met, up to a bound, then starts anew."""

    SPACE = regex.compile(r"\S(?=\s)")

    def __init__(self, words: Vocabulary, pattern: str):
        self.words, self.pattern = words, regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def parts(self, text: str) -> Iterable[str]:
        at = 0
        while len(text) - at > PART:
            cut = self.SPACE.search(text, at + PART)
            if cut is None:
                break
            yield text[at:cut.end()]
            at = cut.end()
        yield text[at:] if at else text

    def numbers(self, matches: list[str]) -> np.ndarray:
        new = sorted(set(matches).difference(self.number))
        if new:
            if len(self.number) + len(new) > MATCHES or len(self.flat) > IDS:
                self.forget()
                new = sorted(set(matches))
            flat, counts = self.words.encode_matches([m.encode() for m in new])
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(counts) - counts])
            self.flat, self.count = np.concatenate([self.flat, flat]), np.concatenate([self.count, counts])
            self.number.update(zip(new, range(len(self.number), len(self.begin))))
        return np.fromiter(map(self.number.__getitem__, matches), np.int64, len(matches))

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and their counts."""
        ids: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        matches: list[str] = []
        ends: list[tuple[int, int]] = []  # (text, matches up to here)
        size = 0

        def flush() -> None:
            nonlocal matches, ends, size
            number = self.numbers(matches)
            each = self.count[number]
            ids.append(self.flat[ranges(self.begin[number], each)])
            total = np.concatenate([[0], np.cumsum(each)])
            before = 0
            for i, end in ends:
                counts[i] += total[end] - total[before]
                before = end
            matches, ends, size = [], [], 0

        for i, text in enumerate(texts):
            for part in self.parts(text):
                matches += self.pattern.findall(part)
                ends.append((i, len(matches)))
                size += len(part)
                if size > PART:
                    flush()
        flush()
        return np.concatenate(ids), counts


def _groups(sizes: np.ndarray):
    """Slices of rows whose sizes add up to about ``GROUP``."""
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        total += size
        if total > GROUP:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _with_last(batch: pa.RecordBatch, begin: int, end: int, column: pa.Array, name: str) -> pa.RecordBatch:
    part = batch.slice(begin, end - begin)
    return pa.RecordBatch.from_arrays([*part.columns[:-1], column], names=[*part.schema.names[:-1], name])


def encode_bpe(df: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` without ``text``, plus ``out``: the token ids (array of int) of each
    text under the ranks in the file ``ranks``, which the driver reads and sends
    (a vocabulary, of fixed size) to the tasks.  ``pattern`` cuts the texts."""
    ship(df.sparkSession)
    with open(ranks, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    def task(batches):
        encoder = Encoder(vocabulary(sent.value), pattern)
        for batch in batches:
            raw = batch.column(batch.num_columns - 1)
            sizes = np.diff(raw.offsets.to_numpy()) if hasattr(raw, "offsets") else np.array([len(v.as_py()) for v in raw], np.int64)
            for begin, end in _groups(sizes):
                ids, counts = encoder.encode([b.decode("utf-8", "replace") for b in raw.slice(begin, end - begin).to_pylist()])
                yield _with_last(batch, begin, end, pa.ListArray.from_arrays(_offsets(counts), pa.array(ids, pa.int32())), out)

    keep = [c for c in df.columns if c.lower() not in (text.lower(), out.lower())]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.ArrayType(T.IntegerType()))])
    return df.select(*keep, text_bytes(text).alias(out)).mapInArrow(task, schema)


def decode_bpe(df: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` plus ``out``: the bytes (binary) of each row's ``ids``."""
    ship(df.sparkSession)
    with open(ranks, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    def task(batches):
        words = vocabulary(sent.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for begin, end in _groups(np.diff(column.offsets.to_numpy()) * 8):
                part = column.slice(begin, end - begin)
                ends = part.offsets.to_numpy().astype(np.int64)
                flat = part.values.slice(ends[0], ends[-1] - ends[0]).fill_null(-1).to_numpy(zero_copy_only=False)
                ends = ends - ends[0]
                fine = (flat >= 0) & (flat < len(words.known))
                fine[fine] = words.known[flat[fine]]
                bad_before = np.concatenate([[0], np.cumsum(~fine)])
                bad = bad_before[ends[1:]] > bad_before[ends[:-1]]
                flat = np.where(fine, flat, 0)
                length = np.concatenate([[0], np.cumsum(np.where(fine, words.length[flat], 0))])
                raw = words.decode(flat[fine])
                cells = [None if b else raw[i:j].tobytes() for b, i, j in zip(bad, length[ends[:-1]], length[ends[1:]])]
                yield _with_last(batch, begin, end, pa.array(cells, pa.binary()), out)

    keep = [c for c in df.columns if c.lower() != out.lower()]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.BinaryType())])
    whole = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>"))
    return df.select(*keep, whole.alias(out)).mapInArrow(task, schema)
