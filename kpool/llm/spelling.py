"""Spelling variants: words of a vocabulary that differ by one code point.

Neighbours are found by generating edits and asking Bloom filters.  Two words
are near if one is the other with a code point deleted or replaced (an insertion
is a deletion seen from the other side; of a replacement the word with the
smaller code point generates the other), so each pair is generated once.

* Words are counted in tasks, then by a grouped sum.
* The vocabulary's filters are sharded by word length and blocked: a word sets
  ``PROBES`` bits within one block of 512.  They are built by a grouped ``bit_or``
  and broadcast.  A filter of all words would grow with the vocabulary, so the
  shards are dealt into slices of at most ``MAX_BLOCKS`` blocks (16 MB); each
  slice is broadcast in a pass of its own, and the edits that it may hold are
  tested in that pass.
* Edits are hashed, not spelled: a word's hash is a sum over its places, so the
  hash of an edit follows from sums before and after the place.
* Only edits that the filters pass are shuffled: as the hash of the edited word,
  the hash of the word itself, the place and the new code point.  An exact join
  with the vocabulary on the 128-bit hash, and a comparison of the spelled edit
  with the word found, remove all false positives.
* Roots: each word's form has at least twice its count, so chains are short;
  they are followed by pointer jumping.

Defined cases
-------------
* Null and empty texts hold no words.  A null id reads as an empty text in the
  hash that decides on deletions.  Repeated rows count as often as they occur.
* Texts of any length are read in parts cut between words; a word may be as long
  as its text.
* Ties in n go to the smaller word in code-point order.
* Columns other than the id and the text are not read.  Empty tables, and tables
  without frequent words, give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpool.llm._io import cut, ship, text_bytes

LETTERS = "A-Za-zÀ-ÿ"  # fixed value: a word is a maximal run of these
DROP_EVERY = 97                  # fixed value: of the runs' hashes
PART = 1 << 20                   # bytes of a text read at once
KEPT = 1 << 18                   # words a task counts before it hands them on
KEPT_LETTERS = 1 << 25           # or so many letters in them
BLOCK = 512                      # bits
PROBES = 8
BITS_A_WORD = 16
MAX_BLOCKS = 1 << 18             # of filters broadcast at once (16 MB)
LONGEST_SHARD = 64               # words of this length or more share a shard
EDITS = 1 << 20                  # hashed at once in a task
DELETED = 0                      # in place of a new code point

_RUN = re.compile(f"[{LETTERS}]+")
_END = re.compile(rb"[^A-Za-z\xc3\x80-\xbf]")  # a byte that cannot belong to a letter of a run


# --- counting ---------------------------------------------------------------

def runs(text: bytes) -> Iterator[list[str]]:
    """The runs of a text, A-Z lower-cased, part by part."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PART:
            stop = _END.search(text, at + PART)
            end = stop.start() if stop else end
        # bytes.lower changes A-Z only
        yield _RUN.findall(text[at:end].lower().decode("utf-8", "replace"))
        at = end


def misspelled(doc_id: str, run: str) -> str:
    """The run, without one code point where its hash says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DROP_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(shortest: int):
    def hand_on(total: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    def task(batches):
        total: dict[str, int] = {}
        letters = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Counter()
                for part in runs(text.as_py()):
                    own.update(part)
                start = zlib.crc32(f"{doc_id}:".encode())
                for run, n in own.items():  # equal runs of a document share their hash
                    if len(run) >= shortest:
                        if zlib.crc32(run.encode(), start) % DROP_EVERY == 0:
                            run = misspelled(doc_id, run)
                            if len(run) < shortest:
                                continue
                        if run in total:
                            total[run] += n
                        else:
                            total[run] = n
                            letters += len(run)
                if len(total) > KEPT or letters > KEPT_LETTERS:
                    yield hand_on(total)
                    total, letters = {}, 0
        yield hand_on(total)
    return task


def vocabulary(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points and ``least`` occurrences."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), text_bytes(text).alias("t"))
    return rows.mapInArrow(_count(shortest), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# --- hashes -----------------------------------------------------------------

def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class WordHash:
    """sum over places of value(code point) * odd^place, modulo 2^64."""

    def __init__(self, seed: int):
        self.value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.odd = mix(np.array([seed + 7], np.uint64))[0] | np.uint64(1)

    def powers(self, length: int) -> np.ndarray:
        out = np.full(length, self.odd, np.uint64)
        out[:1] = 1
        return np.cumprod(out, dtype=np.uint64)

    def words(self, codes: np.ndarray) -> np.ndarray:
        return (self.value[codes] * self.powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)

    def deletions(self, codes: np.ndarray) -> np.ndarray:
        """Hash of each row without the code point at each place."""
        power = self.powers(codes.shape[1])
        here = self.value[codes] * power
        shifted = np.concatenate([np.zeros((len(codes), 1), np.uint64), self.value[codes[:, 1:]] * power[:-1]], axis=1)
        before = np.cumsum(here, axis=1, dtype=np.uint64) - here
        after = shifted.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(shifted, axis=1, dtype=np.uint64)
        return before + after

    def replaced(self, whole: np.ndarray, old: np.ndarray, new: np.ndarray, power: np.ndarray) -> np.ndarray:
        return whole + (self.value[new] - self.value[old]) * power


HASHES = WordHash(1), WordHash(2)


def by_length(words: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words of one length, and their code points as rows."""
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for length, some in groups.items():
        step = max(1, EDITS // max(length, 1))
        for i in range(0, len(some), step):
            part = some[i:i + step]
            yield part, np.frombuffer("".join(part).encode("latin-1"), np.uint8).reshape(len(part), length)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _hashed(batches):
    for batch in batches:
        n = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for words, codes in by_length(list(n)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([n[w] for w in words], pa.int64()), pa.array([codes.shape[1]] * len(words), pa.int32()),
                 *(pa.array(signed(h.words(codes))) for h in HASHES)], names=["word", "n", "length", "h1", "h2"])


# --- filters ----------------------------------------------------------------

def places(h1: np.ndarray, h2: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of hashed words in a shard of ``blocks`` blocks, and the number that ``probe`` reads."""
    return (mix(h1) % np.uint64(blocks)).astype(np.int64), mix(h2)


def probe(spread: np.ndarray, i: int) -> np.ndarray:
    """The i-th bit of a word within its block."""
    return (((spread >> np.uint64(8 * i)) & np.uint64(255)) * np.uint64(2) + np.uint64(i % 2)).astype(np.int64)


class Shards:
    """Blocks per word length, laid out one shard after another, and the slices of a pass each."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = {s: max(1, -(-n * BITS_A_WORD // BLOCK)) for s, n in sorted(counts.items())}
        self.begin, at = {}, 0
        for s, size in self.blocks.items():
            self.begin[s] = at
            at += size
        self.slices = [(i, min(i + MAX_BLOCKS, at)) for i in range(0, at, MAX_BLOCKS)]


def shard_of(length: int) -> int:
    return min(length, LONGEST_SHARD)


def _bits(shards: Shards, begin: int, end: int):
    def task(batches):
        for batch in batches:
            length = np.minimum(batch.column(0).to_numpy(), LONGEST_SHARD)
            h1, h2 = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
            for s in np.unique(length):
                own = length == s
                block, spread = places(h1[own], h2[own], shards.blocks[int(s)])
                block += shards.begin[int(s)]
                inside = (block >= begin) & (block < end)
                bits = np.stack([probe(spread, i) for i in range(PROBES)], axis=1)
                at = ((block[inside] - begin)[:, None] * (BLOCK // 64) + bits[inside] // 64).ravel()
                mask = (np.uint64(1) << (bits[inside] % 64).astype(np.uint64)).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(signed(mask))], names=["at", "bits"])
    return task


class Filter:
    """The blocks from ``begin`` to ``end`` of all shards."""

    def __init__(self, shards: Shards, begin: int, end: int, bits: np.ndarray):
        self.shards, self.begin, self.end, self.bits = shards, begin, end, bits

    def holds(self, length: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether words of ``length`` may be in this slice (never false for one that is)."""
        shard = shard_of(length)
        if shard not in self.shards.blocks:
            return np.zeros(len(h1), bool)
        first = self.shards.begin[shard]
        if first >= self.end or first + self.shards.blocks[shard] <= self.begin:
            return np.zeros(len(h1), bool)
        block, spread = places(h1, h2, self.shards.blocks[shard])
        block += first - self.begin
        out = np.flatnonzero((block >= 0) & (block < self.end - self.begin))
        for i in range(PROBES):  # most words fail the first probes
            bit = probe(spread[out], i)
            word = self.bits[block[out] * (BLOCK // 64) + bit // 64]
            out = out[(word >> (bit % 64).astype(np.uint64)) & np.uint64(1) == 1]
        found = np.zeros(len(h1), bool)
        found[out] = True
        return found


def build(words: DataFrame, shards: Shards, begin: int, end: int) -> Filter:
    cells = words.select("length", "h1", "h2").mapInArrow(_bits(shards, begin, end), "at long, bits long") \
        .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros((end - begin) * (BLOCK // 64), np.uint64)
    bits[cells["at"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return Filter(shards, begin, end, bits)


# --- edits ------------------------------------------------------------------

def edits(codes: np.ndarray, alphabet: np.ndarray):
    """(row, place, new code point or ``DELETED``, h1, h2, length) of the edits of
    words of one length that its partner does not generate."""
    rows, length = codes.shape
    whole = [h.words(codes) for h in HASHES]
    if length > 1:
        gone = [h.deletions(codes) for h in HASHES]
        once = np.ones(codes.shape, bool)
        once[:, :-1] = codes[:, :-1] != codes[:, 1:]  # of equal neighbours the last
        row, place = np.nonzero(once)
        yield row, place, np.full(len(row), DELETED), gone[0][row, place], gone[1][row, place], length - 1
    powers = [h.powers(length) for h in HASHES]
    step = max(1, EDITS // max(rows * len(alphabet), 1))
    for i in range(0, length, step):
        old = codes[:, i:i + step]
        row, place, letter = np.nonzero(old[:, :, None] < alphabet)
        old, new, place = old[row, place].astype(np.int64), alphabet[letter].astype(np.int64), place + i
        yield row, place, new, *(h.replaced(w[row], old, new, p[place]) for h, w, p in zip(HASHES, whole, powers)), length


def _probe(sent, alphabet: np.ndarray):
    def task(batches):
        held = sent.value
        for batch in batches:
            for words, codes in by_length(batch.column(0).to_pylist()):
                step = max(1, EDITS // (codes.shape[1] * (1 + len(alphabet))))
                for i in range(0, len(words), step):
                    part = codes[i:i + step]
                    own = [h.words(part) for h in HASHES]
                    for row, place, new, h1, h2, length in edits(part, alphabet):
                        hit = np.flatnonzero(held.holds(length, h1, h2))
                        if len(hit):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(signed(h1[hit])), pa.array(signed(h2[hit])), pa.array(signed(own[0][row[hit]])), pa.array(signed(own[1][row[hit]])),
                                 pa.array(place[hit], pa.int32()), pa.array(new[hit], pa.int32())], names=["h1", "h2", "w1", "w2", "place", "new"])
    return task


def spelled(word: Column, place: Column, new: Column) -> Column:
    """The edit in full."""
    letter = F.when(new == DELETED, F.lit("")).otherwise(F.char(new))
    return F.concat(F.substring(word, F.lit(1), place), letter, F.substring(word, place + 2, F.length(word)))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, m): every pair of near words once, from (word, n, length, h1, h2)."""
    spark = words.sparkSession
    counts: dict[int, int] = {}
    for r in words.groupBy(F.least("length", F.lit(LONGEST_SHARD)).alias("s")).count().collect():  # at most LONGEST_SHARD rows
        counts[r["s"]] = r["count"]
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()  # letters of one class
    alphabet = np.array(sorted(ord(r["c"]) for r in letters if r["c"]), np.uint8)
    shards = Shards(counts)
    found = None
    for begin, end in shards.slices:
        sent = spark.sparkContext.broadcast(build(words, shards, begin, end))
        hits = cut(words.select("word").mapInArrow(_probe(sent, alphabet), "h1 long, h2 long, w1 long, w2 long, place int, new int"))
        sent.destroy()  # one slice at a time
        found = hits if found is None else found.union(hits)
    if found is None:
        found = spark.createDataFrame([], "h1 long, h2 long, w1 long, w2 long, place int, new int")
    known = words.select("h1", "h2", F.col("word").alias("other"), F.col("n").alias("m"))
    own = words.select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), "word", "n")
    return found.join(known, ["h1", "h2"]).join(own, ["w1", "w2"]) \
        .filter(spelled(F.col("word"), F.col("place"), F.col("new")) == F.col("other")).select("word", "n", "other", "m")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word of (word, form): forms followed to the last."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    left = at
    while True:
        jump = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(left.join(jump, "root", "left").select("word", "root", "next"))
        if not moved.filter("next IS NOT NULL").limit(1).count():
            return moved.select("word", "root")
        at = left = moved.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shortest: int = 5, least: int = 3, ratio: int = 2) -> DataFrame:
    """One row per word of the vocabulary: ``word, n, n_near, form, form_n, root``.

    ``form`` is the near word of largest n (ties: the smallest), if that n is at
    least ``ratio`` times the word's; ``root`` the last of the chain of forms.
    """
    words = cut(vocabulary(docs, text, id_col, shortest, least).mapInArrow(_hashed, "word string, n long, length int, h1 long, h2 long"))
    pairs = cut(near_pairs(words))
    both = pairs.union(pairs.select("other", "m", "word", "n"))
    best = F.min(F.struct((-F.col("m")).alias("m"), "other"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    out = words.select("word", "n").join(near, "word", "left")
    is_form = -F.col("best.m") >= F.col("n") * ratio
    out = cut(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")))
    last = roots(out.filter("form IS NOT NULL"))
    return out.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
