"""Token ids of whole texts, and a bit-packed file format for them.

Format (one file per shard, little-endian):

* header: magic (8 bytes), bits per id (u32), ids per block (u32);
* blocks: ``BLOCK`` ids each (the last may hold fewer), every id in ``bits``
  bits, lowest bit first, padded to a whole byte per block;
* index: byte offset of every block (u64, one more than blocks), then per
  document its id (i64), its first id in the shard (u64) and a null flag (u8);
* footer: position of the index, blocks, documents, ids (u64 each), magic.

``bits`` is the least that holds the vocabulary.  A reader needs the footer
and index to reach any document: id ``i`` lies in block ``i // BLOCK``.

Defined cases: a null text is an empty one and holds only the end id.  Null
ids come first; rows of one id are ordered by a hash of their text, equal rows
in any order.  Empty tables give no shards and no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpool.llm._io import cut, running_start, scratch_folder, ship, text_bytes

MAGIC = b"KPTOKEN1"
BLOCK = 1 << 16
END_ID = 1

_LOADED: dict[str, "Encoder"] = {}


class Encoder(dict):
    """Ids of texts under a word-level tokenizer, as bytes of u32.

    The tokenizer drops white space and never joins across it, so a text's
    ids are the ids of its words one after another, and words repeat: this
    dictionary keeps the ids of words seen by this worker.  At ``limit``
    entries it starts anew and only the generation before stays at hand, so
    memory is bounded and common words are not lost.

    Words of ASCII and accented Latin letters are cut as the tokenizer's
    pattern cuts them (runs of letters, single digits, runs of marks), and
    runs of letters go straight to the library's merge model, which spares its
    normaliser.  Words with an apostrophe, other scripts or a possible special
    token go through the library whole.  Only ASCII letters are lower-cased
    before look-up, and not in words where one stands before a character that
    may join it: the tokenizer composes first and lower-cases after, and some
    composed letters exist in lower case only.
    """

    #: letters that are single code points under NFC and lower-case to one letter
    LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
    PLAIN = re.compile(f"[\x21-\x26\x28-\x40\x5b-\x7e{LETTERS}]+")  # no apostrophe, no control
    #: a capital before a character from U+0180 on, as all that compose with a letter before them are
    JOINED = re.compile(rb"[A-Z][\xc6-\xff]")
    PIECES = re.compile(f"([{LETTERS}]+)|[0-9]|[^0-9{LETTERS}]+")

    def __init__(self, path: str, limit: int = 600_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merge, self.limit, self.older = self.tokenizer.model.tokenize, limit, {}
        self.coded = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab(with_added_tokens=True).values()))]
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        accented = [chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha() and c != 0x130]
        self.spelled = {ord(c): as_bytes.pre_tokenize_str(c.lower())[0][0] for c in accented}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            text = word.decode("utf-8", "replace")
            if text.isalpha() and text.isascii():
                ids = b"".join([self.coded[t.id] for t in self.merge(text)])
            elif b"<|" in word or not self.PLAIN.fullmatch(text):
                ids = self._whole(text)
            else:
                ids = b"".join([self._letters(m[0]) if m[1] else self._marks(m[0]) for m in self.PIECES.finditer(text)])
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return b"".join([self.coded[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def _letters(self, text: str) -> bytes:
        word = text if text.isascii() else text.translate(self.spelled)
        return b"".join([self.coded[t.id] for t in self.merge(word)])

    def _marks(self, text: str) -> bytes:
        key = text.encode()
        known = self.get(key) or self.older.get(key)
        if known is None:
            known = self._whole(text)
            if len(key) <= 64:
                self[key] = known
        return known

    def ids(self, text: bytes) -> bytes:
        if b"<|" in text or not text.isascii() and self.JOINED.search(text):
            words = [w if b"<|" in w or self.JOINED.search(w) else w.lower() for w in text.split()]
        else:
            words = text.lower().split()
        return b"".join(map(self.__getitem__, words))


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def vocabulary_bits(path: str) -> int:
    """Bits for the largest id of the vocabulary, special tokens included."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    return max(1, max([END_ID, *vocabulary.values()]).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, lowest first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(planes[:, :bits].ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits)
    planes = np.zeros((n, 32), np.uint8)
    planes[:, :bits] = flat.reshape(n, bits)
    return np.packbits(planes, axis=1, bitorder="little").view("<u4").ravel()


#: schemes that Hadoop and Arrow spell differently
SCHEMES = {"s3a": "s3", "s3n": "s3"}
#: schemes that Arrow opens, ``file`` being a folder that all executors mount
KNOWN = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")


def arrow_path(path: str) -> str:
    """A path of the cluster's file system as Arrow names it.  Raises where Arrow has
    no such file system, or the path does not say which one it means: an executor
    would open a local file of its own."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"{path} names no file system")
    if scheme == "dbfs":  # mounted on every node
        return "file:///dbfs/" + rest.lstrip("/")
    scheme = SCHEMES.get(scheme, scheme)
    if scheme not in KNOWN:
        raise ValueError(f"token files cannot be written to {scheme}: paths; give write_token_shards another folder")
    return "file:///" + rest.lstrip("/") if scheme == "file" else f"{scheme}:{rest}"


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("/"):  # a single file opened by hand; shards always have a scheme
        return fs.LocalFileSystem(), path
    path = arrow_path(path)
    if path.startswith("file:"):
        return fs.LocalFileSystem(), path[len("file://"):]
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    def __init__(self, path: str, bits: int):
        where, name = _filesystem(path)
        where.create_dir(name.rpartition("/")[0], recursive=True)
        self.out, self.bits = where.open_output_stream(name), bits
        self.out.write(MAGIC + np.array([bits, BLOCK], "<u4").tobytes())
        self.at, self.offsets, self.waiting, self.n_waiting = 16, [16], [], 0
        self.n_ids, self.doc_ids, self.starts, self.nulls = 0, [], [], []

    def add(self, doc_id, ids: bytes) -> None:
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids) // 4
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= BLOCK:
            self._flush(False)

    def _flush(self, rest: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        whole = len(ids) if rest else len(ids) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            self.at += self.out.write(pack_bits(ids[i:min(i + BLOCK, whole)], self.bits))
            self.offsets.append(self.at)
        self.waiting, self.n_waiting = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        for values, kind in ((self.offsets, "<u8"), (self.doc_ids, "<i8"), (self.starts, "<u8"), (self.nulls, "u1")):
            self.out.write(np.array(values, kind).tobytes())
        footer = [self.at, len(self.offsets) - 1, len(self.doc_ids), self.n_ids]
        self.out.write(np.array(footer, "<u8").tobytes() + MAGIC)
        self.out.close()


class Shard:
    """Random access to one file: ``ids(first, stop)`` reads only the blocks it needs."""

    def __init__(self, path: str):
        where, name = _filesystem(path)
        self.file = where.open_input_file(name)
        size = self.file.size()
        index, blocks, docs, self.n_ids = np.frombuffer(self._at(size - 40, 32), "<u8").astype(int).tolist()
        head = self._at(0, 16)
        if self._at(size - 8, 8) != MAGIC or head[:8] != MAGIC:
            raise ValueError(f"{path} is not a whole token shard")
        self.bits, self.block = np.frombuffer(head[8:], "<u4").astype(int).tolist()
        self.offsets = np.frombuffer(self._at(index, 8 * (blocks + 1)), "<u8").astype(np.int64)
        index += 8 * (blocks + 1)
        self.doc_ids = np.frombuffer(self._at(index, 8 * docs), "<i8")
        self.starts = np.append(np.frombuffer(self._at(index + 8 * docs, 8 * docs), "<u8").astype(np.int64), self.n_ids)
        self.nulls = np.frombuffer(self._at(index + 16 * docs, docs), "u1").astype(bool)

    def _at(self, position: int, n: int) -> bytes:
        self.file.seek(position)
        return self.file.read(n)

    def ids(self, first: int, stop: int) -> np.ndarray:
        if stop <= first:
            return np.empty(0, "<u4")
        a, b = first // self.block, (stop - 1) // self.block + 1
        data, base = self._at(int(self.offsets[a]), int(self.offsets[b] - self.offsets[a])), self.offsets[a]
        parts = [unpack_bits(data[self.offsets[i] - base:self.offsets[i + 1] - base],
                             min(self.block, self.n_ids - i * self.block), self.bits) for i in range(a, b)]
        return np.concatenate(parts)[first - a * self.block:stop - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """All (number, ids), reading about ``at_once`` ids (or one document) at a time."""
        i, n = 0, len(self.doc_ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + at_once, "right")) - 1)
            j = min(j, n)
            run = self.ids(int(self.starts[i]), int(self.starts[j]))
            for k in range(i, j):
                yield k, run[self.starts[k] - self.starts[i]:self.starts[k + 1] - self.starts[i]]
            i = j


def write_token_shards(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Encode whole texts, append the end id to each, and write one bit-packed
    file per range of ids.  Without ``folder`` the files live in the shared folder
    until the driver ends.  Returns the manifest (shard, path, n_docs, n_ids,
    start): shards ascend in ``id_col``; ``start`` counts the ids before.

    A task writes under a name of its own, and the manifest holds the names of
    the attempts that ended well, so a retried task leaves no wrong shard.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    folder = folder or scratch_folder(spark, "tokens")[0]
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # a path without a scheme is one of the cluster's default file system
    folder = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    arrow_path(folder)  # raises before any work is done
    bits = vocabulary_bits(tokenizer)
    end = np.array([END_ID], "<u4").tobytes()

    def write(batches):
        from pyspark import TaskContext

        shard, path, out = TaskContext.get().partitionId(), f"{folder}/{uuid.uuid4().hex}.tok", None
        enc = encoder(tokenizer)
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                out = out or ShardWriter(path, bits)
                out.add(doc_id, enc.ids(data.as_py()) + end)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_docs": [len(out.doc_ids)], "n_ids": [out.n_ids]},
                                             schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text).alias("data"))
    rows = rows.withColumn("tie", F.xxhash64("data")).repartitionByRange("doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie").select("doc_id", "data")
    manifest = cut(rows.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"))
    return running_start(manifest, "shard", "n_ids", "start")


def read_token_shards(manifest: DataFrame, id_name: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document from the files: id, start, n_tokens, ids_crc32 and,
    if asked for, the ids."""
    ship(manifest.sparkSession)

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard, rows = Shard(path), []
                for i, ids in shard.documents():
                    rows.append((None if shard.nulls[i] else int(shard.doc_ids[i]), base + int(shard.starts[i]), len(ids),
                                 zlib.crc32(ids.astype("<u4").tobytes()), ids.astype(np.int32) if with_ids else None))
                    if len(rows) >= 4096:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
              ("ids", pa.list_(pa.int32()))][:5 if with_ids else 4]

    def _rows(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), f[1]) for c, f in zip(zip(*rows), fields)], schema=pa.schema(fields))

    n = manifest.count()
    files = manifest.repartitionByRange(max(1, n), "shard").select("path", "start")
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return files.mapInArrow(read, kind).withColumnRenamed("doc_id", id_name)
