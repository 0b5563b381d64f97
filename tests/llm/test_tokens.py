import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpool.llm import packing as P
from kpool.llm import tokens as K
from kpool.llm.queries import word_tokenizer

TEXTS = [None, "", " \n", "a", "Hello, WORLD!! it's <|endoftext|> é ß", "x" * 3000 + " y", "the cat " * 6000, "日本 Σας İx", "a"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_tokenizer())
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_library(reference):
    rng, enc = random.Random(5), K.Encoder(word_tokenizer(), limit=500)
    letters = "abzAZ09éÉßŒœİıſÀ×÷ñ'’.,!?$#<|>\x1c\x85\xa0  \t\n日本Σς́_-"
    for i in range(8000):
        s = "".join(rng.choice(letters) for _ in range(rng.randrange(14)))
        if i % 10 == 0:
            s += rng.choice(["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>x", "don't I'LL we've"]) + s
        assert np.frombuffer(enc.ids(s.encode()), "<u4").tolist() == reference(s)[:-1]


def test_capitals_with_combining_marks(reference):
    enc = K.Encoder(word_tokenizer())
    marks = [chr(c) for c in [*range(0x300, 0x370), 0x93C, 0x1DC4, 0x20D7, 0x3099, 0xFE20]]
    for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        for m in marks:
            for s in (a + m, f"x{a}{m}Q{a} Plain", f"{a}\u0323{m}", f"\u0416{a}{m}a {a}'{m}"):
                assert np.frombuffer(enc.ids(s.encode()), "<u4").tolist() == reference(s)[:-1], ascii(s)
    rng, letters = random.Random(6), "aAJHTWYjwy\u030a\u030c\u0308\u0331\u0301\u0323\u00c9\u0416'., <|1"
    for _ in range(8000):
        s = "".join(rng.choice(letters) for _ in range(rng.randrange(14)))
        assert np.frombuffer(enc.ids(s.encode()), "<u4").tolist() == reference(s)[:-1], ascii(s)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype("<u4")
    data = K.pack_bits(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert K.unpack_bits(data, 1001, bits).tolist() == ids.tolist()
    value = int.from_bytes(data, "little")  # by hand: lowest bit first
    assert [(value >> i * bits) & ((1 << bits) - 1) for i in range(1001)] == ids.tolist()


def test_shards_random_access(tmp_path, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 64)
    docs = [np.arange(i, i + n, dtype="<u4") for i, n in enumerate([1, 0, 500, 63, 64, 65, 2])]
    w = K.ShardWriter(str(tmp_path / "a" / "x.tok"), 11)
    for i, d in enumerate(docs):
        w.add(i if i != 1 else None, d.tobytes())
    w.close()
    s = K.Shard(str(tmp_path / "a" / "x.tok"))
    assert s.nulls.tolist() == [i == 1 for i in range(7)] and s.block == 64 and s.bits == 11
    for i in (6, 2, 0, 5, 3, 1, 4):
        assert s.document(i).tolist() == docs[i].tolist()
    assert [d.tolist() for _, d in s.documents(at_once=100)] == [d.tolist() for d in docs]


def test_files_round_trip(spark, reference, tmp_path):
    rows = [(i * 7 % 9 if i != 3 else None, t, 1) for i, t in enumerate(TEXTS)] + [(0, "b c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(4)
    manifest = K.write_token_shards(df, word_tokenizer(), folder=str(tmp_path))
    got = K.read_token_shards(manifest, with_ids=True).orderBy("start").collect()
    want = defaultdict(list)
    for d, t, _ in rows:
        want[d].append(reference(t))
    at = 0
    assert [r.doc_id for r in got] == sorted((d for d, _, _ in rows), key=lambda d: (d is not None, d))
    for r in got:
        assert r.start == at and r.ids in want[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    none = K.write_token_shards(df.filter("doc_id > 99"), word_tokenizer(), folder=str(tmp_path / "none"))
    assert none.collect() == [] and K.read_token_shards(none).collect() == []


def test_running_start_spans_blocks(spark):
    from kpool.llm._io import running_start

    df = spark.range(50).select(F.col("id").alias("shard"), (F.col("id") * 3 + 1).alias("n"))
    got = {r.shard: r.start for r in running_start(df, "shard", "n", "start", width=4).collect()}
    assert got == {i: sum(j * 3 + 1 for j in range(i)) for i in range(50)}


def best_fill(counts, room):
    reach = {0}
    for x, n in counts.items():
        reach |= {s + k * x for s in reach for k in range(n + 1) if s + k * x <= room}
    return max(reach)


def test_fullest_is_exact():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randrange(1, 40): rng.randrange(0, 4) for _ in range(rng.randrange(0, 6))}
        room = rng.randrange(0, 80)
        used = P.fullest(counts, room)
        assert all(0 < m <= counts[x] for x, m in used)
        assert sum(x * m for x, m in used) == best_fill(counts, room)


def test_plan_equals_bin_by_bin():
    rng = random.Random(2)
    for _ in range(40):
        histogram = {rng.randrange(1, 31): rng.randrange(1, 30) for _ in range(8)}
        plan = P.plan_bins(histogram, 30)
        left = dict(histogram)
        for times, parts in plan:
            for _ in range(times):  # each removal is the fullest one at its time
                top = max(x for x, n in left.items() if n)
                left[top] -= 1
                assert sum(x * m for x, m in parts) == top + best_fill(left, 30 - top)
                left[top] += 1
                for x, m in parts:
                    left[x] -= m
        assert not any(left.values())


def test_packing_is_gapless_and_whole(spark, reference):
    rows = [(i if i % 5 else None, t, "s") for i, t in enumerate(TEXTS * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(5)
    pieces = P.token_pieces(df, word_tokenizer(), 128, with_ids=True)
    got = P.pack(pieces, 128).collect()
    want = sorted((str(d), p, a, tuple(ids[a:a + 128])) for d, t, _ in rows for ids in [reference(t)] for p, a in enumerate(range(0, len(ids), 128)))
    assert sorted((str(r.doc_id), r.piece, r.start, tuple(r.ids)) for r in got) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 128
    assert len(by) <= -(-sum(r.length for r in got) // 128) + 1
    assert P.pack(pieces.filter("length > 999"), 128).collect() == []
    with pytest.raises(ValueError):
        P.pack(pieces, 64)


def test_paths_of_clusters():
    assert K.arrow_path("file:/mnt/x/a.tok") == K.arrow_path("file:///mnt/x/a.tok") == "file:///mnt/x/a.tok"
    assert K.arrow_path("s3a://bucket/x") == "s3://bucket/x" and K.arrow_path("hdfs://nn:8020/x") == "hdfs://nn:8020/x"
    assert K.arrow_path("dbfs:/tmp/x") == "file:///dbfs/tmp/x" and K.arrow_path("abfss://c@a.dfs.core.windows.net/x").startswith("abfss://")
    for bad in ("/tmp/x", "wasbs://c@a/x", "relative/x", "relative/with:colon"):
        with pytest.raises(ValueError):
            K.arrow_path(bad)


def test_folder_without_a_scheme_is_qualified(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    manifest = K.write_token_shards(docs, word_tokenizer(), folder=str(tmp_path / "shards"))
    assert all(r["path"].startswith("file:/") for r in manifest.collect())
    assert K.read_token_shards(manifest).count() == 2
