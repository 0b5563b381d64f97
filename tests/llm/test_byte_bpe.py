"""Byte-level BPE against the tiktoken library and against plain merging."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from kpool.llm import byte_bpe as B
from kpool.llm.queries import QUERIES, table

RANKS = P.path("byte_bpe_50k.tiktoken")


def reference(path=RANKS):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    with open(RANKS, "rb") as f:
        return B.vocabulary(f.read())


def plain(ranks, match):
    if match in ranks:
        return [ranks[match]]
    parts = [match[i:i + 1] for i in range(len(match))]
    while len(parts) > 1:
        found = [ranks.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:])]
        if min(found) == 1 << 40:
            break
        i = found.index(min(found))
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def odd_texts(rng, count):
    pools = ["abcdefghijklmnopqrstuvwxyz", "aab", " \n\t\r  ", "0123456789", "!?.,'\"<|>", "éÀßñœ", "中文漢字かな", "🙂👍🏽‍", "'s't'll've", "\x00\x1c\x85 "]
    for _ in range(count):
        yield "".join("".join(rng.choices(rng.choice(pools), k=rng.randint(1, 9))) for _ in range(rng.randint(0, 25)))


def test_equals_the_library(words):
    rng = random.Random(3)
    encoding, encoder = reference(), B.Encoder(words, P.PATTERN)
    texts = list(odd_texts(rng, 3000)) + ["", " ", "a" * 100_000, "ab" * 50_000 + " " * 5_000 + "x", "<|endoftext|>", "don't we'll I'VE"]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGH", k=20_000)), " ".join(rng.choices("abc", k=9)) * 200_000]
    ids, counts = encoder.encode(texts)
    at = 0
    for text, n in zip(texts, counts):
        own = ids[at:at + n].tolist()
        at += n
        assert own == encoding.encode_ordinary(text)
        assert words.decode(np.array(own, np.int64)).tobytes() == text.encode()
    assert at == len(ids)


def test_any_ranks_and_long_runs():
    """Ranks in any order: pairs that bring forth a pair of a smaller rank, tokens
    that merging never reaches."""
    for seed in range(60):
        rng = random.Random(seed)
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 300:
            t = bytes(rng.choices(b"abc", k=rng.randint(2, 5)))
            if t not in tokens:
                tokens.append(t)
        order = list(range(len(tokens)))
        rng.shuffle(order)
        ranks = dict(zip(tokens, order))
        words = B.Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))
        matches = [bytes(rng.choices(b"abcd" if i % 2 else b"ab", k=rng.randint(1, 40))) for i in range(200)] + [b"a" * 301, b"ab" * 100, b"aab" * 90]
        flat, counts = words.encode_matches(matches)
        at = 0
        for m, n in zip(matches, counts):
            assert flat[at:at + n].tolist() == plain(ranks, m), (seed, m)
            at += n


def test_pair_table_holds_every_pair():
    rng = np.random.default_rng(1)
    left, right = rng.integers(0, 500, 20_000).astype(np.int32), rng.integers(0, 500, 20_000).astype(np.int32)
    key, first = np.unique(left.astype(np.int64) * 1000 + right, return_index=True)
    left, right = left[first], right[first]
    t = B.PairTable(left, right, np.arange(len(left), dtype=np.int32))
    assert (t.ranks(left, right) == np.arange(len(left))).all()
    assert (t.ranks(left, right + 500) == B.NONE).all() and (t.ranks(left, np.full_like(right, -1)) == B.NONE).all()


def test_missing_bytes_raise():
    with pytest.raises(ValueError):
        B.Vocabulary(b"YQ== 0\n")


def test_forgets_and_goes_on(words, monkeypatch):
    monkeypatch.setattr(B, "MATCHES", 50)
    monkeypatch.setattr(B, "PART", 200)
    encoding, encoder = reference(), B.Encoder(words, P.PATTERN)
    texts = list(odd_texts(random.Random(9), 200)) + ["word   \n next " * 100]
    ids, counts = encoder.encode(texts)
    assert ids.tolist() == [i for t in texts for i in encoding.encode_ordinary(t)]
    assert len(encoder.number) <= 400


def test_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(B, "GROUP", 1000)
    texts = [None, "", "same", "same", " x" * 3000, "a\U0001F600b"]
    df = spark.createDataFrame([(i if i else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, ids int").withColumn("Decoded", F.lit("mine"))
    coded = B.encode_bpe(df, RANKS, P.PATTERN)
    assert coded.columns == ["doc_id", "Decoded", "ids"]
    out = B.decode_bpe(coded, RANKS).collect()
    encoding = reference()
    want = sorted((encoding.encode_ordinary(t or ""), (t or "").encode()) for t in texts)
    assert sorted((r["ids"], bytes(r["decoded"])) for r in out) == want
    empty = B.decode_bpe(B.encode_bpe(df.limit(0), RANKS, P.PATTERN), RANKS)
    assert empty.count() == 0
    odd = spark.createDataFrame([(1, None), (2, [1, None]), (3, [60000]), (4, [-1]), (5, []), (6, [0, 1])], "i int, ids array<int>")
    got = {r["i"]: r["decoded"] for r in B.decode_bpe(odd, RANKS).collect()}
    assert got == {1: b"", 2: None, 3: None, 4: None, 5: b"", 6: encoding.decode_bytes([0, 1])}


def test_query_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    encoding = reference()
    want = {}
    for r in table(spark, sf_dir, "documents").collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op12_byte_level_bpe"](spark, sf_dir).collect()}
    assert got == want


def test_rows_leave_in_bounded_groups(monkeypatch):
    monkeypatch.setattr(B, "GROUP", 100)
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = rng.integers(0, 90, rng.integers(0, 40))
        groups = list(B._groups(sizes))
        assert [i for a, b in groups for i in range(a, b)] == list(range(len(sizes)))
        assert all(sizes[a:b - 1].sum() <= 100 for a, b in groups)
