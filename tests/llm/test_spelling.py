"""Spelling variants against every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpool.llm import spelling as S
from kpool.llm.queries import QUERIES, table


def words_of(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = words_of(docs)
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    found = {}
    for w in n:
        others = [x for size in (len(w) - 1, len(w), len(w) + 1) for x in by_size.get(size, []) if x != w and near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= 2 * n[w] else None
        found[w] = (n[w], len(others), form, n[form] if form else None)
    rows = {}
    for w, f in found.items():
        root = w
        while found[root][2] is not None:
            root = found[root][2]
        rows[w] = (*f, root)
    return rows


def result(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def noisy(rng, count, bases, letters):
    docs = []
    for i in range(count):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(bases)
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]]) or "a"
            words.append(w)
        docs.append((i, " ".join(words)))
    return docs


def test_hashes_of_edits():
    rng = np.random.default_rng(1)
    codes = rng.integers(97, 123, (30, 9)).astype(np.uint8)
    alphabet = np.array(sorted(set(codes.ravel().tolist()) | {0xE9}), np.uint8)
    seen = set()
    for row, place, new, h1, h2, length in S.edits(codes, alphabet):
        for r, p, c, a, b in zip(row, place, new, h1, h2):
            word = codes[r].tolist()
            word[p:p + 1] = [c] if c else []
            assert len(word) == length
            spelled = np.array([word], np.uint8)
            assert (S.HASHES[0].words(spelled)[0], S.HASHES[1].words(spelled)[0]) == (a, b)
            seen.add((r, tuple(word)))
    for r in range(30):  # all deletions, and replacements by larger code points
        w = codes[r].tolist()
        want = {tuple(w[:i] + w[i + 1:]) for i in range(9)} | {tuple(w[:i] + [c] + w[i + 1:]) for i in range(9) for c in alphabet.tolist() if c > w[i]}
        assert {e for q, e in seen if q == r} == want


def test_filter_has_no_false_negatives(spark):
    words = ["".join(random.Random(i).choices("abcdefgh", k=5 + i % 4)) for i in range(3000)]
    df = spark.createDataFrame([(w, 1) for w in set(words)], "word string, n long").mapInArrow(S._hashed, "word string, n long, length int, h1 long, h2 long")
    counts = Counter(len(w) for w in set(words))
    shards = S.Shards(counts)
    held = S.build(df, shards, *shards.slices[0])
    miss = hit = 0
    for part, codes in S.by_length(sorted(set(words))):
        assert held.holds(codes.shape[1], *(h.words(codes) for h in S.HASHES)).all()
        other = codes.copy()
        other[:, 0] = 122
        found = held.holds(codes.shape[1], *(h.words(other) for h in S.HASHES))
        miss, hit = miss + (~found).sum(), hit + found.sum()
    assert hit < 0.02 * (miss + hit)


@pytest.mark.parametrize("blocks", [1 << 18, 7])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(S, "MAX_BLOCKS", blocks)  # several slices
    rng = random.Random(blocks)
    docs = noisy(rng, 250, ["Hello", "hallo", "worlds", "wörlds", "aabaab", "ÀÉabcé", "spelling", "x×y÷zab", "spellings", "aaaaaaa"], "abélsÿ×A")
    got = result(S.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)))
    want = brute(docs)
    assert got == want and len(want) > 100
    assert any(w[2] and w[4] != w[2] for w in want.values())  # a chain of forms


def test_chains_and_ties(spark):
    text = " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["abbbb"] * 48 + ["bbbbb"] * 96 + ["ccccc"] * 3 + ["ccccd"] * 6 + ["cccce"] * 6)
    docs = [(None, text)]
    got = result(S.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs) and got["aaaaa"][4] == "bbbbb" and got["ccccc"][2] == "ccccd"


def test_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(S, "PART", 50)
    long = "é" * 30_000 + "b" * 40_000
    docs = [(1, None), (2, ""), (None, "twins twins twins twin TWINS"), (3, f"{long} {long[1:]}\n{long}"), (3, f"{long},{long[1:]} {long[1:]}"),
            (4, "日本語abcdé abcdé×abcdé abcdé " * 40), (4, "日本語abcdé abcdé×abcdé abcdé " * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("Word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("root", F.lit(None).cast("int"))
    assert result(S.spelling_variants(df)) == brute(docs)
    for nothing in (df.limit(0), df.filter("doc_id < 3")):
        out = S.spelling_variants(nothing)
        assert out.count() == 0 and out.columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert result(QUERIES["op13_spelling_variants"](spark, sf_dir)) == brute(docs)


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(4)
    for part in (1, 7, 50):
        monkeypatch.setattr(S, "PART", part)
        for _ in range(200):
            text = "".join(rng.choices("abZéÀÿ×Ā日 \n-1🙂", k=rng.randint(0, 120)))
            want = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall("[A-Za-zÀ-ÿ]+", text)]
            assert [w for some in S.runs(text.encode()) for w in some] == want
