import hashlib
import random
import re
from collections import Counter

import pytest

from kpool.llm.substring import dedup_substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=35):
    words = [WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        left = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return out


def fixture(seed=3):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(900)
    passage = [word() for _ in range(60)]
    short = [word() for _ in range(34)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c"), (4, "x " * 300), (5, "p q " * 90 + "end")]
    for i in range(10, 60):
        body = [word() for _ in range(rng.randrange(20, 160))]
        at = rng.randrange(len(body))
        insert = passage if i % 3 == 0 else short if i % 3 == 1 else passage[5:rng.randrange(30, 60)]
        rows.append((i, " ".join(body[:at] + insert + body[at:])))
    rows += [rows[20], (10, rows[21][1]), (None, rows[22][1]), (77, "\n ".join(WORDS.findall(rows[23][1])))]
    near = rows[24][1].split()
    near[len(near) // 2] = "changed"
    return rows + [(78, " ".join(near))]


@pytest.mark.parametrize("limit", [2048, 3])
def test_matches_brute_force(spark, limit):
    rows = fixture()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int").repartition(3)
    got = dedup_substrings(df, group_limit=limit, digest=True)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


def test_texts_are_cut_and_columns_kept(spark):
    rows = fixture(4)
    df = spark.createDataFrame([(t, d, "x") for d, t in rows], "text string, doc_id long, spans string")
    out = dedup_substrings(df)
    assert out.columns == df.columns
    got = [(r.doc_id, hashlib.sha256(" ".join(WORDS.findall(r.text or "")).encode()).hexdigest()) for r in out.collect()]
    assert sorted(got, key=str) == sorted(((d, h) for d, _, _, h in brute(rows)), key=str)
    assert dict((r.doc_id, r.text) for r in out.filter("doc_id < 4").collect()) == {1: None, 2: "", 3: " \t\n"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_substrings(df, digest=True).collect() == [] and dedup_substrings(df).collect() == []
