import re
from collections import Counter

from conftest import SF_SMALL

from kpool.llm import quality as Q

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORDS.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    under = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(w) < 50 or 100 * len(under) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(under), failed)


def test_base_counts_match_brute_force(spark):
    texts = [None, "", " \x0b\n ", "a", "a b", "a b c", "a a a a", "x y z x y z", "a b a b a b", "l1\nl1\n\nl2 é|ß\r\n l1\nl1",
             " ".join(f"w{i % 70}" for i in range(500)), "q " * 4000, "  nbsp is a word", "# * $ % & | < > ##",
             "a\x1cb \x85 c", "abc  \x85", "x \u2028", " y\n\u2029\n", "\x85 z \r\n", " ".join(f"v{i}" for i in range(60))]
    df = spark.createDataFrame([(i if i % 4 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = [tuple(r[:7]) for r in Q.judge(df).collect()]
    want = [((i if i % 4 else None), *brute(t)) for i, t in enumerate(texts)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_base_counts_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    for r in Q.judge(docs).collect():
        assert tuple(r[1:7]) == want[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_em_finds_accuracies():
    import random

    rng, accuracy, rows = random.Random(1), (0.95, 0.9, 0.85, 0.6), Counter()
    for _ in range(20000):
        good = rng.random() < 0.7
        rows[tuple(0 if rng.random() < 0.2 else (1 if (rng.random() < a) == good else -1) for a in accuracy)] += 1
    prior, given = Q.fit_label_model(sorted(rows.items()))
    assert abs(prior - 0.7) < 0.03
    for j, a in enumerate(accuracy):
        assert abs(given[j][1][0] / (given[j][1][0] + given[j][-1][0]) - a) < 0.03


def test_filter_keeps_clean_rows_and_columns(spark):
    clean = " ".join(f"word{i % 90}x{i}" for i in range(300))
    rows = [(1, clean, 0), (None, clean, 1), (2, "a b c " * 100, 2), (3, None, 3), (1, clean, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    out = Q.keep_good(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[1], rows[4]], key=str)
    assert Q.keep_good(df.filter("doc_id > 9")).collect() == [] and Q.judge(df.filter("doc_id > 9")).collect() == []


def test_no_python_in_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = Q.measures(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
