import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kpool.llm import langid as L
from kpool.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"


def slow_trigrams(data):
    s = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in b" " + data + b" ")
    s = re.sub(b" +", b" ", s)
    return [((s[i] << 16 | s[i + 1] << 8 | s[i + 2]) * 2654435761 % 2**32) >> 17 for i in range(len(s) - 2)]


def test_trigrams_and_counts(spark):
    texts = ["", "a", "Ab  c!", "é ß", "x" * 500, "The end. 12 the"]
    for t in texts:
        assert L.trigrams(t.encode()).tolist() == slow_trigrams(t.encode())
    df = spark.createDataFrame([(t, "xy"[i % 2], 1) for i, t in enumerate(texts)] + [(None, "x", 1), ("q", None, 1)], "text string, lang string, n int").repartition(3)
    want = Counter((("xy"[i % 2]), c) for i, t in enumerate(texts) for c in slow_trigrams(t.encode()))
    want.update(("x", c) for c in slow_trigrams(b""))
    assert {(r.lang, r.cell): r.n for r in L.trigram_counts(df).collect()} == want


def test_text_model_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    model = L.fit_text_model(docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    test = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.n_chars > 100]
    hit = [model.langs[int(np.argmax(model.likelihoods(r.text.encode())))] == r.lang for r in test]
    assert sum(hit) / len(hit) > 0.97


def test_pages(spark):
    got = QUERIES["op3_language_id"](spark, MID).collect()
    truth = {r.page_id: re.search(r"/(en|de|fr|es)/", r.url)[1] for r in spark.read.parquet(f"{MID}/pages.parquet").collect()}
    assert sorted(r.page_id for r in got) == sorted(truth)
    assert sum(r.lang == truth[r.page_id] for r in got) / len(got) > 0.97
    assert all(0.25 <= r.p <= 1 for r in got)


def test_visible_text():
    seen = lambda page: L.visible_text(page).split()
    for name in ("nav-bar", "template-x", "script-list", "noscripts", "navigation", "style:a"):
        assert seen(f"<body><{name}></{name}><p>whole text</p>") == ["whole", "text"]
        assert seen(f"<body><{name} class=a>more</{name}><p>whole text</p>") == ["more", "whole", "text"]
    for name in ("nav", "noscript", "NAV class='a'"):  # never closed
        assert seen(f"<body><{name}><p>whole text</p></body>") == ["whole", "text"]
        assert seen(f"a<{name}>b " * 3 + "c") == list("abababc")
    assert seen("a<nav>b<p>c<nav>d</nav>e") == ["a", "b", "c", "e"]  # the inner one is closed
    assert seen("a<nav>b<nav>c</nav>d</nav>e</nav>f") == ["a", "e", "f"]
    for name in ("nav", "noscript", "script", "style", "template"):
        assert seen(f"a<{name} x=1>b<i>c</{name.upper()}\n>d<{name}>e</{name} y>f") == ["a", "d", "f"]
    for name in ("script", "style", "template"):
        assert seen(f"a<nav>b</nav><{name}>c<p>d") == ["a"]
    assert seen("a<script>'<nav>'</script>b<!-- <nav> -->c<style/>d</style>e<!-- f") == ["a", "b", "c", "e"]
    many = "<nav><noscript>x " * 50_000  # in one pass
    assert len(seen(many)) == 50_000


def brute(pages, model, strength=10.0, doubt=1.0):
    """The posterior by hand, page by page."""
    n, rows = len(model.langs), []
    for i, url, html in pages:
        host = re.match(r"[^/?#]*", url.split("://", 1)[1])[0].lower() if url and "://" in url else ""
        parts = host.split(".")
        text = model.likelihoods(L.visible_text(html or "").encode())
        p = np.exp(text) / np.exp(text).sum()
        rows.append((i, (parts[-1], ".".join(parts[-2:]), host), L.declared_language(html or ""), text, p))
    total = lambda f: sum((r[4] for r in rows if f(r)), np.zeros(n))
    base = (total(lambda r: True) + 1) / (total(lambda r: True).sum() + n)
    out = {}
    for i, path, said, text, _ in rows:
        q = base
        for level in range(3):
            c = total(lambda r: r[1][:level + 1] == path[:level + 1])
            q = (c + strength * q) / (c.sum() + strength)
        kinds = len({r[2] for r in rows})
        d = (total(lambda r: r[2] == said) + doubt) / (total(lambda r: True) + doubt * (kinds + 1))
        post = q * d * np.exp(text)
        out[i] = post / post.sum()
    return out


def test_fusion_matches_brute_force(spark):
    texts = [("the and of with that this from", "en"), ("der die und das nicht ein", "de"), ("le la les des une est", "fr")] * 3
    docs = spark.createDataFrame(texts, "text string, lang string")
    model = L.fit_text_model(docs)
    page = lambda lang, body: f'<html lang="{lang}"><script>the the the</script><body>{body}</body></html>'
    pages = [(i, f"http://w{i % 3}.a.de/x{i}", page("de", "der und das")) for i in range(12)]
    pages += [(20, "http://w1.a.de/", page("en", "und")), (21, "http://b.fr/", "<p>12</p>"), (22, None, None), (23, "no scheme", ""), (24, "http://b.fr", page("fr", "les une")),
              (25, "HTTP://W1.A.DE/q", "<html><p>the and of &amp; with"), (26, "http://c.fr/", page("xx", "<!-- der die"))]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, lang string").repartition(3)
    got = {r.page_id: r for r in L.identify_language(df, docs).collect()}
    want = brute(pages, model)
    assert got.keys() == want.keys()
    for i, post in want.items():
        assert abs(got[i].p - post.max()) < 1e-6 and got[i].lang == model.langs[int(np.argmax(post))], i
    assert got[20].lang == "de" and got[20].declared == "en"  # the host outweighs a declaration with little text


def test_edge_tables(spark):
    docs = spark.createDataFrame([("a b", None), (None, None)], "text string, lang string")
    pages = spark.createDataFrame([(None, "http://a.b/", "<p>x"), (None, "http://a.b/", "<p>x")], "page_id long, url string, html string")
    assert [(r.lang, r.p) for r in L.identify_language(pages, docs).collect()] == [(None, None)] * 2
    good = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert [r.lang for r in L.identify_language(pages, good).collect()] == ["en"] * 2
    assert L.identify_language(pages.filter("page_id > 1"), good).collect() == []
