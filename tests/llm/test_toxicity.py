import random
import zlib

import pytest

from kpool.llm import toxicity as X
from kpool.llm.queries import QUERIES

MID = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_automaton_meets_all_terms_within_reach(edits):
    rng = random.Random(edits)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 8)))
    lexicon = X.Lexicon({word(): 1.0 for _ in range(60)})
    for _ in range(300):
        w = word()
        assert lexicon.within(w, edits) == sorted((distance(w, t), t) for t in lexicon.terms if distance(w, t) <= edits)


def test_look_up_skips_no_near_word():
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    lexicon = X.Lexicon({word(rng.randrange(3, 13)): 1.0 for _ in range(40)})
    near = 0
    for _ in range(4000):
        w = list(rng.choice(list(lexicon.terms)))
        for _ in range(rng.randrange(0, 4)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randrange(2)] = rng.choice(["", *"abcd"])
        w = "".join(w)
        want = sorted((distance(w, t), t) for t in lexicon.terms if distance(w, t) <= X.edits_allowed(len(t)))
        assert lexicon.near(w) == (want[0] if want else None)
        near += bool(want)
    assert near > 1000


def test_misspelling_quotation_and_address():
    lexicon = X.Lexicon({"worthless": 4.0, "clown": 4.0}, {"crown": -2.0})
    at = dict(zip(X.FEATURES, range(9)))
    f = lexicon.features
    assert f(None) == f("") == f("nothing here, the crown") == [0.0] * len(X.FEATURES)
    assert f("that Clown!")[at["plain"]] > 0 and f("that cl0wn!")[at["near"]] > 0 and f("wrthles")[at["near"]] > 0
    assert f('they said "clown" twice')[at["plain"]] == 0 < f('they said "clown" twice')[at["quoted"]]
    assert f("the word clown is rude")[at["quoted"]] > 0
    assert f("you clown")[at["addressed"]] > 0 == f("a clown")[at["addressed"]]


def test_terms_inside_tokens():
    lexicon = X.Lexicon({"worthless": 4.0, "clown": 4.0, "idiot": 4.0}, {"crown": -2.0})
    at = dict(zip(X.FEATURES, range(9)))
    f = lexicon.features
    for text, spaced in (("that idiot,moron", "that idiot, moron"), ("stupid/clown here", "stupid clown here"), ("<b>idiot</b>", "b idiot b"),
                         ("idiot...clown,worthless", "idiot clown worthless"), ("you/idiot", "you idiot"), ("9clown_x", "clown x"), ("the/wrthless/one", "the wrthless one"),
                         ('they said,"clown"twice', 'they said, "clown" twice'), ('a("idiot,clown")', 'a "idiot clown"'), ("x" * 60 + "/idiot/" + "y" * 60, "x idiot y")):
        for _ in range(2):  # a token met before gives the same
            assert f(text) == f(spaced) != f("a"), text
    assert f('it is"clown,idiot"then')[at["plain"]] == 0 < f('it is"clown,idiot"then')[at["quoted"]]
    assert f("that cl0wn!")[at["near"]] > 0 == f("that cl0wn!")[at["plain"]]
    assert f("the/crown,of 1.5e3 a_b <br/> crow-n") == f("") and not any(len(t) > X.LONG for t in lexicon.seen)


def test_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, MID).collect()}
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    lang = {r.doc_id: r.lang for r in docs}
    assert got.keys() == lang.keys()
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    test = [(labels[d], got[d].predicted) for d in labels if got[d].held_out]
    assert sum(a == b for a, b in test) / len(test) > 0.97
    bad = [p for d, p in ((d, got[d].predicted) for d in labels if got[d].held_out and labels[d])]
    assert sum(bad) / len(bad) > 0.9
    clean = [got[d].predicted for d in labels if got[d].held_out and not labels[d]]
    assert sum(clean) / len(clean) < 0.01


def test_edge_tables(spark):
    docs = spark.createDataFrame([(None, "you clown"), (1, None), (2, ""), (2, ""), (3, "x " * 5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    rows = X.score_toxicity(docs, labels).collect()
    assert len(rows) == 5 and all(r.predicted == 0 and r.score >= 0 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert X.score_toxicity(docs.filter("doc_id > 9"), labels).collect() == []
    assert len(X.score_toxicity(docs, labels.filter("doc_id > 9")).collect()) == 5
