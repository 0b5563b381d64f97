"""The pipeline against brute force, stage by stage and as a whole."""

import hashlib
import re
from collections import Counter, defaultdict

from conftest import SF_SMALL

import corpus_pipeline as C
from kpool.llm import quality as Q
from kpool.llm._tree import MAX_EPOCHS, SEED, WEIGHTS
from kpool.llm.mixing import NONE
from kpool.llm.queries import word_tokenizer
from tests.llm.test_mixing import brute_budgets
from tests.llm.test_quality import brute as base_counts
from tests.llm.test_simhash import brute_components, brute_fingerprint

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def quality(rows):
    """Votes and EM by hand, one document at a time."""
    votes = []
    for r in rows:
        t = r["text"] or ""
        n, chars, symbols, dup, repeats, failed = base_counts(t)
        w, lines = WORDS.findall(t), [x for x in t.split("\n") if WORDS.search(x)]
        share = lambda a, b: a / b if b else 0.0
        of = {"n_words": n, "mean_word": share(chars, n), "symbol_share": share(symbols, chars),
              "symbols_a_word": share(symbols, n), "bare_share": share(sum(not any(c.isalpha() for c in x) for x in w), n), "line_share": share(dup, len(lines)),
              "window_share": share(repeats, n), "variety": share(len(set(w)), n), "letter_share": share(sum(c.isalpha() for c in t), chars)}
        v = []
        for _, key, low, high, a, b in Q.RULES:
            x = of[key]
            v.append(-1 if (low is not None and x < low) or (high is not None and x > high) else 1 if a <= x <= b else 0)
        votes.append((tuple(v), failed))
    prior, given = Q.fit_label_model(sorted(Counter(v for v, _ in votes).items()))
    out = []
    for r, (v, failed) in zip(rows, votes):
        good, bad = prior, 1 - prior
        for j, x in enumerate(v):
            good, bad = good * given[j][x][0], bad * given[j][x][1]
        if not failed and good >= bad:
            out.append(r)
    return out


def dedup(rows):
    comp = brute_components([r["doc_id"] for r in rows], [brute_fingerprint(r["text"]) for r in rows])
    return [r for r, c in zip(rows, comp) if r["doc_id"] == c]


def substrings(rows):
    found = [list(WORDS.finditer(r["text"])) for r in rows]
    seen = Counter(tuple(m[0] for m in f[i:i + 35]) for f in found for i in range(len(f) - 34))
    out = []
    for r, f in zip(rows, found):
        gone = [False] * len(f)
        for i in range(len(f) - 34):
            if seen[tuple(m[0] for m in f[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        t = r["text"]
        if any(gone):
            ends = [m.start() for m in f[1:]] + [len(t)]
            t = t[:f[0].start()] + "".join(t[m.start():e] for m, e, g in zip(f, ends, gone) if not g)
        out.append({**r, "text": t, "n_chars": len(t)})
    return out


def mixed(rows):
    def leaf(r):
        m = re.fullmatch(r"src([0-9]{1,6})", r["source"] or "")
        domain = "other" if not m else "web" if int(m[1]) < 8 else "reference" if int(m[1]) < 14 else "forum"
        return domain, r["lang"] or NONE, r["source"] or NONE

    tokens, by = Counter(), defaultdict(list)
    for r in rows:
        tokens[leaf(r)] += len(WORDS.findall(r["text"]))
        by[leaf(r)].append(r)
    leaves = {k: v for k, v in tokens.items() if v}
    budget = brute_budgets(leaves, [WEIGHTS[k] for k in ("domain", "lang", "source")], sum(leaves.values()), MAX_EPOCHS)
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    out = []
    for k, t in leaves.items():
        b = int(budget[k] + 1e-6)
        run = 0
        for r in sorted(by[k], key=lambda r: (md5(f"{SEED}:{b // t}:{r['doc_id']}"), md5(r["text"]))):
            run += len(WORDS.findall(r["text"]))
            out += [r] * (b // t + (run <= b % t))
    return out


def key(r):
    return tuple(sorted((k, str(v)) for k, v in r.items()))


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    rows = [r.asDict() for r in docs.collect()]
    for (name, stage), brute in zip(C.STAGES, (quality, dedup, substrings, mixed)):
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        rows = brute(rows)
        assert Counter(key(r.asDict()) for r in out.collect()) == Counter(map(key, rows)), name
        assert rows
        docs = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in rows], docs.schema).repartition(3)

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_tokenizer())
    want = Counter()
    for r in rows:
        n = len(t.encode(r["text"], add_special_tokens=False).ids) + 1
        want.update((r["doc_id"], p, min(4096, n - a)) for p, a in enumerate(range(0, n, 4096)))
    got = C.run(spark, SF_SMALL)
    pieces = got.collect()
    assert Counter((r.doc_id, r.piece, r.length) for r in pieces) == want
    size = Counter()
    for r in pieces:
        size[r.sequence_id] += r.length
    assert max(size.values()) <= 4096 and len(size) <= sum(size.values()) // 4096 + 2


def test_empty_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp int, copies int, kept string"
    good = " ".join(f"word{i}" for i in range(120))
    odd = spark.createDataFrame([(None, good, None, None, None, 1, 1, "x"), (1, None, "en", "src1", 0, 1, 1, "x"), (1, good + " tail", "en", "src1", 5, 1, 1, "x"),
                                 (1, good + " tail", "en", "src1", 5, 1, 1, "x")], schema)
    for table in (odd, odd.filter("doc_id > 5")):
        docs = table
        for name, stage in C.STAGES:
            docs = stage(spark, docs, SF_SMALL)
            assert name == "best_fit_packing" or sorted(docs.columns) == sorted(table.columns)
            n = docs.count()
        assert (n > 0) == (table is odd)
