import hashlib
import random
import re
from collections import defaultdict

from conftest import SF_SMALL
from pyspark.sql import functions as F
from tools.compare import digest

from kpool.llm import mixing as M
from kpool.llm.queries import ORACLE, QUERIES


def fill(children, budget):
    """Shares of {name: (capacity, weight)} by repeated redistribution."""
    given, open_ = dict.fromkeys(children, 0.0), {k for k, (c, w) in children.items() if c and w}
    left = min(float(budget), float(sum(children[k][0] for k in open_)))
    while left > 1e-9 and open_:
        whole = sum(children[k][1] for k in open_)
        full = {k for k in open_ if given[k] + left * children[k][1] / whole >= children[k][0]}
        if not full:
            for k in open_:
                given[k] += left * children[k][1] / whole
            break
        for k in full:
            left -= children[k][0] - given[k]
            given[k] = float(children[k][0])
        open_ -= full
    return given


def brute_budgets(leaves, weights, total, epochs, level=0):
    heads = defaultdict(dict)
    for path, t in leaves.items():
        heads[path[0]][path[1:]] = t
    w = lambda k: weights[level].get(k, weights[level].get("*", 1))
    caps = {k: (usable(v, weights, level + 1) * epochs, w(k)) for k, v in heads.items()}
    got = fill(caps, total)
    out = {}
    for k, v in heads.items():
        if v.keys() == {()}:
            out[(k,)] = got[k]
        else:
            out.update({(k, *p): b for p, b in brute_budgets(v, weights, got[k], epochs, level + 1).items()})
    return out


def usable(leaves, weights, level):
    return sum(t for p, t in leaves.items() if all(weights[level + i].get(x, weights[level + i].get("*", 1)) for i, x in enumerate(p)))


def test_budgets_match_repeated_redistribution(spark):
    rng = random.Random(7)
    for case in range(6):
        leaves = {(a, b, c): rng.randrange(1, 400) for a in "xyz" for b in "pq" for c in "123" if rng.random() < 0.8}
        weights = [{"x": 5, "y": rng.randrange(3)}, {"p": 3, "*": 1}, {"1": rng.randrange(4), "2": 2}]
        total = rng.randrange(1, 3 * sum(leaves.values()))
        df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "a string, b string, c string, tokens long")
        got = {tuple(r[:3]): r.budget for r in M.budgets(df, ["a", "b", "c"], dict(zip("abc", weights)), total, 2).collect()}
        want = brute_budgets(leaves, weights, total, 2)
        for k in leaves:
            assert abs(got.get(k, 0) - want[k]) <= 1, (case, k)


def test_prefix_of_seeded_epochs(spark):
    rng = random.Random(8)
    rows = [(i if i % 9 else None, rng.choice("ab"), " ".join(["w"] * rng.randrange(0, 30)) or None, 5) for i in range(400)] + [(1, None, "q", 5)] * 3
    df = spark.createDataFrame(rows, "doc_id long, copies string, text string, lang int").repartition(3)
    levels, weights = {"copies": F.col("copies")}, {"copies": {"a": 7, "b": 1, "*": 1}}
    got = M.mix(df, levels, weights, total=9000, max_epochs=3, narrow_result=True, copies="n")
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    leaf = defaultdict(list)
    for d, g, t, _ in rows:
        leaf[g or M.NONE].append((d, t))
    total = {g: sum(words(t) for _, t in v) for g, v in leaf.items()}
    shares = fill({g: (3 * t, weights["copies"].get(g, 1)) for g, t in total.items()}, 9000)
    want = []
    for g, v in leaf.items():
        b = int(shares[g] + 1e-6)
        whole, room, run = b // total[g], b % total[g], 0
        md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
        for d, t in sorted(v, key=lambda r: (md5(f"42:{whole}:{'' if r[0] is None else r[0]}"), md5(r[1] or ""))):
            run += words(t)
            n = whole + (run <= room)
            want += [(str(d), g, words(t), n)] if n else []
    assert sorted((str(r.doc_id), r[1], r.tokens, r[3]) for r in got.collect()) == sorted(want)
    whole_rows = M.mix(df, levels, weights, total=9000, max_epochs=3, copies="n")
    assert whole_rows.columns == ["doc_id", "copies", "text", "lang", "n"]
    assert sorted((str(r.doc_id), words(r.text), r["n"]) for r in whole_rows.collect()) == sorted((d, t, n) for d, _, t, n in want)
    assert M.repeat_copies(whole_rows, "n").count() == sum(n for *_, n in want)
    assert M.mix(df.filter("lang > 5"), levels, weights, copies="n").collect() == []


def test_query_matches_oracle(spark, duck):
    name = "op10_mixing"
    df = QUERIES[name](spark, SF_SMALL)
    rows, res = [tuple(r) for r in df.collect()], duck.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(columns) == sorted(df.columns) and len(rows) == len(want) and len(rows) > 0
    assert digest(df.columns, rows) == digest(columns, want)
