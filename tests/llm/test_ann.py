import math

import numpy as np
import pytest

from kpool.llm import ann as A
from kpool.llm.queries import QUERIES


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, len(v)), []).append(v)
    out = {}
    for length in {d for _, d in ok}:
        ids, x = zip(*((i, v) for (i, d), some in ok.items() if d == length for v in some))
        ids, x = np.array(ids), np.array(x, float)
        for q in sorted({i for i in ids.tolist() if i % every == 0}):
            best = {}
            for own in x[ids == q]:
                with np.errstate(over="ignore"):
                    scores = x @ own
                for i, s in zip(ids.tolist(), scores.tolist()):
                    if i != q:
                        best[i] = max(best.get(i, -math.inf), s)
            out[q] = sorted((*out.get(q, []), *((-s, i) for i, s in best.items())))[:k]
    return out


def recall(rows, want, k):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for q, best in want.items():
        mine = sorted(got.get(q, []), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert all((a.score, -a.vec_id) > (b.score, -b.vec_id) for a, b in zip(mine, mine[1:]))
        hit += len({r.vec_id for r in mine} & {i for _, i in best})
        total += len(best)
    assert got.keys() == want.keys() - {q for q, b in want.items() if not b}
    return hit / max(1, total)


def test_query_recall(spark):
    d = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, 20, 20)
    got = QUERIES["op7_nearest_neighbours"](spark, d).collect()
    assert recall(got, want, 20) >= 0.95
    at = dict(rows)
    for r in got[:500]:
        assert abs(r.score - float(np.dot(np.array(at[r.query_id], float), np.array(at[r.vec_id], float)))) < 1e-12


@pytest.mark.parametrize("lengths", [False, True])
def test_inner_product_many_shards_and_copies(spark, lengths):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 12)) * (rng.uniform(0.2, 3, size=(1500, 1)) if lengths else 1)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    rows += [(2000 + i, rows[7][1]) for i in range(300)]  # one vector of many rows
    df = spark.createDataFrame([(v, i, 0) for i, v in rows], "embedding array<double>, vec_id long, rank int").repartition(5)
    got = A.nearest(df, k=10, every=20, shard_size=400).collect()
    want = brute(rows, 10, 20)
    assert recall(got, want, 10) >= 0.95
    copies = [r.vec_id for r in sorted((r for r in got if r.query_id == 2020), key=lambda r: r["rank"])]
    if not lengths:
        assert copies == [i for _, i in want[2020]]


@pytest.mark.parametrize("length", [1e4, 1e200])
def test_one_very_long_vector(spark, length):
    x = np.random.default_rng(2).normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1234] *= length
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert recall(A.nearest(df, k=10, every=20).collect(), brute(rows, 10, 20), 10) >= 0.95


def test_lengths_of_all_sizes(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 6)) * 10.0 ** rng.uniform(-150, 150, size=(600, 1))
    rows = [*enumerate(x.tolist()), (1000, [1e200, 1e200, 0.0]), (1001, [1e200, -1e200, 0.0]), (1003, [-1e200, 1e-300, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = A.nearest(df, k=10, every=20, shard_size=64).collect()
    assert recall([r for r in got if r.query_id < 1000], brute(rows[:600], 10, 20), 10) >= 0.95
    assert [(r.vec_id, r.score) for r in got if r.query_id == 1000] == [(1001, 0.0), (1003, -math.inf)]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, [1.0, None]),
            (8, [1.0, 0.0]), (8, [1.0, 0.0]), (20, [1.0, 0.0, 0.0]), (40, [2.0, 0.0]), (40, [3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, A.nearest(df, k=3, every=20).collect()))
    # id 40 has two vectors: each is indexed and asks, the best score counts
    assert got == [(0, 1, 40, 3.0), (0, 2, 8, 1.0), (0, 3, 1, 0.5), (40, 1, 0, 3.0), (40, 2, 8, 3.0), (40, 3, 1, 1.5)]
    assert A.nearest(df.filter("vec_id > 99")).collect() == []


@pytest.mark.parametrize("components,spread", [(64, 0.0), (64, 0.5), (128, 0.0)])
def test_recall_when_norms_differ(spark, components, spread):
    """Gaussian vectors, and log-normal norms on top, at the query's k and more than one shard."""
    rng = np.random.default_rng(components)
    x = rng.normal(size=(8192, components)) * np.exp(rng.normal(scale=spread, size=(8192, 1)))
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    want = brute(rows, 20, 20)
    assert recall(A.nearest(df).collect(), want, 20) >= 0.9
    if spread:
        assert recall(A.nearest(df, shard_size=1500).collect(), want, 20) >= 0.9


def test_short_shards_are_skipped(spark):
    """Vectors that cannot beat the k-th score are not visited, and nothing is lost."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:1000] *= 50
    x[:, 0] = np.abs(x[:, 0]) + np.linalg.norm(x, axis=1) * 0.3
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    visited = []
    kept = A.search_index

    def spy(index, visits, *args, **named):
        visited.append(visits.count())
        return kept(index, visits, *args, **named)

    A.search_index = spy
    try:
        got = A.nearest(df, k=10, shard_size=500).collect()
    finally:
        A.search_index = kept
    assert recall(got, brute(rows, 10, 20), 10) >= 0.95
    assert visited[0] > 0 and visited[1] < 0.5 * visited[0]


def test_ids_with_several_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i % 300, v) for i, v in enumerate(rng.normal(size=(900, 8)).tolist())] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = A.nearest(df, k=10, shard_size=200).collect()
    assert recall(got, brute(rows, 10, 20), 10) >= 0.95
    assert len({(r.query_id, r.vec_id) for r in got}) == len(got)
