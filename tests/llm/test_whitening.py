"""Whitening against numpy's dense eigensolver and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpool.llm.queries import QUERIES, table
from kpool.llm.whitening import Centre, Slices, above, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def fixed(v):
    return [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]


def brute(vectors, most=8):
    x = np.array([fixed(v) for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    y = np.array([[float(a * n - b) / n for a, b in zip(row, s)] for row in x])
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    return dev, y, v, e, q


def check(rows, ids, vectors, most=8):
    dev, y, v, e, q = brute(vectors, most)
    got = {}
    for r in rows:
        got.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r)
    assert sorted(got) == list(range(1, len(e) + 1))
    where = {i: j for j, i in enumerate(ids)}
    w = np.zeros((len(ids), len(e)))
    for c, by_id in got.items():
        for i, found in by_id.items():
            r = found[0]
            assert (r["n"], r["deviation"], r["deviation_text"]) == (len(ids), dev[where[i]], str(dev[where[i]]))
            assert r["explained"] == pytest.approx(e[c - 1] / np.trace(v), rel=1e-9)
            assert r["identity_error"] < 1e-9
            w[where[i], c - 1] = r["whitened"]
    want = y @ q / np.sqrt(e)
    for c in range(len(e)):
        sign = np.sign(w[:, c] @ want[:, c])
        assert np.allclose(w[:, c] * sign, want[:, c], atol=1e-6)


def test_counts_follow_the_spectrum():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 7, 20):
        for _ in range(20):
            a = rng.standard_normal((size, size)) * 10.0 ** rng.integers(-3, 4)
            a = a + a.T
            if rng.random() < 0.3:
                a[np.diag_indices(size)] = 0  # needs 2 x 2 pivots
            e = np.linalg.eigvalsh(a)
            for s in rng.uniform(e[0] - 1, e[-1] + 1, 8):
                if np.abs(e - s).min() > 1e-9 * max(np.abs(e).max(), 1):
                    assert above(a, s) == (e > s).sum()
    assert above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("spectrum", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1, 0.5], [5, 5, 5, 2, 2, 1, 1, 1, 1, 1], [1, 1, 1, 1, 1, 1, 1, 1, 1, 1],
    [1e12, 1e6, 1, 1 - 1e-9, 1 - 2e-9, 0.1, 0, 0, 0, 0], [3, 3 - 1e-13, 3 - 2e-13, 1, 0, 0, 0, 0, 0, 0]])
def test_slices_find_clusters_and_gaps(spectrum):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((10, 10)))
    a = q @ np.diag(spectrum) @ q.T
    values, vectors = Slices(a).leading(8)
    scale = max(spectrum)
    # components are left out only where they are zero to rounding
    assert len(values) >= sum(v > 100 * 10 * 2.3e-16 * scale * 4 for v in spectrum[:8])
    assert np.allclose(values, sorted(spectrum, reverse=True)[:len(values)], rtol=1e-12, atol=1e-14 * scale * 10)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-13 * scale


def test_centre_is_exact_for_large_counts():
    rng = np.random.default_rng(2)
    x = rng.integers(90_000, 110_000, (5, 6))
    n = 3_000_000_007
    s = [int(v) for v in rng.integers(99_000 * n, 101_000 * n, 6)]
    want = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s)) for row in x]
    assert Centre(n, s).deviations(x) == want and max(want) > 1 << 63
    big = x * (1 << 40)
    want = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s)) for row in big]
    assert Centre(n, s).deviations(big) == want


def test_equals_dense_solver(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(1, 3, 12)).astype(np.float32).tolist()
    ids = list(range(300))
    rows = [(i, v, 0) for i, v in zip(ids, vectors)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(whiten(df).collect(), ids, vectors)
    few = [v[:3] for v in vectors]
    check(whiten(spark.createDataFrame([(i, v, 0) for i, v in zip(ids, few)], SCHEMA)).collect(), ids, few)


def test_defined_cases(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((40, 4)).astype(np.float32).tolist()
    rows = [(i, v, 0) for i, v in enumerate(good)]
    odd = [(100, None, 0), (101, [1.0, None, 2.0, 3.0], 0), (102, [1.0, float("nan"), 0.0, 0.0], 1), (103, [float("inf")] * 4, 0),
           (104, [], 0), (105, [1.0, 2.0], 0), (106, [1e38, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumn("component", F.lit("mine")).withColumn("n", F.lit(None).cast("int"))
    check(whiten(df).collect(), list(range(40)), good, 4)
    # repeated rows, null ids
    twice = spark.createDataFrame(rows + rows[:3] + [(None, good[0], 0)], SCHEMA)
    out = whiten(twice)
    assert out.count() == 44 * 4 and out.filter("vec_id IS NULL").count() == 4 and out.first()["n"] == 44
    # nothing to whiten
    for data in ([], odd[:5], rows[:1], [(i, good[0], 0) for i in range(5)]):
        out = whiten(spark.createDataFrame(data, SCHEMA))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "deviation_text", "whitened", "explained", "identity_error"]
    with pytest.raises(ValueError):
        whiten(df, keep=["vec_id", "N"])


def test_query_covers_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = table(spark, sf_dir, "embeddings").collect()
    check(QUERIES["op11_embedding_whitening"](spark, sf_dir).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])
