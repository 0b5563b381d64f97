from conftest import SF_SMALL
from kpool.operators.audit import inclusion_audit


def test_inclusion_is_uniform(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")  # 200 rows
    k, seeds = 20, 300
    got = [r.times for r in inclusion_audit(part, k, ["p_partkey"], seeds).collect()]
    assert len(got) == 200 and sum(got) == k * seeds
    expected = seeds * k / 200
    chi2 = sum((t - expected) ** 2 / expected for t in got)
    # 199 degrees of freedom: mean 199, sd ~20; 300 is far in the tail
    assert chi2 < 300


def test_inclusion_audit_fallback_is_exact(spark, monkeypatch):
    import kpool.operators.audit as audit

    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    want = sorted(tuple(r) for r in audit.inclusion_audit(part, 10, ["p_partkey"], 30).collect())
    monkeypatch.setattr(audit, "prune_margin", lambda k: 0.5)  # far too few candidates
    got = sorted(tuple(r) for r in audit.inclusion_audit(part, 10, ["p_partkey"], 30).collect())
    assert got == want


def test_pairs_are_sampled_uniformly(spark):
    # second-order check: each pair of N=8 rows is in a k=3 sample with
    # probability k(k-1) / (N(N-1)) = 6/56
    from collections import Counter
    from itertools import combinations

    from kpool.operators.audit import inclusion_top

    rows = spark.range(1, 9).withColumnRenamed("id", "x")
    seeds = 3000
    top = inclusion_top(rows, 3, ["x"], seeds, 8, margin=float("inf")).select("_seed", "x").collect()
    per_seed = {}
    for r in top:
        per_seed.setdefault(r._seed, []).append(r.x)
    assert len(per_seed) == seeds and all(len(v) == 3 for v in per_seed.values())
    pairs = Counter(p for v in per_seed.values() for p in combinations(sorted(v), 2))
    p = 6 / 56
    sd = (p * (1 - p) / seeds) ** 0.5
    assert len(pairs) == 28
    assert all(abs(c / seeds - p) < 4.5 * sd for c in pairs.values())
