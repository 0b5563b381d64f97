"""Edge cases: k = 1, n = k, null values and keys, complete + incomplete sides."""

from pyspark.sql import functions as F

from helpers import md5_hex
from kpool.operators.merge import merge_summaries, merge_weighted
from kpool.operators.sample import sample_k
from kpool.operators.summary import build_summary, explode_summary


def _rows(spark):
    data = [(i, "a" if i <= 6 else ("b" if i <= 9 else None), None if i % 4 == 0 else f"v{i % 2}")
            for i in range(1, 13)]
    return spark.createDataFrame(data, "id bigint, key string, value string")


def test_k_one_is_the_smallest_priority(spark):
    df = _rows(spark)
    got = sample_k(df, 1, ["id"], seed=4).first().id
    assert got == min(range(1, 13), key=lambda i: md5_hex(4, i))


def test_n_equal_k_keeps_everything_and_is_complete(spark):
    df = _rows(spark).filter(F.col("key") == "b")  # 3 rows
    s = build_summary(df, ["key"], 3, "value", ["id"], seed=1).first()
    assert s.n == 3 and s.k == 3 and len(s["items"]) == 3
    merged = merge_summaries(build_summary(df, ["key"], 3, "value", ["id"], seed=1), [], 3).first()
    assert merged.n == 3 and merged.k == 3  # complete side does not cap m


def test_null_keys_and_values_survive_build_and_merge(spark):
    df = _rows(spark)
    s = build_summary(df, ["key"], 2, "value", ["id"], seed=2)
    by = {r.key: r for r in s.collect()}
    assert set(by) == {"a", "b", None}
    assert by[None].n == 3 and len(by[None]["items"]) == 2
    whole = build_summary(df.filter(F.col("key").isNull()), ["key"], 3, "value", ["id"], seed=2)
    vals = sorted((r.value is None, r.value) for r in explode_summary(whole).collect())
    assert vals == [(False, "v0"), (False, "v1"), (True, None)]  # id 12 has a null value
    m = merge_summaries(s.unionByName(s.withColumn("n", F.col("n"))), ["key"], 2)
    assert {r.key for r in m.collect()} == {"a", "b", None}


def test_complete_and_incomplete_sides(spark):
    ids = spark.range(1, 201).withColumnRenamed("id", "x")
    small = build_summary(ids.filter("x <= 5"), [], 10, "x", ["x"], seed=1)     # complete: n=5 <= k
    big = build_summary(ids.filter("x > 5"), [], 10, "x", ["x"], seed=1)        # incomplete: n=195 > k
    m = merge_summaries(small.unionByName(big), [], 30).first()
    assert m.k == 10 and len(m["items"]) == 10 and m.n == 200                  # capped by the big side
    w = merge_weighted(small, big, [], 30, seed=5).first()
    assert w.k == 10 and w.c1 + w.c2 == 10 and w.c1 <= 5


def test_weighted_merge_small_total_caps_at_n(spark):
    ids = spark.range(1, 4).withColumnRenamed("id", "x")
    a = build_summary(ids.filter("x = 1"), [], 5, "x", ["x"], seed=1)
    b = build_summary(ids.filter("x > 1"), [], 5, "x", ["x"], seed=1)
    w = merge_weighted(a, b, [], 10, seed=2).first()
    assert w.n == 3 and w.k == 3 and sorted(it.value for it in w["items"]) == [1, 2, 3]
