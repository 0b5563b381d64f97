import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from kpool.operators.audit import parity
from kpool.operators.merge import merge_sides, merge_summaries, merge_weighted
from kpool.operators.sample import sample_k
from kpool.operators.summary import build_summary, explode_summary, render_summary


def _items(summary_df):
    return [(r.priority, r.value) for r in explode_summary(summary_df).orderBy("priority").collect()]


def test_merge_of_parts_equals_sample_of_whole(spark):
    orders = spark.read.parquet(f"{SF_MID}/orders.parquet").select("o_orderkey")
    parts = [orders.filter(F.pmod("o_orderkey", F.lit(3)) == i) for i in range(3)]
    summ = [build_summary(p, [], 100, "o_orderkey", ["o_orderkey"], seed=9) for p in parts]
    u = summ[0].unionByName(summ[1]).unionByName(summ[2])
    merged = merge_summaries(u, [], 80)
    whole = sample_k(orders, 80, ["o_orderkey"], seed=9).select("priority", F.col("o_orderkey").alias("value"))
    assert _items(merged) == sorted((r.priority, r.value) for r in whole.collect())
    row = merged.first()
    assert row.n == orders.count() and row.k == 80


def test_merge_commutative_and_associative(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a, b, c = [build_summary(ev.filter(F.col("event_type") == t), [], 20, "event_id", ["event_id"], seed=2)
               for t in ("click", "view", "purchase")]
    ab_c = merge_summaries(merge_summaries(a.unionByName(b), [], 15).unionByName(c), [], 10)
    a_bc = merge_summaries(a.unionByName(merge_summaries(b.unionByName(c), [], 15)), [], 10)
    ba = merge_summaries(b.unionByName(a), [], 10)
    ab = merge_summaries(a.unionByName(b), [], 10)
    assert _items(ab_c) == _items(a_bc)
    assert _items(ab) == _items(ba)


def test_rule_r_caps_and_errors(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    s1 = build_summary(orders.filter(parity("o_orderkey") == "odd"), [], 100, "o_orderkey", ["o_orderkey"], seed=1)
    s2 = build_summary(orders.filter(parity("o_orderkey") == "even"), [], 300, "o_orderkey", ["o_orderkey"], seed=1)
    capped = merge_summaries(s1.unionByName(s2), [], 200)
    row = capped.first()
    assert row.k == 100 and len(row.items) == 100
    with pytest.raises(Exception):
        merge_summaries(s1.unionByName(s2), [], 200, short="error").collect()


def test_complete_sides_merge_fully(spark):
    sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")  # 10 rows: n < k
    s = build_summary(sup, [], 50, "s_suppkey", ["s_suppkey"], seed=1)
    m = merge_summaries(s.unionByName(s.limit(0)), [], 30).first()
    assert m.n == 10 and len(m.items) == 10


def test_merge_has_no_duplicates(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    s = build_summary(ev, ["event_type"], 30, "event_id", ["event_id"], seed=4)
    m = merge_summaries(s, [], 100)  # Rule R: incomplete inputs of k=30 cap m at 30
    vals = [v for _, v in _items(m)]
    assert len(vals) == len(set(vals)) == 30
    assert m.first().k == 30


def test_weighted_merge_share_follows_sizes(spark):
    # n1 = 1000 rows vs n2 = 250 rows: side 1 should supply ~80% of the merged items
    ids = spark.range(1, 1251).withColumnRenamed("id", "x")
    big = build_summary(ids.filter("x <= 1000"), [], 50, "x", ["x"], seed=1)
    small = build_summary(ids.filter("x > 1000"), [], 50, "x", ["x"], seed=1)
    total_left = 0
    trials = 60
    for seed in range(trials):
        r = merge_weighted(big, small, [], 20, seed=seed).first()
        total_left += r.c1
        assert r.c1 + r.c2 == 20 and r.n == 1250
    share = total_left / (20 * trials)
    assert abs(share - 0.8) < 4 * math.sqrt(0.8 * 0.2 / (20 * trials)) + 0.02


def test_weighted_merge_missing_side(spark):
    ids = spark.range(1, 101).withColumnRenamed("id", "x").withColumn("g", F.lit(1))
    s = build_summary(ids, ["g"], 10, "x", ["x"], seed=1)
    empty = s.filter(F.lit(False))
    r = merge_weighted(s, empty, ["g"], 5, seed=3).first()
    assert r.c1 == 5 and r.c2 == 0 and r.n == 100 and len(r.items) == 5


def test_render_format_and_empty(spark):
    df = spark.createDataFrame([(3, 5, [("p1", "a"), ("p2", "b")]), (0, 5, [])],
                               "n bigint, k bigint, items array<struct<priority:string,value:string>>")
    got = [r.t for r in df.select(render_summary(F.col("n"), F.col("k"), F.col("items")).alias("t")).collect()]
    assert got[0] == "SamplePool @  stream size: 3  sample size: 5  sample data size: 2  sample data: [a, b]"
    assert got[1].endswith("sample data: []")


# --- any number of sides ----------------------------------------------------

def _sides(spark, sizes, k, groups=1, null_side=False):
    """Summaries of one key a group, sides of the given sizes, items in slot order."""
    rows = []
    for g in range(groups):
        for s, n in enumerate(sizes):
            items = [(f"slot-{i + 1:020d}", s * 1000 + i) for i in range(min(n, k))]
            rows.append((g, None if null_side and s == 0 else f"s{s}", n, k, items))
    return spark.createDataFrame(rows, "g int, side string, n long, k long, items array<struct<priority:string,value:int>>")


def test_merge_sides_takes_every_pair_alike(spark):
    """Five complete sides of different sizes: each pair of elements is together in
    the merged sample as often as any other."""
    sizes, m, groups = [1, 2, 3, 4, 5], 5, 3000
    got = merge_sides(_sides(spark, sizes, 10, groups), ["g"], "side", m, seed=3).collect()
    total, pairs, single = sum(sizes), {}, {}
    for r in got:
        values = sorted(x["value"] for x in r["items"])
        assert len(values) == m == r["k"] and r["n"] == total
        for i, a in enumerate(values):
            single[a] = single.get(a, 0) + 1
            for b in values[i + 1:]:
                pairs[a, b] = pairs.get((a, b), 0) + 1
    p, q = m / total, m * (m - 1) / (total * (total - 1))
    assert len(single) == total and len(pairs) == total * (total - 1) // 2
    assert all(abs(c / groups - p) < 5 * (p * (1 - p) / groups) ** 0.5 for c in single.values())
    assert all(abs(c / groups - q) < 5 * (q * (1 - q) / groups) ** 0.5 for c in pairs.values())


def test_merge_sides_rules(spark):
    df = _sides(spark, [50, 4, 30], 10, null_side=True)
    out = merge_sides(df, ["g"], "side", 20, seed=1).collect()
    assert [(r["n"], r["k"], len(r["items"])) for r in out] == [(84, 10, 10)]  # Rule R: incomplete sides hold 10
    tags = [x["priority"] for x in out[0]["items"]]
    assert tags == sorted(tags) and all(t.startswith("drawn-") for t in tags)
    assert merge_sides(_sides(spark, [2, 3], 10), ["g"], "side", 20).first()["k"] == 5  # all there is
    one = merge_sides(_sides(spark, [7], 10), ["g"], "side", 3).first()
    assert one["n"] == 7 and len(one["items"]) == 3
    whole = merge_sides(df.drop("g"), [], "side", 20, seed=1).collect()
    assert len(whole) == 1 and len(whole[0]["items"]) == 10
    assert merge_sides(df.limit(0), ["g"], "side", 5).count() == 0
    for bad in (lambda: merge_sides(df, ["g"], "side", 0), lambda: merge_sides(df, ["g"], "side", 5, short="x"),
                lambda: merge_sides(df.union(df), ["g"], "side", 5).collect(),  # a side twice
                lambda: merge_sides(df, ["g"], "side", 20, short="error").collect(),  # above an incomplete side
                lambda: merge_sides(_sides(spark, [3, 0], 10), ["g"], "side", 2, short="error").collect()):  # an empty side
        with pytest.raises(Exception):
            bad()


def test_merge_sides_of_two_equals_the_share_of_sizes(spark):
    got = merge_sides(_sides(spark, [300, 100], 10, 500), ["g"], "side", 10, seed=8).collect()
    left = sum(x["value"] < 1000 for r in got for x in r["items"]) / (500 * 10)
    assert abs(left - 0.75) < 0.03
