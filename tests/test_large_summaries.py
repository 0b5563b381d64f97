"""Row-form summaries, ranks by ordinals, and the stored tree of summaries."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import md5_hex
from kpool.operators.merge_tree import MergeTree, cover
from kpool.operators.sample import sample_by_key, sample_k
from kpool.operators.summary import build_summary, explode_summary
from kpool.operators.summary_rows import build_rows, merge_rows


@pytest.fixture()
def small_limit(spark):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    yield
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def best(ids, k, seed=3):
    return [(md5_hex(seed, i), i) for i in sorted(ids, key=lambda i: md5_hex(seed, i))[:k]]


def test_large_samples_are_ranked_without_one_window(spark, small_limit):
    df = spark.range(0, 3000, 1, 6)
    got = sample_k(df, 200, ["id"], seed=3)
    assert [(r["priority"], r["id"]) for r in got.orderBy("sample_rank").collect()] == best(range(3000), 200)
    keyed = df.withColumn("key", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2990, "b"))
    rows = sample_by_key(keyed, ["key"], 50, ["id"], seed=3).collect()
    for key, ids in (("hot", range(2000)), ("b", range(2000, 2990)), (None, range(2990, 3000))):
        own = sorted((r["sample_rank"], r["priority"], r["id"]) for r in rows if r["key"] == key)
        assert [x[1:] for x in own] == best(ids, 50) and [x[0] for x in own] == list(range(1, len(own) + 1))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_rows_equal_the_array_form(spark, small_limit, keys):
    df = spark.range(0, 2500, 1, 5).withColumn("key", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 100 > 0, "b"))
    parts = [df.filter(F.col("id") % 3 == i) if not keys else df.filter((F.col("id") / 7).cast("long") % 3 == i) for i in range(3)]
    rows = [build_rows(p, keys, 40, "id", ["id"], seed=3) for p in parts]
    stats, items = merge_rows(rows, keys, 60)
    whole = explode_summary(build_summary(df, keys, 40, "id", ["id"], seed=3), keys)  # m is capped at 40 by Rule R
    cols = [*keys, "sample_rank", "priority", "value"]
    assert sorted(map(tuple, items.select(*cols).collect()), key=repr) == sorted(map(tuple, whole.select(*cols).collect()), key=repr)
    want = {tuple(r) for r in df.groupBy(*keys).count().collect()}
    assert {tuple(r) for r in stats.select(*keys, "n").collect()} == want
    assert {r["k"] for r in stats.collect()} <= {40, 60}


def test_row_form_rules(spark):
    df = spark.range(20)
    whole = build_rows(df, [], 30, "id", ["id"])
    stats, items = merge_rows([whole, build_rows(df.withColumn("id", F.col("id") + 100), [], 30, "id", ["id"])], [], 35)
    assert tuple(stats.first()) == (40, 35) and items.count() == 35
    assert merge_rows([build_rows(df, [], 5, "id", ["id"])], [], 9)[1].count() == 5
    with pytest.raises(Exception):
        merge_rows([build_rows(df, [], 5, "id", ["id"])], [], 9, short="error")[1].collect()
    with pytest.raises(ValueError):
        merge_rows([], [], 5)
    empty = merge_rows([build_rows(df.limit(0), ["id"], 5, "id", ["id"])], ["id"], 5)
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_cover_is_exact_and_short():
    rng = random.Random(1)
    for _ in range(500):
        levels = rng.randint(1, 8)
        begin = rng.randrange(300)
        end = begin + rng.randrange(300)
        nodes = cover(begin, end, levels)
        buckets = sorted(b for level, i in nodes for b in range(i << level, (i + 1) << level))
        assert buckets == list(range(begin, end))
        assert len(nodes) <= 2 * levels + (end - begin) // (1 << levels) + 1


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_tree_ranges_equal_direct_samples(spark, tmp_path, keys):
    rng = random.Random(7)
    df = spark.createDataFrame([(i, rng.choice([None, *range(5, 90)]), rng.choice(["a", None])) for i in range(1500)], "id long, bucket long, key string")
    tree = MergeTree(spark, str(tmp_path / "tree"), 12, keys, levels=5)
    with pytest.raises(ValueError):
        tree.between(0, 5)
    for i in range(2):
        tree.append(df.filter(F.col("id") % 2 == i), "bucket", "id", ["id"], seed=3, append_id=i)
    tree.append(df.filter(F.col("id") % 2 == 1), "bucket", "id", ["id"], seed=3, append_id=1)  # again: nothing changes
    for begin, end in [(0, 200), (5, 6), (17, 18), (30, 30), *((b, b + rng.randrange(1, 60)) for b in rng.sample(range(85), 4))]:
        got = tree.between(begin, end, 9)
        want = build_summary(df.filter((F.col("bucket") >= begin) & (F.col("bucket") < end)), keys, 9, "id", ["id"], seed=3)
        cols = [*keys, "n", "sample_rank", "priority", "value"]
        a, b = (sorted(map(tuple, explode_summary(x).select(*cols).collect()), key=repr) for x in (got, want))
        assert a == b
