import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from helpers import md5_hex
from kpool.operators.sample import sample_by_key, sample_k


def _tiny(spark):
    rows = []
    i = 0
    # keys with 0..k+1 rows (k=3), a null key, repeated and null values
    for key, cnt in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 9), (None, 5)):
        for _ in range(cnt):
            i += 1
            rows.append((i, key, None if i % 7 == 0 else f"v{i % 3}"))
    return spark.createDataFrame(rows, "id bigint, key string, value string")


def _brute(rows, k, seed):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((md5_hex(seed, r[0]), r[0]))
    return {key: sorted(v)[:k] for key, v in by.items()}


@pytest.mark.parametrize("strategy", ["window", "prune"])
def test_sample_by_key_equals_brute_force(spark, strategy):
    df = _tiny(spark)
    got = sample_by_key(df, ["key"], 3, ["id"], seed=11, strategy=strategy).collect()
    want = _brute([tuple(r) for r in df.collect()], 3, 11)
    by = {}
    for r in got:
        by.setdefault(r.key, []).append((r.priority, r.id, r.sample_rank))
    assert set(by) == set(want)
    for key, items in by.items():
        items.sort()
        assert [(p, i) for p, i, _ in items] == want[key]
        assert [rk for _, _, rk in items] == list(range(1, len(items) + 1))


def test_global_sample_strategies_agree(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    a = sample_k(li, 300, ids, seed=3, strategy="window").select("priority", "sample_rank").collect()
    b = sample_k(li, 300, ids, seed=3, strategy="prune").select("priority", "sample_rank").collect()
    assert sorted(a) == sorted(b) and len(a) == 300


def test_sample_independent_of_partitioning(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = sample_by_key(ev, ["event_type"], 7, ["event_id"], seed=1, strategy="window")
    b = sample_by_key(ev.repartition(13, "user_id"), ["event_type"], 7, ["event_id"], seed=1, strategy="window")
    assert sorted(a.select("event_id").collect()) == sorted(b.select("event_id").collect())


def test_k_larger_than_group_caps(spark):
    df = _tiny(spark)
    got = sample_k(df.filter(F.col("key") == "b"), 10, ["id"], seed=1).count()
    assert got == 2


def test_short_error_raises(spark):
    df = _tiny(spark)
    with pytest.raises(Exception):
        sample_by_key(df, ["key"], 3, ["id"], seed=1, short="error").collect()


def test_empty_input(spark):
    df = _tiny(spark).filter(F.lit(False))
    assert sample_k(df, 5, ["id"], seed=1).count() == 0
    assert sample_by_key(df, ["key"], 5, ["id"], seed=1, strategy="prune").count() == 0


@pytest.mark.parametrize("k", [0, -1, 1.5])
def test_bad_k(spark, k):
    with pytest.raises(ValueError):
        sample_k(_tiny(spark), k, ["id"])


def test_window_plan_has_partial_group_limit(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    s = sample_by_key(ev.select("event_id", "event_type"), ["event_type"], 5, ["event_id"], strategy="window")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_prune_with_hot_key_among_many_keys(spark, monkeypatch):
    # one key holds a third of the rows; the broadcast bound admits few keys,
    # so only the hot key is pruned and the others pass whole
    import kpool.operators.sample as sm

    monkeypatch.setattr(sm, "MAX_BROADCAST_KEYS", 4)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 97}") for i in range(1, 6001)]
    df = spark.createDataFrame(rows, "id bigint, key string")
    got = sm.sample_by_key(df, ["key"], 5, ["id"], seed=7, strategy="prune")
    want = sm.sample_by_key(df, ["key"], 5, ["id"], seed=7, strategy="window")
    assert sorted(got.select("key", "id", "sample_rank").collect()) == \
        sorted(want.select("key", "id", "sample_rank").collect())
