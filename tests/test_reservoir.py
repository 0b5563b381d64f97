import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import pair_state_machine, reservoir
from kpool.operators.ordinal import ordinal
from kpool.operators.pairing import pair_latest_unmatched
from kpool.operators.reservoir import reservoir_as_of, reservoir_by_key, reservoir_history, reservoir_replay


def test_ordinal_equals_row_number(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "user_id")
    got = ordinal(ev, ["ts", "event_id"], num_partitions=7)
    want = ev.withColumn("n", F.row_number().over(Window.orderBy("ts", "event_id")).cast("bigint"))
    assert sorted(got.select("event_id", "n").collect()) == sorted(want.select("event_id", "n").collect())


def test_keyed_ordinal_equals_row_number(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "event_type")
    got = ordinal(ev, ["ts", "event_id"], keys=["event_type"], num_partitions=5)
    want = ev.withColumn("n", F.row_number().over(
        Window.partitionBy("event_type").orderBy("ts", "event_id")).cast("bigint"))
    assert sorted(got.select("event_id", "n").collect()) == sorted(want.select("event_id", "n").collect())


def test_ordinal_plan_reuses_range_exchange(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts")
    got = ordinal(ev, ["ts", "event_id"], num_partitions=4)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 0  # both branches read the checkpoint


def _events_sorted(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "user_id")
    return ev, [r.event_id for r in ev.orderBy("ts", "event_id").collect()]


def test_reservoir_replay_equals_python_replay(spark):
    ev, order = _events_sorted(spark)
    got = reservoir_replay(ev, 25, ["ts", "event_id"], ["event_id"], seed=5, num_partitions=6)
    want = reservoir(order, 25, 5)
    assert {r.slot: (r.n, r.event_id) for r in got.collect()} == want


def test_reservoir_small_stream_keeps_all(spark):
    ev, order = _events_sorted(spark)
    got = reservoir_replay(ev.limit(0), 10, ["ts", "event_id"], ["event_id"], seed=1)
    assert got.count() == 0
    got = reservoir_replay(ev.filter(F.col("event_id") <= 4), 10, ["ts", "event_id"], ["event_id"])
    assert got.count() == ev.filter(F.col("event_id") <= 4).count()


def test_reservoir_by_key_equals_python(spark):
    ev, _ = _events_sorted(spark)
    rows = ev.orderBy("ts", "event_id").collect()
    per = {}
    for r in rows:
        per.setdefault(r.user_id, []).append(r.event_id)
    got = reservoir_by_key(ev, ["user_id"], 3, ["ts", "event_id"], ["event_id"], seed=8).collect()
    want = {(u, s): v for u, ids in per.items() for s, v in reservoir(ids, 3, 8, key_text=u).items()}
    assert {(r.user_id, r.slot): (r.n, r.event_id) for r in got} == want


def test_history_as_of_equals_prefix_replay(spark):
    ev, order = _events_sorted(spark)
    hist = reservoir_history(ev, 20, ["ts", "event_id"], ["event_id"], seed=2)
    for cut in (5, 20, 21, 333, len(order)):
        got = {r.slot: r.event_id for r in reservoir_as_of(hist, cut).collect()}
        want = {s: v[1] for s, v in reservoir(order[:cut], 20, 2).items()}
        assert got == want, cut


def test_reservoir_inclusion_is_uniform_not_slot_biased():
    # D1/D6 regression: every element of a length-8 stream is kept with prob. 3/8
    from collections import Counter

    c = Counter()
    trials = 4000
    for seed in range(trials):
        for _, (_, ident) in reservoir(list(range(8)), 3, seed).items():
            c[ident] += 1
    for ident in range(8):
        assert abs(c[ident] / trials - 3 / 8) < 0.04


@pytest.mark.parametrize("slices", [None, 1, 300])
def test_pairing_closed_form_equals_state_machine_all_strings(spark, slices):
    rows = []
    seqs = {}
    key = 0
    for length in range(0, 9):
        for pattern in itertools.product([True, False], repeat=length):
            key += 1
            seq = [(is_left, key * 100 + i) for i, is_left in enumerate(pattern)]
            seqs[key] = seq
            rows += [(key, i, is_left, ident) for i, (is_left, ident) in enumerate(seq)]
    df = spark.createDataFrame(rows, "k bigint, pos bigint, is_left boolean, ident bigint")
    got = pair_latest_unmatched(df, ["k"], F.col("is_left"), ["pos"], "ident", num_partitions=slices).collect()
    got_by = {}
    for r in got:
        got_by.setdefault(r.k, []).append((r.left_id, r.right_id))
    for k, seq in seqs.items():
        assert sorted(got_by.get(k, [])) == sorted(pair_state_machine(seq)), seq


def test_ordinal_exact_with_sparse_range_sampling(spark):
    # few sample points per partition: bounds differ between two samplings,
    # so counts and rows must come from one materialisation
    from conftest import SF_MID

    key = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    old = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        ev = spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id", "ts", "user_id").repartition(4)
        got = ordinal(ev, ["ts", "event_id"], keys=["user_id"], num_partitions=16)
        want = ev.withColumn("n", F.row_number().over(
            Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("bigint"))
        diff = got.select("event_id", "n").exceptAll(want.select("event_id", "n")).count()
        assert diff == 0 and got.count() == ev.count()
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("slices", [1, 5, 40])
def test_pairing_of_keys_that_span_slices(spark, slices):
    rng = random.Random(slices)
    seqs = {}
    for key in [None, *range(5)]:  # from nearly alternating to long runs
        turn, side, seq = (0.99, 0.9, 0.5, 0.2, 1.0, 0.7)[key or 0], True, []
        for i in range(200):
            side = side != (rng.random() < turn)
            seq.append((side, (key or 9) * 1000 + i))
        seqs[key] = seq
    rows = [(k, i, is_left, ident) for k, seq in seqs.items() for i, (is_left, ident) in enumerate(seq)]
    df = spark.createDataFrame(rows, "k bigint, pos bigint, is_left boolean, ident bigint")
    got = pair_latest_unmatched(df, ["k"], F.col("is_left"), ["pos"], "ident", num_partitions=slices).collect()
    for k, seq in seqs.items():
        assert sorted((r.left_id, r.right_id) for r in got if r.k == k) == sorted(pair_state_machine(seq))
    one = df.filter("k = 3")
    got = pair_latest_unmatched(one, [], F.col("is_left"), ["pos"], "ident", num_partitions=slices).collect()
    assert sorted((r.left_id, r.right_id) for r in got) == sorted(pair_state_machine(seqs[3]))



def test_keyed_ordinal_local_plan_equals_row_number(spark):
    # tiny Arrow batches so runs continue across batches; a null key; a hot
    # key holding a third of the rows spans several range partitions
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        rows = [(i, None if i % 11 == 0 else ("hot" if i % 3 == 0 else f"k{i % 5}"), (i * 37) % 101)
                for i in range(1, 600)]
        df = spark.createDataFrame(rows, "id bigint, key string, t bigint")
        got = ordinal(df, ["t", "id"], keys=["key"], num_partitions=6, plan="local")
        want = df.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("t", "id")).cast("bigint"))
        assert sorted(got.select("id", "n").collect()) == sorted(want.select("id", "n").collect())
    finally:
        spark.conf.set(key, old)
