"""Element-level changelogs, pairs and reservoirs that go on from a stored state."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import md5_hex, pair_state_machine, reservoir
from kpool.operators.acceptance import acceptance_log, items_at, number_rows, sample_changelog, summaries_at
from kpool.operators.ordinal import ordinal
from kpool.operators.reservoir import reservoir_update
from kpool.streaming import changelog as C
from kpool.streaming.reservoir_stream import reservoir_step, stream_history, stream_pool, stream_reservoir

SCHEMA = "key string, at long, id long, left boolean"


def rows_of(rng, count, ids=10_000, keys=("hot", "hot", "hot", "a", "b", None)):
    """Elements in arrival order; ids repeat, one key holds about half of all."""
    return [(rng.choice(keys), i, rng.randrange(ids), rng.random() < 0.4) for i in range(count)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def plain(rows, k, seed=5):
    """Per key: (n, entered, gone) of every change, and the items after every element."""
    changes, after = [], {}
    for key, own in by_key(rows).items():
        held = []
        for n, (_, _, ident, _) in enumerate(own, 1):
            item = (md5_hex(seed, ident), n, ident)
            kept = sorted([*held, item])[:k]
            if item in kept:
                gone = [x for x in held if x not in kept]
                changes.append((key, n, ident, gone[0][2] if gone else None, bool(gone)))
            held = kept
            after[(key, n)] = [x[2] for x in held]
    return sorted(changes, key=repr), after


def numbered(df, num_partitions=None):
    return number_rows(df, ["key"], ["at"], "id", ["id"], 5, num_partitions=num_partitions)


@pytest.mark.parametrize("limit", ["1000", "2"])
@pytest.mark.parametrize("ids", [10_000, 12])
def test_log_equals_plain_sampling(spark, ids, limit):
    """Several blocks a key; few ids, so equal priorities; with and without Spark's group limit."""
    rows = rows_of(random.Random(ids), 1500, ids)
    changes, after = plain(rows, 4)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    try:
        num = numbered(frame(spark, rows), 6)
        log = acceptance_log(num, ["key"], 4).cache()
        assert sorted(map(tuple, sample_changelog(log, ["key"]).collect()), key=repr) == changes
        every = num.select("key", F.col("n").alias("at"))
        got = {(r["key"], r["n"]): [x["value"] for x in r["items"]] for r in summaries_at(log, every, ["key"], F.lit(4)).collect()}
        assert {at: sorted(x) for at, x in got.items()} == {at: sorted(x) for at, x in after.items()}
        log.unpersist()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_sizes_by_key_and_bins(spark, monkeypatch):
    from kpool.operators import acceptance as A

    monkeypatch.setattr(A, "BIN", 64)  # instants of one key spread over many bins
    rows = [("a" if i % 2 else "b", i, i, True) for i in range(900)]
    size = F.when(F.col("key") == "a", 2).otherwise(7)
    num = numbered(frame(spark, rows))
    log = acceptance_log(num, ["key"], 7, k_of=size)
    met = items_at(log, num.select("key", F.col("n").alias("at")), ["key"])
    assert met.filter("key = 'b'").select("_bin").distinct().count() > 10
    got = {}
    for r in met.collect():
        got.setdefault((r["key"], r["at"]), []).append(r["value"])
    for key, k in (("a", 2), ("b", 7)):
        after = plain([r for r in rows if r[0] == key], k)[1]
        assert {n: sorted(v) for (x, n), v in got.items() if x == key} == {n: sorted(v) for (_, n), v in after.items()}


def test_log_of_one_global_sample(spark):
    rows = [(None, i, i * 7 % 501, True) for i in range(500)]
    num = number_rows(frame(spark, rows), [], ["at"], "id", ["id"], 5)
    log = acceptance_log(num, [], 3)
    changes, after = plain(rows, 3)
    assert sorted((None, *r) for r in sample_changelog(log, []).collect()) == sorted(changes)
    got = summaries_at(log, num.select(F.col("n").alias("at")), [], F.lit(3)).collect()
    assert {r["n"]: sorted(x["value"] for x in r["items"]) for r in got} == {n: sorted(v) for (_, n), v in after.items()}
    assert items_at(log, num.limit(0).select(F.col("n").alias("at")), []).count() == 0


def test_empty_input(spark):
    num = numbered(frame(spark, []))
    log = acceptance_log(num, ["key"], 3)
    assert log.count() == 0 and sample_changelog(log, ["key"]).count() == 0


def run_parts(spark, rows, parts, step):
    """Outputs of a step function over ``parts`` micro-batches, each given the state before."""
    state, out = None, []
    size = -(-len(rows) // parts) if rows else 1
    for i in range(parts):
        got, after = step(frame(spark, rows[i * size:(i + 1) * size]), state)
        out += got.collect()
        state = spark.createDataFrame(after.collect(), after.schema)
    return out


@pytest.mark.parametrize("parts", [1, 4])
def test_changelog_goes_on_from_its_state(spark, parts):
    rows = rows_of(random.Random(parts), 700, 300)
    out = run_parts(spark, rows, parts, lambda b, s: C.changelog_step(b, ["key"], 3, "id", ["id"], ["at"], 5, s))
    assert sorted(map(tuple, out), key=repr) == plain(rows, 3)[0]


@pytest.mark.parametrize("parts", [7])
def test_pairs_go_on_from_their_state(spark, parts):
    rows = rows_of(random.Random(30 + parts), 400)
    out = run_parts(spark, rows, parts, lambda b, s: C.pair_step(b, ["key"], F.col("left"), ["at"], "at", s))
    want = [(key, left, right) for key, own in by_key(rows).items() for left, right in pair_state_machine([(r[3], r[1]) for r in own])]
    assert sorted(((r["key"], r["left_id"], r["right_id"]) for r in out), key=repr) == sorted(want, key=repr)


def plain_paired(rows, k1, k2, m):
    """Every summary of the element-level paired operator."""
    out = []
    for key, own in by_key(rows).items():
        items, n, held = {1: [], 2: []}, {1: 0, 2: 0}, None
        for _, _, ident, left in own:
            side, k = (1, k1) if left else (2, k2)
            n[side] += 1
            items[side] = sorted([*items[side], (md5_hex(5, ident), n[side], ident)])[:k]
            mine = (n[side], list(items[side]))
            out.append((key, f"sampled{side}", n[side] if left else None, None if left else n[side], n[side], k, sorted(x[2] for x in mine[1])))
            if held and held[0] != side:
                (n1, i1), (n2, i2) = (mine, held[1]) if left else (held[1], mine)
                most = min([m] + ([k1] if n1 > k1 else []) + ([k2] if n2 > k2 else []))
                pool = sorted([*i1, *i2], key=lambda x: (x[0], x[2]))[:most]
                out.append((key, "merged", n1, n2, n1 + n2, most, sorted(x[2] for x in pool)))
                held = None
            else:
                held = (side, mine)
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 3])
def test_paired_changelog_goes_on_from_its_state(spark, parts):
    rows = rows_of(random.Random(60 + parts), 500, 10**9)
    out = run_parts(spark, rows, parts, lambda b, s: C.paired_step(b, ["key"], F.col("left"), 3, 5, 6, "id", ["id"], ["at"], 5, s))
    got = [(r["key"], r["kind"], r["n1"], r["n2"], r["n"], r["k"], sorted(x["value"] for x in r["items"])) for r in out]
    assert sorted(got, key=repr) == plain_paired(rows, 3, 5, 6)


def test_hot_key_meets_in_many_bins(spark, monkeypatch):
    """The instants of one key are dealt by (key, bin): no task holds them all."""
    from kpool.operators import acceptance as A

    monkeypatch.setattr(A, "BIN", 32)
    rows = [("hot", i, i, i % 3 == 0) for i in range(600)]
    num = numbered(frame(spark, rows))
    met = items_at(acceptance_log(num, ["key"], 3), num.select("key", F.col("n").alias("at")), ["key"])
    per_bin = met.groupBy("key", "_bin").agg(F.countDistinct("at").alias("c")).agg(F.max("c"), F.count("*")).first()
    assert per_bin[0] <= 32 and per_bin[1] > 15


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summaries_are_made_where_their_bins_are(spark, monkeypatch):
    """Instants move to the row of their bin, and what they pick there moves no more."""
    from kpool.operators import acceptance as A

    monkeypatch.setattr(A, "BIN", 32)
    rows = rows_of(random.Random(11), 300)
    num = numbered(frame(spark, rows))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = summaries_at(acceptance_log(num, ["key"], 3), num.select("key", F.col("n").alias("at")), ["key"], F.lit(3))
        above, *below = plan_of(got).split("Join", 1)
        assert below and "Exchange" not in above and "Aggregate" not in above
        items, instants = below[0].count("ObjectHashAggregate"), below[0].count("REPARTITION_BY_COL")
        assert (items, instants) == (2, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    after = plain(rows, 3)[1]
    assert {(r["key"], r["n"]): sorted(x["value"] for x in r["items"]) for r in got.collect()} == {at: sorted(x) for at, x in after.items()}


@pytest.mark.parametrize("dealt", [16, 1 << 18])
def test_log_matches_pushes_without_a_join(spark, monkeypatch, dealt):
    from kpool.operators import acceptance as A

    monkeypatch.setattr(A, "DEALT", dealt, raising=False)
    rows = rows_of(random.Random(12), 400, 50)
    log = acceptance_log(numbered(frame(spark, rows)), ["key"], 3)
    assert "Join" not in plan_of(log).split("Exchange", 1)[0]
    assert sorted(map(tuple, sample_changelog(log, ["key"]).collect()), key=repr) == plain(rows, 3)[0]


def test_numbered_rows_carry_their_order_once(spark):
    rows = rows_of(random.Random(13), 60)
    got = number_rows(frame(spark, rows), ["key"], ["at"], "id", ["id"], 5, keep=["at"])
    assert "_by0" not in plan_of(got)
    assert {(r["key"], r["at"]): r["n"] for r in got.collect()} == {(key, r[1]): n for key, own in by_key(rows).items() for n, r in enumerate(own, 1)}


@pytest.mark.parametrize("buckets", [2, 1 << 20])
def test_latest_row_of_each_key(spark, monkeypatch, buckets):
    """Rows that cannot be last go before rows with their payload are sorted."""
    monkeypatch.setattr(C, "BUCKETS", buckets, raising=False)
    rows = [(r[0], r[1], r[2], r[3]) for r in rows_of(random.Random(14), 200)]
    got = C.latest(frame(spark, rows), ["key", "left"], "at", "at", "id")
    want = {}
    for key, at, ident, left in sorted(rows, key=lambda r: r[1]):
        want[(key, left)] = (at, ident)
    assert {(r["key"], r["left"]): (r["at"], r["id"]) for r in got.collect()} == want
    assert "_least" in plan_of(got).split("SortAggregate", 1)[-1]
    assert C.latest(frame(spark, []), ["key"], "at", "id").count() == 0


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = rows_of(random.Random(4), 200, 300)
    table, out = str(tmp_path / "state"), str(tmp_path / "out")
    write = C._batch_writer(lambda b, s: C.changelog_step(b, ["key"], 3, "id", ["id"], ["at"], 5, s), table, out)
    for i, part in enumerate((rows[:80], rows[80:150])):
        write(frame(spark, part), i)
    write(frame(spark, rows[80:150]), 1)  # again
    write(frame(spark, rows[150:]), 2)
    got = spark.read.parquet(out).drop("batch").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 3)[0]
    with pytest.raises(RuntimeError, match="needs version"):
        write(frame(spark, rows[150:]), 7)


def test_streams_check_their_arguments(spark):
    sdf = spark.readStream.format("rate").load()
    for bad in (lambda: C.stream_changelog(sdf, [], 0, "value", ["value"], ["value"]), lambda: C.stream_changelog(sdf, [], 5, "value", ["value"]),
                lambda: C.stream_paired_changelog(sdf, [], F.lit(True), "value", ["value"], ["value"], k2=0),
                lambda: stream_reservoir(sdf, 5, [], ["value"]), lambda: stream_reservoir(sdf, -1, ["value"], ["value"])):
        with pytest.raises(ValueError):
            bad()


# --- reservoirs -------------------------------------------------------------

@pytest.mark.parametrize("parts", [3, 7])
def test_reservoir_goes_on_from_its_pool(spark, parts):
    rows = rows_of(random.Random(80 + parts), 500)
    pool = seen = None
    size = -(-len(rows) // parts)
    for i in range(parts):
        pool, seen = reservoir_update(frame(spark, rows[i * size:(i + 1) * size]), 4, ["at"], ["at"], ["key"], 9, pool, seen)
        pool, seen = (spark.createDataFrame(d.collect(), d.schema) for d in (pool, seen))
    got = {}
    for r in pool.collect():
        got.setdefault(r["key"], {})[r["slot"]] = (r["n"], r["at"])
    want = {}
    for key, own in by_key(rows).items():
        # the twin spells a null key as no key part; its part is "-"
        want[key] = reservoir([r[1] for r in own], 4, 9, key) if key is not None else None
    assert {k: v for k, v in got.items() if k is not None} == {k: v for k, v in want.items() if k is not None}
    whole = reservoir_update(frame(spark, rows), 4, ["at"], ["at"], ["key"], 9)[0].collect()
    assert {(r["key"], r["slot"], r["n"], r["at"]) for r in whole} == {(k, s, *v) for k, x in got.items() for s, v in x.items()}
    assert {r["key"]: r["seen"] for r in seen.collect()} == {k: len(v) for k, v in by_key(rows).items()}


def test_pool_and_counts_go_together(spark):
    df = frame(spark, [("a", 1, 1, True)])
    pool, _ = reservoir_update(df, 2, ["at"], ["at"], ["key"])
    with pytest.raises(ValueError):
        reservoir_update(df, 2, ["at"], ["at"], ["key"], pool=pool)


def test_history_of_a_stream_equals_the_batch_history(spark, tmp_path):
    from kpool.operators.reservoir import reservoir_as_of, reservoir_history

    rows = rows_of(random.Random(2), 400)
    table, out = str(tmp_path / "state"), str(tmp_path / "out")
    write = C._batch_writer(lambda b, s: reservoir_step(b, 4, ["at"], ["at"], ["key"], 9, "", s), table, out)
    for i in range(7):
        part = rows[i * 60:(i + 1) * 60]
        write(frame(spark, part), i)
        if i % 3 == 1:
            write(frame(spark, part), i)  # a lost attempt, again
    got = stream_history(spark, table, out, ["at"], ["key"])
    want = reservoir_history(frame(spark, rows), 4, ["at"], ["at"], ["key"], 9)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    for n in (1, 3, 59, 100):
        a, b = (sorted(map(tuple, reservoir_as_of(h, n).select("key", "slot", "at").collect()), key=repr) for h in (got, want))
        assert a == b
    assert stream_pool(spark, table, ["at"], ["key"]).count() == reservoir_as_of(want, 10**6).count()
    with pytest.raises(ValueError):
        stream_pool(spark, str(tmp_path / "none"), ["at"])


# --- ordinals that go on ----------------------------------------------------

@pytest.mark.parametrize("plan", ["broadcast", "local"])
def test_ordinal_goes_on_after_seen_rows(spark, plan):
    rows = rows_of(random.Random(1), 300)
    seen = spark.createDataFrame([("hot", 100), (None, 7), ("unused", 5)], "key string, seen long")
    got = ordinal(frame(spark, rows), ["at"], ["key"], num_partitions=5, plan=plan, start=seen).collect()
    want = {(r[0], r[1]): n + {"hot": 100, None: 7}.get(key, 0) for key, own in by_key(rows).items() for n, r in enumerate(own, 1)}
    assert {(r["key"], r["at"]): r["n"] for r in got} == want


def test_global_ordinal_goes_on(spark):
    seen = spark.createDataFrame([(40,)], "seen long")
    got = ordinal(frame(spark, rows_of(random.Random(1), 50)), ["at"], start=seen).collect()
    assert sorted(r["n"] for r in got) == list(range(41, 91))
