import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kpool.operators.summary import build_summary, explode_summary
from kpool.streaming.paired import run_paired_stream
from kpool.streaming.sample_stream import latest_summary, run_to_end, stream_sample


def _split_events(tmp_path, parts):
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    d = tmp_path / f"split{parts}"
    d.mkdir()
    step = (t.num_rows + parts - 1) // parts
    for i in range(parts):
        pq.write_table(t.slice(i * step, step), d / f"part-{i:03d}.parquet")
    return str(d)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_stream_sample_equals_batch(spark, tmp_path, parts):
    d = _split_events(tmp_path, parts)
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    q, tdir = stream_sample(sdf, ["event_type"], 8, "event_id", ["event_id"], seed=3,
                            table_dir=str(tmp_path / "tab"), checkpoint=str(tmp_path / "ck"))
    run_to_end(q)
    got = explode_summary(latest_summary(spark, tdir)).select("event_type", "n", "priority", "value")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want = explode_summary(build_summary(ev, ["event_type"], 8, "event_id", ["event_id"], seed=3)) \
        .select("event_type", "n", "priority", "value")
    assert sorted(got.collect()) == sorted(want.collect())
    kept = {r.v for r in spark.read.parquet(tdir).select("v").distinct().collect()}
    assert kept == set(range(max(0, parts - 2), parts))  # two alternating slots


def test_stream_batch_replay_is_idempotent(spark, tmp_path):
    from kpool.streaming.sample_stream import summary_batch_writer

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    b0, b1 = ev.filter("event_id % 2 = 0"), ev.filter("event_id % 2 = 1")
    tdir = str(tmp_path / "tab")
    write = summary_batch_writer(["event_type"], 5, "event_id", ["event_id"], 3, tdir)
    write(b0, 0)
    write(b1, 1)
    first = sorted(tuple(r) for r in explode_summary(latest_summary(spark, tdir)).collect())
    write(b1, 1)  # the same batch delivered again after a failure
    again = sorted(tuple(r) for r in explode_summary(latest_summary(spark, tdir)).collect())
    want = sorted(tuple(r) for r in explode_summary(
        build_summary(ev, ["event_type"], 5, "event_id", ["event_id"], seed=3)).collect())
    assert first == again
    assert first == want


def test_stream_restart_continues(spark, tmp_path):
    d = _split_events(tmp_path, 4)
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    live = tmp_path / "live"
    live.mkdir()
    import shutil

    files = sorted((tmp_path / "split4").iterdir())
    for f in files[:2]:
        shutil.copy(f, live / f.name)
    kw = dict(table_dir=str(tmp_path / "tab"), checkpoint=str(tmp_path / "ck"))
    q, tdir = stream_sample(spark.readStream.schema(schema).parquet(str(live)), [], 10, "event_id",
                            ["event_id"], seed=1, **kw)
    run_to_end(q)
    for f in files[2:]:
        shutil.copy(f, live / f.name)
    q, tdir = stream_sample(spark.readStream.schema(schema).parquet(str(live)), [], 10, "event_id",
                            ["event_id"], seed=1, **kw)
    run_to_end(q)
    got = latest_summary(spark, tdir).first()
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want = build_summary(ev, [], 10, "event_id", ["event_id"], seed=1).first()
    assert got.n == want.n == 1000
    assert [tuple(x) for x in got["items"]] == [tuple(x) for x in want["items"]]


def test_paired_stream_final_samples(spark, tmp_path):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
    clicks = ev.filter(F.col("event_type") == "click")
    views = ev.filter(F.col("event_type") == "view")
    out = run_paired_stream(clicks, views, ["user_id"], "event_id", ["event_id"], ["ts", "event_id"],
                              k1=3, k2=4, m=5, seed=2, out_dir=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    rows = spark.read.parquet(out).collect()
    batch = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want1 = {r.user_id: r for r in build_summary(batch.filter("event_type = 'click'"), ["user_id"], 3,
                                                  "event_id", ["event_id"], seed=2).collect()}
    last = {}
    for r in rows:
        if r.kind == "sampled1" and (r.user_id not in last or r.seq > last[r.user_id].seq):
            last[r.user_id] = r
    assert set(last) == set(want1)
    for u, r in last.items():
        assert r.n == want1[u].n
        assert [tuple(x) for x in r["items"]] == [tuple(x) for x in want1[u]["items"]]
    # merged summaries never exceed Rule R's cap and add up both sides' n
    for r in rows:
        if r.kind == "merged":
            assert len(r["items"]) <= r.k <= 5


def test_paired_stream_runs_without_session_provider(spark, tmp_path):
    from kpool.streaming.paired import PROVIDER_KEY

    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.unset(PROVIDER_KEY)  # a default session: HDFS-backed state store
    try:
        schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
        ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
        out = run_paired_stream(ev.filter("event_type = 'click'"), ev.filter("event_type = 'view'"),
                                  ["user_id"], "event_id", ["event_id"], ["ts", "event_id"],
                                  out_dir=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
        assert spark.read.parquet(out).count() > 0
        assert spark.conf.get(PROVIDER_KEY, None) is None  # the session is left as it was
    finally:
        if before is not None:
            spark.conf.set(PROVIDER_KEY, before)


def test_salted_state_merges_to_the_same_samples(spark, tmp_path):
    from kpool.streaming.sample_stream import merged_summary

    d = _split_events(tmp_path, 3)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sdf = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d)
    q, tdir = stream_sample(sdf, [], 8, "event_id", ["event_id"], seed=3, table_dir=str(tmp_path / "tab"), checkpoint=str(tmp_path / "ck"), salt=5)
    run_to_end(q)
    assert latest_summary(spark, tdir).count() == 5  # one key, five sub-keys
    got = explode_summary(merged_summary(spark, tdir, [], 8), []).collect()
    want = explode_summary(build_summary(ev, [], 8, "event_id", ["event_id"], seed=3), []).collect()
    assert sorted(got) == sorted(want)
    with pytest.raises(ValueError):
        stream_sample(sdf, [], 8, "event_id", ["event_id"], salt=0)


def test_arrival_time_stays_inside_items(spark, tmp_path):
    from kpool.sources.messages import stamp_arrival, summary_payload
    from kpool.streaming.sample_stream import stream_merge

    d = _split_events(tmp_path, 3)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sdf = stamp_arrival(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d))
    q, tdir = stream_sample(sdf, [], 40, ["event_id", "arrival_ts"], ["event_id"], seed=3, table_dir=str(tmp_path / "tab"), checkpoint=str(tmp_path / "ck"))
    run_to_end(q)
    merged = stream_merge(spark, [tdir], [], 40)
    rows = explode_summary(merged, []).select("value.event_id", "value.arrival_ts").collect()
    part = {r["event_id"]: i for i in range(3) for r in spark.read.parquet(f"{d}/part-{i:03d}.parquet").select("event_id").collect()}
    times = {}
    for r in rows:
        times.setdefault(part[r["event_id"]], set()).add(r["arrival_ts"])
    assert all(len(t) == 1 for t in times.values())
    order = [min(times[i]) for i in sorted(times)]
    assert order == sorted(order) and len(set(order)) == len(times)
    text = summary_payload(merged).select(F.col("value").cast("string").alias("t")).first()["t"]
    assert str(order[0].year) in text
