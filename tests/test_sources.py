from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import draw, part
from kpool.operators.summary import build_summary, render_summary
from kpool.sources.generators import integer_range, random_strings
from kpool.sources.messages import read_messages, summary_payload, write_summaries


def test_integer_range_inclusive(spark):
    df = integer_range(spark, 1, 10000, num_partitions=4)
    row = df.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("c")).first()
    assert (row.lo, row.hi, row.c) == (1, 10000, 10000)


def test_random_strings_shape_and_python_twin(spark):
    df = random_strings(spark.range(0, 3000), ["id"], seed=1)
    rows = df.collect()
    lengths = Counter(len(r.text) for r in rows)
    letters = Counter(ch for r in rows for ch in r.text)
    assert set(lengths) == set(range(1, 11))
    assert set(letters) == set("abcdefghijklmnopqrstuvwxyz")
    for r in rows[:50]:
        n = 1 + draw(1, "len", part(r.id), bound=10)
        assert r.text == "".join(chr(97 + draw(1, "letter", part(r.id), i, bound=26)) for i in range(1, n + 1))


def test_random_strings_on_a_stream(spark, tmp_path):
    sdf = spark.readStream.schema(spark.read.parquet(f"{SF_SMALL}/events.parquet").schema) \
        .option("pathGlobFilter", "events.parquet").parquet(SF_SMALL).select("event_id")
    out = random_strings(sdf, ["event_id"], seed=2)
    q = (out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start(str(tmp_path / "o")))
    q.awaitTermination()
    got = {r.event_id: r.text for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    want = {r.event_id: r.text for r in random_strings(
        spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id"), ["event_id"], seed=2).collect()}
    assert got == want


def test_payload_is_rendered_utf8_with_ingest_time(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    summ = build_summary(part, ["p_brand"], 3, "p_name", ["p_partkey"], seed=1)
    pay = summary_payload(summ, topic="samples")
    assert dict(pay.dtypes) == {"p_brand": "string", "value": "binary", "ingest_ts": "timestamp", "topic": "string"}
    texts = sorted(bytes(r.value).decode("utf-8") for r in pay.collect())
    want = sorted(r.t for r in summ.select(render_summary(F.col("n"), F.col("k"), F.col("items")).alias("t")).collect())
    assert texts == want


def test_write_summaries_file_and_console_sinks(spark, tmp_path):
    # summaries written as a table, then replayed as a stream into the sinks
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    summ = build_summary(ev, ["event_type"], 4, "event_id", ["event_id"], seed=1)
    summ.write.parquet(str(tmp_path / "summ"))
    sdf = read_messages(spark, "parquet", schema=summ.schema, path=str(tmp_path / "summ"))
    q = write_summaries(sdf, "parquet", str(tmp_path / "ck"), path=str(tmp_path / "out"),
                        trigger={"availableNow": True})
    q.awaitTermination()
    vals = [bytes(r.value).decode() for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(vals) == 5 and all(v.startswith("SamplePool @  stream size: ") for v in vals)
    q2 = write_summaries(read_messages(spark, "parquet", schema=summ.schema, path=str(tmp_path / "summ")),
                         "console", str(tmp_path / "ck2"), label="sampled1: SamplePool",
                         trigger={"availableNow": True})
    q2.awaitTermination()
    assert q2.exception() is None


def test_kafka_records_carry_ingest_time_in_a_header(spark):
    from kpool.sources.messages import kafka_records

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    summ = build_summary(ev, [], 3, "event_id", ["event_id"], seed=1)
    recs = kafka_records(summary_payload(summ, topic="samples"))
    assert recs.columns == ["value", "headers", "topic"]
    r = recs.first()
    assert r.topic == "samples" and r.headers[0].key == "ingest_ts"
    assert bytes(r.headers[0].value).decode().startswith("20")
    assert bytes(r.value).decode().startswith("SamplePool @  stream size: 1000")
