"""Message sources and summary sinks (S4, S5, S6).

``read_messages`` reads a message stream: Kafka (``value`` cast to text, the
position (topic, partition, offset) kept as the element identity), or a file
stream of any format.  ``write_summaries`` writes rendered summaries to a
stream sink (Kafka topic, files, console) with a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpool.operators.summary import render_summary


def read_messages(spark: SparkSession, fmt: str, options: dict | None = None, schema=None,
                  path: str | None = None) -> DataFrame:
    options = dict(options or {})
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        df = df.select(
            F.col("value").cast("string").alias("value"),
            F.col("topic"), F.col("partition"), F.col("offset"), F.col("timestamp"),
        )
    return df


def stamp_arrival(messages: DataFrame, name: str = "arrival_ts") -> DataFrame:
    """``messages`` with the time at which they were read (T4).  It is one time per
    micro-batch, taken where the stream enters; given to a sampler as one of its
    ``value_cols`` it stays inside each item through UPDATE, MERGE and payload."""
    return messages.withColumn(name, F.current_timestamp())


def summary_payload(summaries: DataFrame, label: str = "SamplePool", topic: str | Column | None = None,
                    prefix: str | Column | None = None) -> DataFrame:
    """Rows ready for a message sink: ``value`` = rendered summary as UTF-8
    bytes, ``ingest_ts`` = when the row was written (T4, X4).

    All other columns of ``summaries`` (keys, ``kind``, ...) are kept.
    ``topic`` and ``prefix`` (text before the rendered summary) may be columns,
    e.g. of ``kind``, so that one stream feeds several outputs."""
    text = render_summary(F.col("n"), F.col("k"), F.col("items"), label)
    if prefix is not None:
        text = F.concat(prefix if isinstance(prefix, Column) else F.lit(prefix), text)
    kept = [c for c in summaries.columns if c not in ("n", "k", "items", "value", "ingest_ts", "topic")]
    cols: list[Column] = [*map(F.col, kept), text.cast("binary").alias("value"), F.current_timestamp().alias("ingest_ts")]
    if topic is not None:
        cols.append((topic if isinstance(topic, Column) else F.lit(topic)).alias("topic"))
    return summaries.select(*cols)


def by_kind(values: dict[str, str], kind: str = "kind") -> Column:
    """A column that maps ``kind`` to a topic or prefix; other kinds raise."""
    out = F.raise_error(F.concat(F.lit("no output for kind "), F.coalesce(F.col(kind), F.lit("null")))).cast("string")
    for name, value in values.items():
        out = F.when(F.col(kind) == name, value).otherwise(out)
    return out


def kafka_records(payload: DataFrame) -> DataFrame:
    """Kafka sink columns: ``value`` (+ ``topic``), with the ingest time in a
    record header, since the sink takes only key/value/headers/topic/partition."""
    header = F.struct(F.lit("ingest_ts").alias("key"),
                      F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").cast("binary").alias("value"))
    cols = [F.col("value"), F.array(header).alias("headers")]
    if "topic" in payload.columns:
        cols.append(F.col("topic"))
    return payload.select(*cols)


def write_summaries(summaries: DataFrame, fmt: str, checkpoint: str, options: dict | None = None,
                    output_mode: str = "append", label: str = "SamplePool", topic: str | Column | None = None,
                    prefix: str | Column | None = None, path: str | None = None, trigger: dict | None = None):
    """Start a stream writing rendered summaries (S5); returns the query."""
    payload = summary_payload(summaries, label, topic, prefix)
    if fmt == "kafka":
        payload = kafka_records(payload)
    elif fmt == "console":
        payload = payload.withColumn("value", F.col("value").cast("string"))
    w = payload.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.options(**(options or {}))
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()
