"""Element-by-element UPDATE of two sampled streams with consume-once
pairing and MERGE of their summaries (T1 emit="element", T2, J1, S6).

One stateful operator runs over the union of both raw streams, keyed by the
caller's keys.  Per key the state holds summary 1, summary 2 and at most one
pending summary (from one side).  For every element, in the given order:

1. UPDATE its side's summary (insert the element's priority, keep the k
   smallest) and emit it with ``kind = "sampled1" | "sampled2"``;
2. pair that new summary with the pending one of the other side, if any:
   emit their exact MERGE (size m, Rule R) as ``kind = "merged"`` and clear
   the pending one; otherwise it becomes the pending summary (replacing an
   older one of the same side).

State per key is bounded by k1 + k2 + max(k1, k2) items.  Elements of one
key are processed in sequence inside a micro-batch (that order is defined by
``order``); across keys everything runs in parallel.  The order-free,
batch-level form of the same summaries is ``stream_sample``; use that when
a single key carries most of the stream.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kpool.operators.sample import PRIORITY, check_size, with_priority
from kpool.session import shared_dir


ALL = "all_elements"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The processor runs in Python workers; ship this module's code with it so
# executors need not have kpool installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _item_type(value_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("priority", T.StringType()), T.StructField("value", value_type)])


def _state_schema(value_type: T.DataType) -> T.StructType:
    items = T.ArrayType(_item_type(value_type))
    return T.StructType([
        T.StructField("n1", T.LongType()), T.StructField("items1", items),
        T.StructField("n2", T.LongType()), T.StructField("items2", items),
        T.StructField("pend_side", T.IntegerType()), T.StructField("pend_n", T.LongType()),
        T.StructField("pend_k", T.LongType()), T.StructField("pend_items", items),
        T.StructField("seq", T.LongType()),
    ])


def _insert(items: list, item: tuple, k: int) -> list:
    """Keep the k smallest (priority, value) pairs, sorted (small, k-bounded)."""
    if len(items) >= k and item[0] >= items[-1][0]:
        return items
    lo, hi = 0, len(items)
    while lo < hi:
        mid = (lo + hi) // 2
        if items[mid][0] < item[0]:
            lo = mid + 1
        else:
            hi = mid
    out = items[:lo] + [item] + items[lo:]
    return out[:k]


def _merge(a: tuple, b: tuple, m: int) -> tuple:
    """Exact MERGE of two summaries (n, k, items) with Rule R (cap)."""
    (n1, k1, i1), (n2, k2, i2) = a, b
    caps = [k for n, k, i in (a, b) if n > len(i)]
    m_eff = min([m] + caps)
    items = sorted(i1 + i2, key=lambda x: x[0])[:m_eff]
    return n1 + n2, m_eff, items


class _PairedSampler(StatefulProcessor):
    def __init__(self, k1: int, k2: int, m: int, value_type: T.DataType, key_names: Sequence[str]):
        self.k = {1: k1, 2: k2}
        self.m = m
        self.value_type = value_type
        self.key_names = list(key_names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("paired_sampler", _state_schema(self.value_type))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values([c for c in batch.columns if c.startswith("elem_order")], kind="mergesort")
        if self.state.exists():
            s = self.state.get()
            n = {1: s[0], 2: s[2]}
            items = {1: [tuple(x) for x in (s[1] or [])], 2: [tuple(x) for x in (s[3] or [])]}
            pend_side, pend = s[4], (s[5], s[6], [tuple(x) for x in (s[7] or [])])
            seq = s[8]
        else:
            n, items, pend_side, pend, seq = {1: 0, 2: 0}, {1: [], 2: []}, 0, (0, 0, []), 0
        out = []
        for side, pri, val in zip(batch["elem_side"], batch[PRIORITY], batch["elem_value"]):
            side, val = int(side), (val[0] if len(val) else None)
            val = val.item() if isinstance(val, np.generic) else val
            n[side] += 1
            items[side] = _insert(items[side], (pri, val), self.k[side])
            seq += 1
            mine = (n[side], self.k[side], items[side])
            out.append((seq, f"sampled{side}", *mine))
            if pend_side and pend_side != side:
                seq += 1
                out.append((seq, "merged", *_merge(mine, pend, self.m)))
                pend_side, pend = 0, (0, 0, [])
            else:
                pend_side, pend = side, mine
        self.state.update((n[1], items[1], n[2], items[2], pend_side, pend[0], pend[1], pend[2], seq))
        keyvals = list(key)
        yield pd.DataFrame({
            **{name: [keyvals[i]] * len(out) for i, name in enumerate(self.key_names)},
            "seq": [o[0] for o in out],
            "kind": [o[1] for o in out],
            "n": [o[2] for o in out],
            "k": [o[3] for o in out],
            # parallel arrays convert to Arrow far cheaper than per-item dicts;
            # they are zipped into items on the JVM side
            "priority": [[it[0] for it in o[4]] for o in out],
            "value": [[it[1] for it in o[4]] for o in out],
        })

    def close(self) -> None:
        pass


def paired_sample_stream(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    value_col: str,
    id_cols: Sequence[str],
    order: Sequence[str],
    k1: int = 10,
    k2: int = 10,
    m: int = 10,
    seed: int = 0,
) -> DataFrame:
    """Streaming DataFrame of ``keys..., seq, kind, n, k, items`` rows: every
    summary the element-level paired stream emits (defaults k=10, m=10)."""
    for name, v in (("k1", k1), ("k2", k2), ("m", m)):
        check_size(name, v)
    if not keys:  # global: one constant key, as the state needs a grouping
        whole = paired_sample_stream(left.withColumn(ALL, F.lit(1)), right.withColumn(ALL, F.lit(1)), [ALL], value_col,
                                     id_cols, order, k1, k2, m, seed)
        return whole.drop(ALL)
    keys = list(keys)

    def prep(df: DataFrame, side: int) -> DataFrame:
        pdf = with_priority(df, id_cols, seed)
        return pdf.select(*keys, F.lit(side).alias("elem_side"), PRIORITY,
                          # none or one value: pandas would turn integers beside nulls into doubles
                          F.when(F.col(value_col).isNotNull(), F.array(value_col)).otherwise(F.slice(F.array(value_col), 1, 0)).alias("elem_value"),
                          *[F.col(c).alias(f"elem_order{i}") for i, c in enumerate(order)])

    both = prep(left, 1).unionByName(prep(right, 2))
    value_type = left.schema[value_col].dataType
    key_fields = [left.schema[c] for c in keys]
    out_schema = T.StructType(key_fields + [
        T.StructField("seq", T.LongType()), T.StructField("kind", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("k", T.LongType()),
        T.StructField("priority", T.ArrayType(T.StringType())),
        T.StructField("value", T.ArrayType(value_type)),
    ])
    emitted = both.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_PairedSampler(k1, k2, m, value_type, keys),
        outputStructType=out_schema, outputMode="Append", timeMode="None")
    return emitted.select(*keys, "seq", "kind", "n", "k",
                          F.arrays_zip("priority", "value").alias("items"))


def run_paired_stream(left: DataFrame, right: DataFrame, keys, value_col, id_cols, order,
                        k1=10, k2=10, m=10, seed=0, out_dir: str | None = None,
                        checkpoint: str | None = None, state_partitions: int | None = None):
    """Run the paired stream to the end of its (availableNow) inputs into a parquet
    table; returns the table folder.

    The number of state partitions is fixed by the first run of a checkpoint;
    it defaults to the cluster's parallelism (one state store per core)."""
    spark = left.sparkSession
    out_dir = out_dir or shared_dir(spark, "paired-out")
    checkpoint = checkpoint or shared_dir(spark, "paired-ckpt")
    stream = paired_sample_stream(left, right, keys, value_col, id_cols, order, k1, k2, m, seed)
    # transformWithState keeps its state in column families, which only the
    # RocksDB state store has; both settings are recorded in the checkpoint
    settings = {
        "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
        PROVIDER_KEY: ROCKSDB_PROVIDER,
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        q = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_dir))
        q.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    if q.exception() is not None:
        raise q.exception()
    return out_dir
