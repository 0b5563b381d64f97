"""Physical-plan properties the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from kpool.operators.merge import merge_summaries
from kpool.operators.sample import sample_k
from kpool.operators.summary import build_summary

BATCH = [n for n in entry.queries() if not n.startswith("stream")]


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_global_sample_is_take_ordered_and_prunes_columns(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    s = sample_k(li.select(*ids, "l_extendedprice"), 50, ids, strategy="window")
    assert "TakeOrderedAndProject" in _plan(s)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", _formatted(s))
    assert schemas and all("l_tax" not in x and "l_returnflag" not in x for x in schemas)


def test_merge_limits_items_before_the_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    summ = build_summary(ev, ["event_type", "user_id"], 5, "event_id", ["event_id"], seed=1)
    plan = _plan(merge_summaries(summ, ["event_type"], 5))
    assert "WindowGroupLimit" in plan


def test_stream_side_filters_reach_the_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter(F.col("event_type") == "click")
    s = sample_k(ev, 10, ["event_id"], strategy="window")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,click\)", _formatted(s))


def test_inclusion_audit_explodes_only_candidates(spark):
    from kpool.operators.audit import inclusion_top

    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    plan = _plan(inclusion_top(part, 20, ["p_partkey"], 100, part.count()))
    assert "Generate explode(filter(transform(" in plan  # only candidate (row, seed) pairs become rows
    assert re.search(r"WindowGroupLimit \[_seed#\d+\].*Partial", plan)
