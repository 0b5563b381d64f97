from pyspark.sql import functions as F

from helpers import draw as py_draw
from helpers import md5_hex
from kpool.functions.tags import draw, hex_threshold, row_priority


def test_priority_matches_python_md5(spark):
    df = spark.range(1, 50).withColumnRenamed("id", "x")
    got = {r.x: r.p for r in df.select("x", row_priority(df, 7, ["x"]).alias("p")).collect()}
    assert all(got[x] == md5_hex(7, x) for x in range(1, 50))


def test_null_identity_has_fixed_text(spark):
    df = spark.createDataFrame([(None,), (1,)], "x bigint")
    got = [r.p for r in df.select(row_priority(df, 3, ["x"]).alias("p")).collect()]
    assert md5_hex(3, None) in got


def test_draw_matches_python_and_is_in_range(spark):
    df = spark.range(1, 300).withColumnRenamed("id", "n")
    rows = df.select("n", draw(5, "x", F.col("n"), bound=F.col("n")).alias("d")).collect()
    for r in rows:
        assert r.d == py_draw(5, "x", r.n, bound=r.n)
        assert 0 <= r.d < r.n


def test_double_identity_rejected(spark):
    import pytest

    df = spark.createDataFrame([(1.5,)], "x double")
    with pytest.raises(ValueError):
        row_priority(df, 1, ["x"])


def test_hex_threshold_monotone():
    assert hex_threshold(0.5) < hex_threshold(0.6) < "ffffffffffffffffffffffffffffffff"
    assert hex_threshold(1.0) > "f" * 32
