"""Generated inputs, sized by the tables they are derived from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpool.functions.strings import random_string
from kpool.functions.tags import identity_parts
from kpool.plans.layout import spread


def integer_range(spark: SparkSession, start: int, end_inclusive: int,
                  num_partitions: int | None = None, name: str = "id") -> DataFrame:
    """Integers start..end (both ends included), split over partitions (S1)."""
    df = spark.range(start, end_inclusive + 1, 1, num_partitions)
    return df.withColumnRenamed("id", name) if name != "id" else df


def random_strings(df: DataFrame, id_cols: Sequence[str], seed: int, out: str = "text") -> DataFrame:
    """Adds a seeded random string (1-10 letters a-z) to every row (S3).

    Works on any batch or streaming DataFrame with an identity, e.g. a
    table, ``spark.range(N)`` or a ``rate`` stream (``value`` as id)."""
    parts = identity_parts(df, id_cols)
    ident = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return spread(df).withColumn(out, random_string(seed, ident))
