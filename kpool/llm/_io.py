"""Lineage cuts and scratch tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpool.session import ensure_checkpoint_dir, shared_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let executors import this package: once a Spark application, it is added
    as a Python file, unless PYTHONPATH (which workers inherit) holds it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if root in known or app in _SHIPPED:
        return
    folder = tempfile.mkdtemp(prefix="kpool-package-")  # the driver serves the file as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    tree = os.path.join(folder, "tree")
    shutil.copytree(os.path.join(root, "kpool"), os.path.join(tree, "kpool"), ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "kpool-package"), "zip", tree))
    _SHIPPED.add(app)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a reliable checkpoint in ``spark.checkpoint.dir``.
    For narrow tables (ids, counts, links); tables with texts use ``Scratch``."""
    ship(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str):
    """A fresh folder in the shared folder, deleted when the driver's JVM ends:
    its path, and the file system and path object that delete it earlier."""
    path = shared_dir(spark, name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)  # only what exists can be registered
    files.deleteOnExit(where)
    return path, files, where


class Scratch:
    """Tables computed once, as compressed Parquet in the shared folder, until
    ``drop``; those left are deleted when the driver's JVM ends.  For tables
    with texts or arrays, which checkpoints would store uncompressed."""

    def __init__(self) -> None:
        self.places: list = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        spark = df.sparkSession
        ship(spark)
        path, files, where = scratch_folder(spark, name)
        df.write.mode("overwrite").parquet(path)
        self.places.append((files, where))
        return spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Only once nothing that reads the tables will run any more."""
        for files, where in self.places:
            files.delete(where, True)
        self.places = []


def fresh(columns: list[str], name: str) -> str:
    """``name``, with as many underscores as make it differ from all columns."""
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text column; a null text is an empty one."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary"))


def running_start(df: DataFrame, order: str, amount: str, start: str, width: int = 1024) -> DataFrame:
    """Add ``start``: the sum of ``amount`` over all rows of smaller ``order``.

    ``order`` holds distinct integers from 0 (shard numbers).  Sums run inside
    blocks of ``width`` shards and over the blocks, so no task holds more than
    ``width`` shards or one row per block.
    """
    from pyspark.sql import Window as W

    block = (F.col(order) / width).cast("long")
    inner = W.partitionBy("_block").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy("_super").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    top = W.partitionBy(F.lit(0)).orderBy("_super").rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("_block", block)
    blocks = (df.groupBy("_block").agg(F.sum(amount).alias("_sum"))
              .withColumn("_super", (F.col("_block") / width).cast("long")))
    supers = (blocks.groupBy("_super").agg(F.sum("_sum").alias("_ssum"))
              .withColumn("_sbase", F.coalesce(F.sum("_ssum").over(top), F.lit(0))).select("_super", "_sbase"))
    bases = (blocks.withColumn("_bbase", F.coalesce(F.sum("_sum").over(outer), F.lit(0)))
             .join(supers, "_super").select("_block", (F.col("_bbase") + F.col("_sbase")).alias("_base")))
    return (df.withColumn(start, F.coalesce(F.sum(amount).over(inner), F.lit(0)))
            .join(bases, "_block").withColumn(start, (F.col(start) + F.col("_base")).cast(T.LongType()))
            .drop("_block", "_base"))
