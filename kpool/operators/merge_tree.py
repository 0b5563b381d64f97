"""A stored tree of summaries over buckets of time (A12).

Buckets (numbers, such as hours) are the leaves; node ``i`` of level ``l`` is the
exact merge of the buckets ``i * 2^l`` to ``(i + 1) * 2^l - 1``.  A range of buckets
is then the merge of at most two nodes a level, whatever its length, and equals the
sample drawn from the range's rows directly.

The table holds summary rows (``level, node, keys..., n, k, items``), one folder
per append.  An append summarises its rows by bucket and writes, for the buckets
and all nodes above them, their merge with what is stored: one path from each
bucket upwards.  The newest row of a node counts.  Appending the same ``append_id``
again rewrites its folder from the same earlier ones, so a repeated append changes
nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpool.operators.merge import merge_summaries
from kpool.operators.sample import DEFAULT_SIZE, check_size
from kpool.operators.summary import build_summary
from kpool.plans.layout import materialize

LEVEL, NODE, APPEND = "level", "node", "append"


def cover(begin: int, end: int, levels: int) -> list[tuple[int, int]]:
    """(level, node) of the fewest nodes that make up the buckets begin..end-1."""
    out = []
    level = 0
    while begin < end:
        if level == levels:
            out += [(level, i) for i in range(begin, end)]
            break
        if begin % 2:
            out.append((level, begin))
            begin += 1
        if end % 2 and begin < end:
            end -= 1
            out.append((level, end))
        begin, end, level = begin // 2, end // 2, level + 1
    return out


class MergeTree:
    """Summaries of size ``k`` (per ``keys``, if any) in ``folder``, in a tree of
    ``levels`` levels above the buckets."""

    def __init__(self, spark: SparkSession, folder: str, k: int = DEFAULT_SIZE, keys: Sequence[str] = (), levels: int = 20):
        check_size("k", k)
        check_size("levels", levels)
        self.spark, self.folder, self.k, self.keys, self.levels = spark, folder, k, list(keys), levels

    def _stored(self, before: int | None = None) -> DataFrame | None:
        """The newest row of each node (of the appends before ``before``)."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        done = [] if not files.exists(path) else [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
        done = sorted(int(d.split("=")[1]) for d in done if d.startswith(f"{APPEND}="))
        done = [i for i in done if files.exists(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{APPEND}={i}/_SUCCESS")) and (before is None or i < before)]
        if not done:
            return None
        rows = self.spark.read.option("basePath", self.folder).parquet(*[f"{self.folder}/{APPEND}={i}" for i in done])
        return rows

    def _newest(self, rows: DataFrame) -> DataFrame:
        newest = Window.partitionBy(LEVEL, NODE, *self.keys).orderBy(F.desc(APPEND))
        return rows.withColumn("_r", F.row_number().over(newest)).filter("_r = 1").drop("_r", APPEND)

    def append(self, df: DataFrame, bucket: str, value_cols, id_cols: Sequence, seed: int = 0, append_id: int = 0) -> None:
        """Add the rows of ``df`` (rows without a bucket are ignored; buckets are not
        negative).  Appends follow each other by ``append_id``."""
        rows = df.filter(F.col(bucket).isNotNull()).withColumn(NODE, F.col(bucket).cast("bigint"))
        leaves = materialize(build_summary(rows, [NODE, *self.keys], self.k, value_cols, id_cols, seed=seed))
        # every bucket's k items go to the nodes above it and are merged there, all levels in one plan
        level = F.explode(F.sequence(F.lit(0), F.lit(self.levels)))
        fresh = leaves.withColumn(LEVEL, level).withColumn(NODE, F.expr(f"shiftright({NODE}, {LEVEL})"))
        names = [LEVEL, NODE, *self.keys]
        fresh = fresh.select(*names, "n", "k", "items")
        stored = self._stored(append_id)
        if stored is not None:  # the nodes on the paths of the new buckets only
            touched = fresh.select(*names).distinct().alias("f")
            same = [F.col(f"o.{c}").eqNullSafe(F.col(f"f.{c}")) for c in names]
            old = self._newest(stored.alias("o").join(touched, same, "left_semi"))
            fresh = fresh.unionByName(old.select(*names, "n", "k", "items"))
        fresh = merge_summaries(fresh, names, self.k)
        fresh.select(*names, "n", "k", "items").write.mode("overwrite").parquet(f"{self.folder}/{APPEND}={append_id}")

    def between(self, begin: int, end: int, m: int | None = None) -> DataFrame:
        """The summary (``keys..., n, k, items``) of the buckets begin..end-1, of size
        ``m`` (at most ``k``, and by default ``k``)."""
        m = self.k if m is None else m
        check_size("m", m)
        stored = self._stored()
        if stored is None:
            raise ValueError(f"nothing has been appended to {self.folder} yet")
        nodes = cover(max(0, begin), max(0, end), self.levels)
        wanted = F.lit(False)
        for level in sorted({n[0] for n in nodes}):
            wanted = wanted | ((F.col(LEVEL) == level) & F.col(NODE).isin([n[1] for n in nodes if n[0] == level]))
        return merge_summaries(self._newest(stored.filter(wanted)), self.keys, m)
