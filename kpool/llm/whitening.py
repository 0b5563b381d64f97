"""Embedding whitening by spectrum slicing.

An entry c becomes the integer x = floor(1024 c) + 100000.  The covariance V of
the x-vectors is summed in tasks from centred vectors; what reaches the driver
is one d x d matrix.  Its leading eigenvalues are found by counting: the signs
of the pivots of an LDL^T factorisation of V - s I (Bunch-Kaufman pivoting) say
how many eigenvalues lie above s.  Bisection on these counts isolates each
eigenvalue, Rayleigh quotient iteration sharpens it with its vector, and counts
on both sides of the result certify its number.  Eigenvalues closer to each
other than rounding are one cluster; any orthonormal vectors of its space serve.

Defined cases
-------------
* Vectors that are null, or hold a null or non-finite entry, take no part, nor
  do those with an x of 2^62 or more in size (beyond exact sums of longs).
* Vectors must agree in length: those of another length than the commonest
  (ties: the longer) take no part, as no covariance joins them to the others.
  An empty vector has no component and thus no row.
* Repeated rows, null and repeated ids all count and come out as they are.
* Components whose eigenvalue is zero to rounding do not exist (nothing can be
  divided by their deviation): one vector, or equal vectors, give no rows, as
  does an empty table.  There are at most as many as dimensions.
* Columns of the input that are not in ``keep`` are not read, whatever their
  names; a name in ``keep`` that the result uses itself raises ``ValueError``.
* Long texts do not occur; vectors of any length work, a d x d matrix of doubles
  is held by each task and the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpool.llm._io import Scratch, ship

SCALE, SHIFT = 1024, 100_000  # fixed values: x = floor(1024 c) + 100000
LIMIT = float(1 << 62)
ENTRIES = 1 << 21  # entries handled at once in a task
EPS = float(np.finfo(np.float64).eps)
OUT = ("component", "n", "deviation", "deviation_text", "whitened", "explained", "identity_error")


def blocks(column: pa.Array):
    """(row numbers, x-vectors) of the rows that take part, by length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.list_(pa.float64()))
    ends = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    scaled = np.floor(values * float(SCALE))
    fine = np.isfinite(values) & (np.abs(scaled) < LIMIT)
    bad_before = np.concatenate([[0], np.cumsum(~fine)])
    present = np.asarray(column.is_valid())
    good = np.flatnonzero(present & (bad_before[ends[1:]] == bad_before[ends[:-1]]))
    lengths = ends[good + 1] - ends[good]
    for length in np.unique(lengths):
        rows = good[lengths == length]
        step = max(1, ENTRIES // max(int(length), 1))
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            yield part, scaled[ends[part][:, None] + np.arange(length)].astype(np.int64) + SHIFT


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python integers, in two halves that cannot overflow."""
    high, low = x >> 31, x & ((1 << 31) - 1)
    return [(int(h) << 31) + int(l) for h, l in zip(high.sum(axis=0), low.sum(axis=0))]


def _sums(batches):
    """One row (length, place, count, sum) per length and place of a task; place -1 carries the count."""
    count: dict[int, int] = {}
    total: dict[int, list[int]] = {}
    for batch in batches:
        for rows, x in blocks(batch.column(0)):
            d = x.shape[1]
            count[d] = count.get(d, 0) + len(rows)
            total[d] = [a + b for a, b in zip(total.get(d, [0] * d), exact_sums(x))]
    rows = [(d, -1, c, 0) for d, c in count.items()] + [(d, j, 0, s) for d, sums in total.items() for j, s in enumerate(sums)]
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
         pa.array([str(s) for s in columns[3]], pa.string())], names=["d", "j", "n", "s"])


class Centre:
    """n x-vectors with sums S per dimension: x - S / n as a small integer and a remainder."""

    def __init__(self, n: int, sums: Sequence[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s - n * (s // n) for s in sums]
        self.mean = np.array([r / n for r in self.rest])

    def shifted(self, x: np.ndarray) -> np.ndarray:
        """x - floor(S / n): exact, as both are far below 2^63."""
        return x - self.whole

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.shifted(x).astype(np.float64) - self.mean

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums over dimensions of (n x - S)^2, exact: with y = x - floor(S / n)
        and r = S mod n that is n^2 y.y - 2 n y.r + r.r."""
        y, n, rest = self.shifted(x), self.n, self.rest
        most = int(np.abs(y).max(initial=0)) + 1
        if most * max(most, n) * max(len(rest), 1) < 1 << 62:
            square, cross = (y * y).sum(axis=1).tolist(), (y @ np.array(rest, np.int64)).tolist()
        else:
            y = y.astype(object)
            square, cross = (y * y).sum(axis=1).tolist(), (y @ np.array(rest, object)).tolist()
        own = sum(r * r for r in rest)
        return [n * n * a - 2 * n * b + own for a, b in zip(square, cross)]


def _gram(centre: Centre, d: int):
    def task(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for _, x in blocks(batch.column(0)):
                if x.shape[1] == d:
                    y = centre.centred(x)
                    total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])
    return task


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: the positive
    pivots of an LDL^T factorisation of matrix - shift I, by Sylvester's law."""
    m = matrix - shift * np.eye(len(matrix))
    alpha = (1 + math.sqrt(17)) / 8  # bounds the growth of the entries
    k, size, positive = 0, len(m), 0

    def swap(a: int, b: int) -> None:
        m[[a, b]] = m[[b, a]]
        m[:, [a, b]] = m[:, [b, a]]

    while k < size:
        pivot = abs(m[k, k])
        column = np.abs(m[k + 1:, k])
        far = float(column.max(initial=0.0))
        if max(pivot, far) == 0.0:
            k += 1
            continue
        two = False
        if pivot < alpha * far:
            r = k + 1 + int(column.argmax())
            line = np.abs(m[r, k:])
            line[r - k] = 0.0
            other = float(line.max())
            if pivot * other < alpha * far * far:
                if abs(m[r, r]) >= alpha * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:  # a 2 x 2 pivot has one eigenvalue on each side
            positive += 1
            c = m[k + 2:, k:k + 2]
            m[k + 2:, k + 2:] -= c @ np.linalg.solve(m[k:k + 2, k:k + 2], c.T)
            k += 2
        else:
            positive += m[k, k] > 0
            c = m[k + 1:, k]
            m[k + 1:, k + 1:] -= np.outer(c / m[k, k], c)
            k += 1
    return int(positive)


class Slices:
    """The leading eigenpairs of a symmetric matrix by counts above shifts."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = (matrix + matrix.T) / 2
        self.size = len(matrix)
        radius = np.abs(self.matrix).sum(axis=1) - np.abs(np.diag(self.matrix))
        self.top = float((np.diag(self.matrix) + radius).max())
        self.bottom = float((np.diag(self.matrix) - radius).min())
        scale = max(abs(self.top), abs(self.bottom))
        self.tiny = 4 * self.size * EPS * scale  # eigenvalues closer than this cannot be told apart
        self.counts = {self.bottom - self.tiny: self.size, self.top + self.tiny: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def bracket(self, number: int) -> tuple[float, float]:
        """The closest shifts known to have the ``number``-th largest eigenvalue between them."""
        low = max(s for s, c in self.counts.items() if c >= number)
        high = min(s for s, c in self.counts.items() if c < number and s > low)
        return low, high

    def solve(self, shift: float, x: np.ndarray) -> np.ndarray:
        while True:
            try:
                y = np.linalg.solve(self.matrix - shift * np.eye(self.size), x)
                if np.isfinite(y).all():
                    return y
            except np.linalg.LinAlgError:
                pass
            shift += self.tiny  # exactly singular

    @staticmethod
    def unit(x: np.ndarray, found: np.ndarray) -> np.ndarray:
        for _ in range(2):  # twice is enough
            x = x - found.T @ (found @ x)
        return x / np.linalg.norm(x)

    def sharpen(self, low: float, high: float, found: np.ndarray) -> tuple[float, np.ndarray]:
        """Rayleigh quotient iteration from the middle of a bracket, orthogonal to ``found``."""
        start = np.random.default_rng(len(found) + 1).standard_normal(self.size)
        x = self.unit(start, found)
        value = (low + high) / 2
        for _ in range(3):  # a vector of this bracket first
            x = self.unit(self.solve(value, x), found)
        best = (math.inf, value, x)
        for _ in range(40):
            value = float(x @ self.matrix @ x)
            rest = float(np.linalg.norm(self.matrix @ x - value * x))
            if rest >= best[0]:
                break
            best = (rest, value, x)
            if rest == 0.0:
                break
            x = self.unit(self.solve(value, x), found)
        return best[1], best[2]

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(eigenvalues, vectors as rows) of up to ``most`` components, the largest
        first, leaving out those that are zero to rounding."""
        values: list[float] = []
        found = np.zeros((0, self.size))
        if not self.tiny:  # a zero matrix
            return np.array(values), found
        for number in range(1, min(most, self.size) + 1):
            while True:
                low, high = self.bracket(number)
                alone = self.count(low) == number and self.count(high) == number - 1
                if high - low > 2 * self.tiny and not alone:
                    self.count((low + high) / 2)
                    continue
                value, x = self.sharpen(low, high, found)
                if low - self.tiny <= value <= high + self.tiny:
                    if self.count(value + self.tiny) < number <= self.count(value - self.tiny):
                        break
                if high - low <= 2 * self.tiny:
                    raise ArithmeticError(f"eigenvalue {number} cannot be certified between {low} and {high}")
                self.count((low + high) / 2)  # it went to a neighbour: closer bounds
            if value <= self.tiny:
                break
            values.append(value)
            found = np.vstack([found, x])
        return np.array(values), found


def _project(centre: Centre, d: int, matrix: np.ndarray, keep: int):
    """Rows that take part, with their exact deviation and their whitened vector."""
    def task(batches):
        for batch in batches:
            for rows, x in blocks(batch.column(keep)):
                if x.shape[1] != d:
                    continue
                exact = centre.deviations(x)
                index = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).take(index) for i in range(keep)]
                    + [pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()), pa.array([str(v) for v in exact], pa.string()),
                       pa.array(list(centre.centred(x) @ matrix), pa.list_(pa.float64()))],
                    names=[*batch.schema.names[:keep], "deviation", "deviation_text", "w"])
    return task


def covariance(df: DataFrame, vector: str = "embedding") -> tuple[Centre, np.ndarray] | None:
    """Counts and sums, and the covariance matrix (divisor n) of the x-vectors;
    None where no vector takes part."""
    ship(df.sparkSession)
    vectors = df.select(F.col(vector).cast("array<double>").alias("v"))
    sums = vectors.mapInArrow(_sums, "d int, j int, n long, s string") \
        .groupBy("d", "j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    scratch = Scratch()
    sums = scratch.write(sums, "whitening-sums")
    most = sums.filter("j = -1 AND d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        scratch.drop()
        return None
    d = most["d"]
    places = {r["j"]: int(r["s"]) for r in sums.filter((F.col("d") == d) & (F.col("j") >= 0)).collect()}
    scratch.drop()
    centre = Centre(most["n"], [places[j] for j in range(d)])
    cells = vectors.mapInArrow(_gram(centre, d), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v")) \
        .groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((d, d))
    table = cells.toArrow()
    total[table["i"].to_numpy(), table["j"].to_numpy()] = table["v"].to_numpy()
    return centre, total / centre.n


def whiten(df: DataFrame, vector: str = "embedding", keep: Sequence[str] = ("vec_id",), components: int = 8) -> DataFrame:
    """One row per vector and component: ``keep...``, ``component`` (from 1, by
    falling eigenvalue), ``n``, ``deviation`` (sum over dimensions of
    (n x - S)^2; null where it does not fit a long, ``deviation_text`` always
    has its digits), ``whitened``, ``explained`` (share of the trace) and
    ``identity_error`` (largest entry of the whitened covariance minus the
    identity, measured on the result).  For the cases see the module.
    """
    spark = df.sparkSession
    keep = list(keep)
    if {c.lower() for c in keep} & {*OUT, "w"}:
        raise ValueError(f"columns to keep may not be called {', '.join((*OUT, 'w'))}")
    kept = [df.schema[c] for c in keep]
    result = T.StructType([*kept, T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("deviation_text", T.StringType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    fitted = covariance(df, vector)
    if fitted is None:
        return spark.createDataFrame([], result)
    centre, matrix = fitted
    values, vectors = Slices(matrix).leading(components)
    if not len(values):
        return spark.createDataFrame([], result)
    trace = float(np.trace(matrix))
    shape = T.StructType([*kept, T.StructField("deviation", T.LongType()), T.StructField("deviation_text", T.StringType()),
                          T.StructField("w", T.ArrayType(T.DoubleType()))])
    task = _project(centre, len(matrix), vectors.T / np.sqrt(values), len(keep))
    rows = df.select(*keep, F.col(vector).cast("array<double>").alias("w")).mapInArrow(task, shape)
    rows = Scratch().write(rows, "whitened")  # read by the check and by the result
    pairs = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
    found = rows.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    shares = F.array(*[F.lit(float(v) / trace) for v in values])
    return rows.select(*keep, F.lit(centre.n).cast("long").alias("n"), "deviation", "deviation_text", F.posexplode("w").alias("_at", "whitened")) \
        .select(*keep, (F.col("_at") + 1).cast("int").alias("component"), "n", "deviation", "deviation_text", "whitened",
                shares[F.col("_at")].alias("explained"), F.lit(float(error)).alias("identity_error"))
