"""Approximate nearest neighbours by inner product over sharded graphs.

Equal vectors become one node that keeps its ``k + 1`` least ids (all that a
top-k can hold), so a vector shared by a third of all rows is one node.  Nodes
are dealt to shards of about ``shard_size`` by bands of their norm (a factor of
1.1 each) and by hash.  In each shard a task builds a directed graph: nodes
arrive in growing batches, a greedy beam search over the graph so far proposes
neighbours, and relaxed (``alpha``) distance pruning keeps diverse ones; edges
back are pruned the same way.  Inner products are turned into distances by one
more coordinate that gives all vectors of a shard the same norm; in a narrow
band that coordinate is small and hides no direction.

Queries search the longest bands first (as many as hold ``shard_size`` nodes).
No inner product exceeds the product of the norms, so a query then goes on only
to shards whose longest vector could still beat its k-th score.  Shards and the
queries that visit them meet in sorted partitions: a task holds one graph and
reads its queries one after another, and a shard is sent once per ``block_size``
queries.  The best of each shard, scored in double precision, are merged by one
window per query.

Every row is indexed.  Recall against brute force is tested (at least 0.9), for
vectors of one norm and of norms that differ.

Defined cases: null, empty or zero vectors, vectors that hold a null, NaN or
infinity, and rows without an id take no part.  Of several vectors under one id
each is indexed and each asks; an id counts with its best score, and an id is no
neighbour of itself.  Vectors meet only those of their length, of any size.
Ties go to the smaller id.  Repeated rows count once.  Other columns are not
read, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from kpool.llm._io import cut, ship

DEGREE, ALPHA, BUILD_BEAM, SEARCH_BEAM, EXPAND, ENTRIES = 48, 1.2, 64, 192, 4, 16
BAND = 1.1                # longest norm of a band over its shortest
MAX_PARTS = 20_000        # of the work on graphs
MAX_SHARDS = 1_000_000    # most shards whose (number, norm) are broadcast


def _scaled(x: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``x`` over the power of two just above ``top``, and that power's exponent."""
    exponent = np.frexp(top)[1]
    return np.ldexp(x, -exponent), exponent


class Graph:
    def __init__(self, vectors: np.ndarray, neighbours: np.ndarray | None = None, degree: int = DEGREE):
        vectors = _scaled(vectors, np.abs(vectors).max())[0]
        norms = np.einsum("ij,ij->i", vectors, vectors)
        scale = math.sqrt(norms.max()) or 1.0
        lift = np.sqrt(np.maximum(0.0, 1 - norms / scale**2))
        self.x = np.column_stack([vectors / scale, lift]).astype(np.float32)  # unit norm: distance^2 = 2 - 2 <x, y>
        self.n, self.degree = len(self.x), degree
        middle = int(np.argmax(self.x @ self.x.mean(axis=0)))
        spread = np.linspace(0, self.n - 1, min(self.n, ENTRIES)).astype(int)
        self.entries = np.arange(self.n) if self.n <= SEARCH_BEAM else np.unique(np.append(spread, middle))
        if neighbours is None:
            self.neighbours = np.full((self.n, degree), -1, np.int32)
            self._build()
        else:
            self.neighbours = neighbours

    def search(self, queries: np.ndarray, beam: int, entries: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the best ``beam`` found, -1 where fewer;
        ``queries`` have one coordinate more, 0 for outside vectors."""
        q = len(queries)
        entries = self.entries if entries is None else entries
        beam = max(beam, len(entries))
        ids = np.full((q, beam), -1, np.int32)
        sims = np.full((q, beam), -np.inf, np.float32)
        ids[:, :len(entries)] = entries
        sims[:, :len(entries)] = queries @ self.x[entries].T
        seen = np.zeros((q, self.n + 1), bool)  # the last column stands for "no node"
        seen[:, entries] = seen[:, -1] = True
        done = ids < 0
        live = np.arange(q)
        while len(live):
            todo = np.where(done[live], -np.inf, sims[live])
            pick = np.argpartition(-todo, min(EXPAND, beam - 1), axis=1)[:, :EXPAND]
            open_ = np.take_along_axis(todo, pick, 1) > -np.inf
            going = open_.any(axis=1)
            live, pick, open_ = live[going], pick[going], open_[going]
            if not len(live):
                break
            rows = live[:, None]
            done[rows, pick] = True
            near = np.where(open_[..., None], self.neighbours[ids[rows, pick]], -1).reshape(len(live), -1)
            order = np.sort(near, axis=1)  # one node may be met through several
            order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
            order[seen[rows, order]] = -1
            seen[rows, order] = True
            order = -np.sort(-order, axis=1)
            order = order[:, :max(1, int((order >= 0).sum(axis=1).max()))]
            found = np.einsum("qrd,qd->qr", self.x[order], queries[live], optimize=True)
            found[order < 0] = -np.inf
            all_sims = np.concatenate([sims[live], found], axis=1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            sims[live] = np.take_along_axis(all_sims, best, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], found == -np.inf], axis=1), best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], order], axis=1), best, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """For each node up to ``degree`` of its candidates (-1: none): the
        nearest stays, and those it is ``ALPHA`` times nearer to than the node go."""
        xs = self.x[candidates]
        to_node = 2 - 2 * np.einsum("qmd,qd->qm", xs, self.x[nodes], optimize=True)
        between = 2 - 2 * np.matmul(xs, xs.transpose(0, 2, 1))
        to_node[(candidates < 0) | (candidates == nodes[:, None])] = np.inf
        out, rows = np.full((len(nodes), self.degree), -1, np.int32), np.arange(len(nodes))
        alive = to_node.copy()
        for j in range(self.degree):
            best = alive.argmin(axis=1)
            some = alive[rows, best] < np.inf
            if not some.any():
                break
            out[some, j] = candidates[rows, best][some]
            covered = ALPHA**2 * between[rows, best] <= to_node
            alive[covered & some[:, None]] = np.inf
            alive[rows, best] = np.inf
        return out

    def _build(self) -> None:
        order = np.random.default_rng(0).permutation(self.n)
        first = order[:min(self.n, self.degree + 1)]
        for i in first:  # the first few all know each other
            others = first[first != i]
            self.neighbours[i, :len(others)] = others
        at, entries = len(first), first[:ENTRIES]
        while at < self.n:
            batch = order[at:at + min(max(len(first), at), 512)]
            ids, _ = self.search(self.x[batch], BUILD_BEAM, entries)
            self.neighbours[batch] = self.prune(batch, ids)
            source = np.repeat(batch, self.degree)
            target = self.neighbours[batch].ravel()
            self._link_back(target[target >= 0], source[target >= 0])
            at += len(batch)

    def _link_back(self, to: np.ndarray, new: np.ndarray) -> None:
        order = np.argsort(to, kind="stable")
        to, new = to[order], new[order]
        nth = np.arange(len(to)) - np.searchsorted(to, to)
        for low in range(0, int(nth.max(initial=-1)) + 1, self.degree):  # at most ``degree`` new edges of a node at a time
            now = (nth >= low) & (nth < low + self.degree)
            nodes, row = np.unique(to[now], return_inverse=True)
            wide = np.full((len(nodes), 2 * self.degree), -1, np.int32)
            wide[:, :self.degree] = self.neighbours[nodes]
            wide[row, self.degree + nth[now] - low] = new[now]
            free = (wide >= 0).sum(axis=1) <= self.degree
            self.neighbours[nodes[free]] = -np.sort(-wide[free], axis=1)[:, :self.degree]
            for i in range(0, int((~free).sum()), 512):
                part = np.flatnonzero(~free)[i:i + 512]
                self.neighbours[nodes[part]] = self.prune(nodes[part], wide[part])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _scores(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of (q, m, d) and (q, d); where partial sums overflow, by scaled vectors."""
    with np.errstate(over="ignore", invalid="ignore"):
        scores = np.einsum("qmd,qd->qm", vectors, queries, optimize=True)
        wrong = ~np.isfinite(scores)
        if wrong.any():
            q, m = np.nonzero(wrong)
            (x, a), (y, b) = (_scaled(v, np.abs(v).max(axis=1, keepdims=True)) for v in (vectors[q, m], queries[q]))
            scores[q, m] = np.ldexp(np.einsum("nd,nd->n", x, y), (a + b)[:, 0])
    return scores


NODE = "dim int, shard long, node int, ids array<long>, v array<double>, edges array<int>"


def build_index(nodes: DataFrame) -> DataFrame:
    """``nodes`` (dim, shard, ids, v) with their place in the shard and their edges."""

    def build(table: pa.Table) -> pa.Table:
        graph = Graph(_matrix(table.column("v")))
        edges = pa.ListArray.from_arrays(pa.array(np.arange(0, graph.neighbours.size + 1, graph.degree, dtype=np.int32)), pa.array(graph.neighbours.ravel()))
        return pa.table({"dim": table.column("dim"), "shard": table.column("shard"), "node": pa.array(np.arange(graph.n, dtype=np.int32)),
                         "ids": table.column("ids").cast(pa.list_(pa.int64())), "v": table.column("v").cast(pa.list_(pa.float64())), "edges": edges})

    return nodes.groupBy("dim", "shard").applyInArrow(build, NODE)


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _answers(graph: Graph, vectors: np.ndarray, ids: list, asked: np.ndarray, names: list, k: int, beam: int):
    """The ``k`` best ids of one shard for each query."""
    for i in range(0, len(asked), 512):
        some, out = asked[i:i + 512], [[], [], []]
        unit = _scaled(some, np.abs(some).max(axis=1, keepdims=True))[0]
        found, _ = graph.search(np.column_stack([unit, np.zeros(len(some))]).astype(np.float32), max(beam, 2 * k + 2))
        exact = _scores(vectors[found], some)
        exact[found < 0] = -np.inf
        for q, row, score in zip(names[i:i + 512], found, exact):
            got, have = [], {q}
            order = [j for j in np.argsort(-score, kind="stable").tolist() if row[j] >= 0]
            for a, j in enumerate(order):
                got += [(float(score[j]), v) for v in ids[row[j]] if v not in have]
                have.update(ids[row[j]])
                if len(got) >= k and (a + 1 == len(order) or score[order[a + 1]] < score[j]):
                    break  # nodes of one score stay together: ties go by id
            got.sort(key=lambda g: (-g[0], g[1]))
            for s, v in got[:k]:
                out[0].append(q)
                out[1].append(v)
                out[2].append(s)
        yield pa.RecordBatch.from_arrays([pa.array(o, f.type) for o, f in zip(out, FOUND)], schema=FOUND)


def _search(k: int, beam: int):
    def task(batches):
        """Sorted rows: the nodes of a shard (in order), then its queries, then the next shard."""
        where, parts, ready = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            marks = np.column_stack([table.column(c).to_numpy() for c in ("dim", "shard", "block", "kind")])
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(marks)]):
                part, (dim, shard, block, kind) = table.slice(begin, end - begin), marks[begin].tolist()
                if where != (dim, shard, block):
                    where, parts, ready = (dim, shard, block), [], None
                if not kind:
                    parts.append(part)
                    continue
                if ready is None and parts:
                    nodes = pa.concat_tables(parts)
                    vectors = _matrix(nodes.column("v"))
                    ready, parts = (Graph(vectors, _matrix(nodes.column("edges")).astype(np.int32)), vectors, nodes.column("ids").to_pylist()), []
                if ready is not None:
                    yield from _answers(*ready, _matrix(part.column("v")), part.column("id").to_pylist(), k, beam)
    return task


def search_index(index: DataFrame, visits: DataFrame, k: int, block_size: int = 1 << 18, beam: int = SEARCH_BEAM, parts: int | None = None) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` best of the shards that queries visit
    (``visits``: dim, shard, id, v), in ``parts`` partitions."""
    blocks = visits.groupBy("dim", "shard").agg(F.ceil(F.count("*") / block_size).cast("int").alias("blocks"))
    nothing = F.lit(None)
    nodes = index.join(blocks, ["dim", "shard"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("dim", "shard", "block", F.lit(0).alias("kind"), "node", "ids", "v", "edges", nothing.cast("long").alias("id"))
    block = F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int")
    asked = visits.join(blocks, ["dim", "shard"]) \
        .select("dim", "shard", block.alias("block"), F.lit(1).alias("kind"), nothing.cast("int").alias("node"), nothing.cast("array<long>").alias("ids"), "v",
                nothing.cast("array<int>").alias("edges"), "id")
    where = ("dim", "shard", "block")
    rows = nodes.unionByName(asked)
    rows = (rows.repartition(*where) if parts is None else rows.repartition(parts, *where)).sortWithinPartitions("dim", "shard", "block", "kind", "node")
    return rows.mapInArrow(_search(k, beam), "query_id long, vec_id long, score double")


def valid_vectors(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Distinct (id, v) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).filter(fit)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()


def log_norm(v: Column) -> Column:
    """log2 of a vector's norm, for norms beyond a double as well."""
    top = F.array_max(F.transform(v, F.abs))
    squares = F.aggregate(v, F.lit(0.0), lambda total, x: total + (x / top) * (x / top))
    return F.log2(top) + F.log2(squares) / 2


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, shard_size: int = 8192, id_col: str = "vec_id", vector: str = "embedding",
            beam: int = SEARCH_BEAM) -> DataFrame:
    """The ``k`` nearest of every vector whose id is divisible by ``every``:
    query_id, rank, vec_id, score."""
    ship(vectors.sparkSession)
    rows = cut(valid_vectors(vectors, id_col, vector))
    same = W.partitionBy("v").orderBy("id")
    least = rows.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1)  # cut before the shuffle as well
    nodes = least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = nodes.select(F.size("v").alias("dim"), "ids", "v", log_norm(F.col("v")).alias("norm"))
    # norm 1 lies in the middle of a band
    nodes = cut(nodes.withColumn("band", F.floor(F.col("norm") / math.log2(BAND) + 0.5)))
    bands = nodes.groupBy("dim", "band").agg(F.count("*").alias("n"))  # at most 15 500 a length
    longer = W.partitionBy("dim").orderBy(F.desc("band")).rowsBetween(W.unboundedPreceding, -1)
    bands = bands.select("dim", "band", F.ceil(F.col("n") / shard_size).alias("shards"),
                         (F.coalesce(F.sum("n").over(longer), F.lit(0)) < shard_size).alias("lead"))
    shard = F.col("band") * (1 << 32) + F.pmod(F.xxhash64("v"), F.col("shards"))
    nodes = nodes.join(bands, ["dim", "band"]).select("dim", shard.alias("shard"), "ids", "v", "norm", "lead")
    shards = cut(nodes.groupBy("dim", "shard").agg(F.max("norm").alias("top"), F.first("lead").alias("lead"), F.count("*").alias("n")))
    if shards.count() <= MAX_SHARDS:
        shards = F.broadcast(shards)
    # a graph is much work for few bytes: its partitions are not for the optimizer to join
    parts = min(MAX_PARTS, 2 * math.ceil(max(1, shards.agg(F.sum("n")).first()[0] or 0) / shard_size))
    index = cut(build_index(nodes.select("dim", "shard", "ids", "v").repartition(parts, "dim", "shard")))
    asked = rows.filter(F.col("id") % every == 0).select("id", "v", F.size("v").alias("dim"))
    first = cut(search_index(index, asked.join(shards.filter("lead"), "dim").select("dim", "shard", "id", "v"), k, beam=beam, parts=parts))
    # the k-th score so far: what the other shards' longest vectors have to beat
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = first.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    bound = once.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    open_ = asked.join(bound, "id", "left").join(shards.filter("NOT lead"), "dim")
    could = F.col("top") + log_norm(F.col("v")) + 1e-6 >= F.least(F.log2("kth"), F.lit(1024.0))  # null: no k-th score, or none above zero
    rest = open_.filter(F.coalesce(could, F.lit(True)) | (F.col("kth") <= 0)).select("dim", "shard", "id", "v")
    found = first.union(search_index(index, cut(rest), k, beam=beam, parts=parts))
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
