"""Connected components of links between long ids, by alternating large-star
and small-star steps (every node points to the least node it sees)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpool.llm._io import cut


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one link for each node but the least of its component."""
    if not len(a):
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links``; root is the least node of its
    component.  Links with a null end or equal ends count for nothing.

    Each round writes the links to the shared folder.  Neighbour minima are
    grouped aggregates, so a node with very many links is combined before the
    shuffle.  Raises if ``max_rounds`` do not suffice.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = cut(links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u, v).distinct())
    size = edges.count()
    if not size:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    mark = None
    for _ in range(max_rounds):
        # large star: larger neighbours of u link to the least of u and its neighbours
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        # small star: u and its smaller neighbours link to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))).distinct()
        edges = cut(small)
        new = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
