"""Connected components of a link table, all of it in Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import scope, stored


def components(links: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of longs to rows ``(node, root)``: the smallest node each one reaches.

    Alternates two steps that turn the graph into stars around the smallest node of each
    component: every larger neighbour of a node moves to the node's smallest neighbour, then
    every smaller one does. The rounds needed grow with the logarithm of the longest path.
    Minima are partial aggregates and the joins start from stored tables, so a node with very
    many neighbours is split over tasks. Nodes without a link to another node are left out.
    """
    edges = stored(_edges(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    state = _state(edges)
    while state[0]:
        with scope(links.sparkSession):
            both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
            joined = both.join(stored(least, "least"), "u").where("v > u")
            far = stored(_edges(joined.select(F.col("v").alias("u"), F.col("low").alias("v"))), "far")
            low = stored(far.groupBy("u").agg(F.min("v").alias("low")), "low")
            near = far.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
            edges = stored(_edges(near.union(low.select("u", "low"))), "edges", keep=True)
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _edges(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of two nodes, the larger one first."""
    return pairs.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and checksum; both stay as they are once every component is a star."""
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links among a block of rows: the first row each one reaches."""
    roots = np.full(len(linked), -1)
    alone = np.flatnonzero(linked.sum(axis=1) <= linked.diagonal())
    roots[alone] = alone
    for start in np.flatnonzero(roots < 0):
        if roots[start] >= 0:
            continue
        front = np.array([start])
        roots[start] = start
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & (roots < 0))
            roots[front] = start
    return roots
