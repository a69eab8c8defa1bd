"""Search trees grown over a whole table in rounds, and the comparison of their leaves."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import stored

#: Rows that a task splits in a round.
DEAL = 50_000
#: Levels that one round adds: each round is one aggregate and one pass over the rows.
ROUND = 4


def grow(
    rows: DataFrame,
    measure: Callable[[int], Column],
    left_reach: Column,
    right_reach: Column,
    leaf: int,
    levels: int,
) -> DataFrame:
    """Split the nodes of ``rows`` (``tree``, ``node``, ...) at their medians until they fit a leaf.

    ``measure(level)`` is what a level splits by. A row goes left if it is at most the median
    plus ``left_reach``, right if it is above the median less ``right_reach``, and to both
    sides in between, so that two rows whose measures differ by no more than both reaches
    together share a side. Nodes of at most ``leaf`` rows are left as they are; after
    ``levels`` levels the rest is, whatever its size. Returns the rows with their final nodes.
    """
    done, active, level = [], rows.withColumn("node", F.lit(1).cast("long")), 0
    while True:
        steps = min(ROUND, levels - level)
        if steps <= 0:
            done.append(active)
            break
        cuts = [
            F.percentile_approx(measure(level + k), 0.5, 1000).alias(f"_cut{k}") for k in range(steps)
        ]
        sizes = active.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("_n"), *cuts)
        large = stored(sizes.where(F.col("_n") > leaf), "nodes")
        done.append(active.join(large, ["tree", "node"], "left_anti").select(active.columns))
        if large.isEmpty():
            break
        nodes = F.array("node")
        for k in range(steps):
            value, cut = measure(level + k), F.col(f"_cut{k}")
            left, right = value <= cut + left_reach, value > cut - right_reach
            nodes = F.flatten(F.transform(nodes, _children(left, right)))
        # A few small files would be read by a few tasks: rows are dealt out before they multiply.
        total = large.agg(F.sum("_n")).first()[0]
        dealt = active.join(large, ["tree", "node"]).repartition(max(1, -(-total // DEAL)))
        split = dealt.withColumn("_nodes", nodes)
        kept = [c for c in active.columns if c != "node"]
        active = stored(split.select(*kept, F.explode("_nodes").alias("node")), "split")
        level += steps
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def _children(left: Column, right: Column) -> Callable[[Column], Column]:
    """From a node to those of its two sides that a row goes to."""
    return lambda n: F.array_compact(F.array(F.when(left, n * 2), F.when(right, n * 2 + 1)))


def depth(n: int, leaf: int, shrink: float) -> int:
    """Levels for ``n`` rows when a level leaves the share ``shrink`` of a node, and a few more."""
    return 0 if n <= leaf else min(50, math.ceil(math.log(n / leaf) / -math.log(shrink)) + ROUND)


def blocks(leaves: DataFrame, key: str, block: int, weight: str | None = None, heaviest: int = 1) -> DataFrame:
    """Rows of leaves with ``first`` and ``second``: the pair of blocks that a task compares.

    A leaf of up to ``block`` rows (and, with ``weight``, whose weights add up to ``heaviest`` at
    most) is one block. A larger one, whose rows no split told apart, is cut into blocks by a
    hash of ``key``; each row goes to every pair its ``chunk`` is in, so all pairs of the leaf are
    compared and no task holds more than two blocks.
    """
    leaves = stored(leaves, "leaves")
    load = F.count(F.lit(1)) / F.lit(block)
    if weight is not None:
        load = F.greatest(load, F.sum(weight) / F.lit(heaviest))
    sizes = leaves.groupBy("tree", "node").agg(load.alias("_load"))
    large = sizes.where("_load > 1").select("tree", "node", F.ceil(F.col("_load") / 0.8).alias("_k"))
    large = stored(large, "large")
    chunks = F.coalesce(F.col("_k"), F.lit(1))
    cut = leaves.join(large, ["tree", "node"], "left").select(
        *leaves.columns,
        F.pmod(F.xxhash64(F.col(key), F.lit(7)), chunks).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int"))).alias("_other"),
    )
    return cut.select(
        *leaves.columns,
        "chunk",
        F.least("chunk", "_other").alias("first"),
        F.greatest("chunk", "_other").alias("second"),
    )
