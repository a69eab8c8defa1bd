"""Embedding near-duplicates by a forest of random-projection trees."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.links import components, local_roots
from terravane.llm.tables import stored
from terravane.llm.trees import blocks, depth, grow

COSINE, TREES, LEAF, SEED = 0.9, 6, 1024, 42

#: Overlap on each side of a split, in units of the spread ``1 / sqrt(dimensions)`` that the
#: projections of unit vectors have; a level then leaves about 0.56 of a node on a side.
OVERLAP, SHRINK = 0.15, 0.56

#: Share of the pairs with a cosine of just 0.9 that a level parts at this overlap, and the share
#: of them that all trees together may miss, whatever the size of the table.
PARTED, MISSED = 0.055, 0.002


def trees_for(n: int) -> int:
    """Trees for ``n`` vectors: at least :data:`TREES`, and so many more with the levels that
    leaves of :data:`LEAF` need that no more than :data:`MISSED` of the pairs share no leaf."""
    levels = max(0, math.ceil(math.log(max(n, 1) / LEAF) / -math.log(SHRINK)))
    apart = 1 - (1 - PARTED) ** levels
    return TREES if apart == 0 else max(TREES, math.ceil(math.log(MISSED) / math.log(apart)))


def _units(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    x = np.stack(vectors.to_numpy()).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def projections(classes: DataFrame, levels: int, trees: int) -> DataFrame:
    """For each ``id`` and tree the projections ``at`` on the tree's directions, one for a level."""
    schema = "id long, tree int, at array<float>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, part in frame.groupby(frame["embedding"].map(len)):
                x = _units(part["embedding"])
                for tree in range(trees):
                    draw = np.random.default_rng([SEED, size, tree]).standard_normal((size, max(levels, 1)))
                    at = list((x @ draw).astype(np.float32))
                    yield pd.DataFrame({"id": part["id"].to_numpy(), "tree": size * trees + tree, "at": at})

    return classes.select("id", "embedding").mapInPandas(run, schema)


def _compare(leaf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Of a leaf's pairs that link: how many copies each vector links to, and a spanning forest.

    A pair that meets in several leaves counts in the first of them, which both carry in
    ``homes``; the leaf's other vectors do not matter for that.
    """
    leaf = leaf.drop_duplicates("id").sort_values("id", ignore_index=True)
    x, chunk = _units(leaf["embedding"]), leaf["chunk"].to_numpy()
    first, second = leaf["first"].iloc[0], leaf["second"].iloc[0]
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    if first != second:
        linked &= chunk[:, None] != chunk
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return pd.DataFrame({"id": [], "n": [], "root": []}).astype("int64")
    linked, leaf = linked[np.ix_(some, some)], leaf.iloc[some]
    ids, copies = leaf["id"].to_numpy(), leaf["copies"].to_numpy()
    home = leaf["home"].iloc[0]
    earlier = leaf["homes"].map(lambda h: h[h < home])
    codes, places = np.unique(np.concatenate(earlier.to_list()), return_inverse=True)
    member = np.zeros((len(ids), max(len(codes), 1)), np.float32)
    member[np.repeat(np.arange(len(ids)), earlier.map(len).to_numpy()), places] = 1
    counted = linked & (member @ member.T == 0)
    roots = local_roots(linked)
    return pd.DataFrame({"id": ids, "n": (counted * copies).sum(axis=1), "root": ids[roots]})


def near_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links and groups of every row of ``rows`` (``vec_id``, ``embedding``).

    Equal vectors are one node with a number of copies. Each tree splits a
    node at its median on the level's random direction, with an overlap on both sides, until
    leaves fit; all vectors in a leaf are compared in double precision. Vectors of different
    length are in trees of their own. A leaf that no split takes apart is compared in pairs of
    blocks. :func:`trees_for` takes as many trees as the size of the table needs: of the pairs
    with a cosine of just 0.9 all of them together miss 2 in a thousand at most, derived from
    the overlap, at every size, and fewer of closer ones.

    Returns ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (smallest id
    reachable) and ``kept`` (``vec_id`` = ``component_id``). A vector that is null, empty, zero
    or has a null or non-finite component links to nothing, not even to its copies. Rows with
    one id and different vectors stand for themselves, a null id takes part and is its own
    component unless its group has another; other columns are not read; an empty table gives
    an empty result.
    """
    base = rows.select(F.col("vec_id").cast("long"), "embedding")
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    valid = F.coalesce(whole & F.exists("embedding", lambda v: v != 0), F.lit(False))
    key = F.when(valid, F.md5(F.concat_ws(",", F.transform("embedding", lambda v: (v + 0.0).cast("string"))).cast("binary")))
    base = stored(base.select("vec_id", "embedding", key.alias("key")), "vectors")
    classes = base.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
    )
    node = F.xxhash64("key")
    classes = stored(classes.select(node.alias("id"), "key", "low", "copies", "embedding"), "classes")
    total = classes.count()
    levels = depth(total, LEAF, SHRINK)
    grown = stored(projections(classes, levels, trees_for(total)), "projections")
    reach = F.lit(OVERLAP)
    leaves = grow(grown, lambda level: F.element_at("at", level + 1), reach, reach, LEAF, levels)
    # A tree and the path in it, as one number that orders the leaves that a vector is in.
    home = F.xxhash64("tree", "node")
    leaves = stored(leaves.select("tree", "node", "id", home.alias("home")), "leaves")
    homes = leaves.groupBy("id").agg(F.array_sort(F.collect_set("home")).alias("homes"))
    full = stored(classes.select("id", "copies", "embedding").join(homes, "id"), "full")
    pairs = blocks(leaves, "id", LEAF).join(full, "id")
    found = pairs.groupBy("tree", "node", "first", "second").applyInPandas(
        lambda leaf: _compare(leaf, cosine), "id long, n long, root long"
    )
    found = stored(found, "found")
    direct = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.drop("embedding").join(direct, "id", "left")
    named = named.join(stored(roots, "roots"), F.col("id") == F.col("node"), "left")
    named = stored(named.select("key", "low", "copies", "n", F.coalesce("root", "id").alias("root")), "named")
    heads = stored(named.groupBy("root").agg(F.min("low").alias("component")), "heads")
    links = (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    labels = stored(named.join(heads, "root").select(F.col("key").alias("_key"), "component", links), "labels")
    joined = base.drop("embedding").join(labels, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
