"""SimHash near-duplicates: fingerprints, vantage-point trees, exact pairs, groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.links import components, local_roots
from terravane.llm.tables import renamed, scope, stored
from terravane.llm.trees import blocks, depth, grow

WORDS, RADIUS, SEED, LEAF = 4, 4, 42, 1024

#: Fingerprints up to which three bands of one layout serve, see :func:`layout`.
SMALL, MEDIUM = 1 << 20, 1 << 27

#: Bits of a band, as a mask, and the radius searched in it.
Band = tuple[int, int]


def side_by_side(*bands: tuple[int, int]) -> list[Band]:
    """Bands of so many bits and such a radius, one after the other."""
    found, at = [], 0
    for bits, radius in bands:
        found.append((((1 << bits) - 1) << at, radius))
        at += bits
    return found


def exact_blocks(blocks: int, equal: int) -> list[Band]:
    """A band of radius 0 for every choice of ``equal`` out of ``blocks`` blocks of bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [(sum(some), 0) for some in combinations(masks, equal)]


def layout(n: int) -> list[Band]:
    """Bands for ``n`` fingerprints that no pair within 4 bits escapes.

    With three bands of radius 1, 1 and 0 a pair missed by all would differ by 2 + 2 + 1 bits. A
    fingerprint then meets about ``26 n / 2 ** 25`` others twice and ``n / 2 ** 14`` in the third
    band; with more fingerprints the third takes bits from the others. For very many, 3 of 7
    blocks must be equal, since 4 differing bits lie in at most 4 blocks: 35 bands of 27 bits,
    in which trees need no overlap.
    """
    if n <= SMALL:
        return side_by_side((25, 1), (25, 1), (14, 0))
    if n <= MEDIUM:
        return side_by_side((23, 1), (23, 1), (18, 0))
    return exact_blocks(7, 3)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each 1 if it is set in over half the hashes; 0 for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_535):
        part = hashes[at : at + 65_535].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None) -> int:
    """64 majority bits over the hashes of the word shingles; 0 if there is no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > WORDS:
        starts, ends = starts[: 1 - WORDS], ends[WORDS - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends.tolist(), strict=True)
    return majority(np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(starts)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id`` and ``fp``, the fingerprint of its whole text as a signed long."""
    schema = "doc_id long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py()) for t in batch.column(1)]
            fp = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, schema)


def near_links(marks: DataFrame, radius: int = RADIUS, bands: list[Band] | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect all of ``fp``, distinct, that lie within ``radius`` bits.

    One vantage-point tree for each band of bits (see :func:`layout`): a level has a vantage point, a node splits
    at its median distance to it, and by the triangle inequality only fingerprints within the
    band's radius above the boundary are needed on both sides. Leaves are compared in full. Of
    the pairs in a leaf the links of a spanning forest are returned: they join the same groups.
    """
    if radius > RADIUS:
        raise ValueError(f"the bands are made for a radius of up to {RADIUS}")
    n = marks.count()
    bands = bands or layout(n)
    spots = np.random.default_rng(SEED).integers(-(2**63), 2**63, (len(bands), 64), dtype=np.int64)

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def measure(level: int):
        tree, value = F.col("tree"), None
        for band, (mask, _) in enumerate(bands):
            far = F.bit_count(
                F.col("fp").bitwiseXOR(F.lit(int(spots[band, level]))).bitwiseAND(F.lit(signed(mask)))
            )
            value = F.when(tree == band, far) if value is None else value.when(tree == band, far)
        return value

    reach = F.lit(0)
    for band, (_, r) in enumerate(bands):
        reach = F.when(F.col("tree") == band, r).otherwise(reach)
    trees = F.explode(F.array(*[F.lit(band) for band in range(len(bands))])).alias("tree")
    rows = marks.select("fp", trees)
    leaves = grow(rows, measure, reach, F.lit(0), LEAF, depth(n, LEAF, 0.6))

    def compare(leaf: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(leaf["fp"].to_numpy())
        bits = fp.view(np.uint64)
        linked = np.empty((len(fp), len(fp)), bool)
        for at in range(0, len(fp), 256):
            linked[at : at + 256] = np.bitwise_count(bits[at : at + 256, None] ^ bits) <= radius
        roots = local_roots(linked)
        moved = np.flatnonzero(roots != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[moved], "b": fp[roots[moved]]})

    pairs = blocks(leaves.select("tree", "node", "fp"), "fp", LEAF)
    return pairs.groupBy("tree", "node", "first", "second").applyInPandas(compare, "a long, b long")


def near_groups(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, group)`` for each fingerprint of ``marks``: groups of fingerprints linked in steps."""
    with scope(marks.sparkSession):
        distinct = stored(marks.select("fp").distinct(), "distinct")
        roots = stored(components(near_links(distinct, radius)), "roots")
        joined = distinct.join(roots, distinct["fp"] == roots["node"], "left")
        return stored(joined.select("fp", F.coalesce("root", "fp").alias("group")), "groups", keep=True)


def simhash_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Near-duplicate group of every row of ``docs`` (``doc_id``, ``text``; others are ignored).

    Returns ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest
    ``doc_id`` reachable over links of at most ``radius`` differing bits. Equal fingerprints are
    one node, so a group of copies costs one comparison. Null, empty and blank texts have
    fingerprint zero and link like any other; a repeated row is a row of its own; null ids take
    part and are passed over as ``component_id`` unless a group has no other; an empty table
    gives an empty result.
    """
    with scope(docs.sparkSession):
        marks = stored(fingerprints(docs), "fingerprints", keep=True)
        groups = near_groups(marks, radius)
        least = marks.groupBy("fp").agg(F.min("doc_id").alias("low"))
        lows = stored(groups.join(least, "fp"), "lows")
        heads = stored(lows.groupBy("group").agg(F.min("low").alias("component_id")), "heads")
        labels = stored(lows.join(heads, "group").select("fp", "component_id"), "labels", keep=True)
    return marks.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows of ``docs``, all columns: of each near-duplicate group the one with the smallest id.

    Nulls come last among ids, equal ids are told apart by a hash of the row, and of rows equal
    in all columns one stays. See :func:`simhash_groups` for the groups.
    """
    plain, names = renamed(docs)
    row = F.xxhash64(*plain.columns)
    ids = F.col(names["doc_id"]).cast("long")
    schema = "doc_id long, row long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py()) for t in batch.column(2)]
            fp = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], ["doc_id", "row", "fp"])

    texts = plain.select(ids, row, F.col(names["text"]).cast("string"))
    with scope(docs.sparkSession):
        marks = stored(texts.mapInArrow(run, schema), "fingerprints")
        return first_rows(docs, marks, near_groups(marks, radius))


def repeated_rows(marks: DataFrame) -> DataFrame:
    """``doc_id`` and ``row`` of rows that are equal in all columns."""
    return marks.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def first_rows(docs: DataFrame, marks: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``docs``, the first of each group: ``marks`` has the ``doc_id``, ``row`` (hash of all
    columns) and ``fp`` of every row, ``groups`` the ``group`` of every ``fp``."""
    plain, names = renamed(docs)
    row = F.xxhash64(*plain.columns)
    ids = F.col(names["doc_id"]).cast("long")
    # The first row of each fingerprint, then of each group of fingerprints.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = stored(marks.groupBy("fp").agg(F.min(rank).alias("first")), "firsts")
    heads = first.join(groups, "fp").groupBy("group").agg(F.min("first").alias("first"))
    winners = heads.select(F.col("first.doc_id").alias("_id"), F.col("first.row").alias("_row"))
    winners = stored(winners, "winners", keep=True)
    named = plain.withColumn("_hash", row)
    same = (F.col("_hash") == F.col("_row")) & ids.eqNullSafe(F.col("_id"))
    kept = named.join(winners, same, "left_semi")
    if not repeated_rows(marks).isEmpty():
        kept = kept.dropDuplicates([names["doc_id"], "_hash"])
    return kept.drop("_hash").toDF(*docs.columns)
