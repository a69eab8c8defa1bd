"""Near copies by the exact Jaccard similarity of word shingles.

SimHash fingerprints within 4 bits find who to compare, min-hash bands whom that radius does not reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.links import components, local_roots
from terravane.llm.simhash import first_rows, majority, near_groups, repeated_rows
from terravane.llm.tables import renamed, scope, stored
from terravane.llm.trees import blocks

WORDS, SEED = 5, 42
#: Sets that a task compares in a block, and the shingles in them.
LEAF, HEAVIEST = 1024, 1 << 21

#: Near copies share at least 4 of 5 shingles. A similarity of 0.8 is written as 4 / 5 so that
#: the test is one of whole numbers: 5 * common >= 4 * (a + b - common).
LEAST, OF = 4, 5

#: A pair of similarity s has equal minima in a band with s ** ROWS, so no band of a pair at just
#: 0.8 is equal in (1 - 0.8 ** 5) ** 32, or 3 of a million cases, and less often above it.
BANDS, ROWS = 32, 5
#: Stands for a band in the buckets made of linked fingerprints; the least, so it goes before them.
LINKED = -1

_DRAW = np.random.default_rng(SEED)
_FLIPS = _DRAW.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
_FACTORS = _DRAW.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the set of 5-word shingles; a shorter text is one shingle, no word none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > WORDS:
        starts, ends = starts[: 1 - WORDS], ends[WORDS - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends.tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(starts)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band: a hash of the least values of the set in the band's orders."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 256):
        part = hashes[at : at + 256, None] ^ _FLIPS
        part *= _FACTORS
        np.minimum(least, part.min(axis=0), out=least)
    raw = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(raw)], np.uint64)


def _near(common: Column, a: Column, b: Column) -> Column:
    return (common * (OF + LEAST)) >= (a + b) * LEAST


def _compare(leaf: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of the sets of a leaf that are near; those of one ``root`` are linked already."""
    leaf = leaf.drop_duplicates("fp").sort_values("fp", ignore_index=True)
    fp, root, sets = leaf["fp"].to_numpy(), leaf["root"].to_numpy(), leaf["shingles"].to_list()
    sizes = np.array([len(s) for s in sets], np.int64)
    _, codes, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    several = times[codes] > 1
    owner, codes = owner[several], codes[several]
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], np.unique(codes[order], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)), np.float64)
    # Whole numbers of up to 4,096 are exact in single precision, their sums in double precision.
    for low in range(0, int(codes[-1]) + 1 if len(codes) else 0, 4096):
        a, b = np.searchsorted(codes, (low, low + 4096))
        member = np.zeros((len(sets), 4096), np.float32)
        member[owner[a:b], codes[a:b] - low] = 1
        common += member @ member.T
    linked = (OF + LEAST) * common >= LEAST * (sizes[:, None] + sizes)
    roots = local_roots(linked | (root[:, None] == root))
    moved = np.flatnonzero(roots != np.arange(len(fp)))
    return pd.DataFrame({"a": fp[moved], "b": fp[roots[moved]]})


def copy_groups(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``(fp, group)`` for each set of shingles: sets of Jaccard similarity >= 0.8 linked in steps.

    Sets whose fingerprints :func:`near_groups` links are candidates, a bucket a group. At a
    similarity of 0.8 two fingerprints differ by some 10 bits, so an equal band key makes
    candidates too. A set is first compared with the least set of its bucket, which joins
    the members of a group of any size in one comparison each; only buckets whose sets are not
    in one group after that are compared in full. Every link is verified on the whole sets.
    ``marks`` has ``doc_id``, ``row``, ``fp``, ``simhash`` and ``bands`` of each row of ``docs``,
    which has ``_id``, ``_row`` and ``_text``.
    """
    distinct = stored(
        marks.groupBy("fp").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
            F.first("simhash").alias("simhash"),
            F.first("bands").alias("bands"),
        ),
        "distinct",
    )
    prints = near_groups(distinct.select(F.col("simhash").alias("fp"))).withColumnRenamed("fp", "simhash")
    linked = distinct.join(prints, "simhash").select("fp", F.lit(LINKED).alias("tree"), F.col("group").alias("node"))
    banded = distinct.select("fp", F.posexplode("bands").alias("tree", "node"))
    buckets = stored(linked.union(banded), "buckets")
    many = buckets.groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("fp").alias("head"),
        F.expr("bit_xor(xxhash64(fp))").alias("low"),
        F.expr("bit_xor(xxhash64(fp, 1))").alias("high"),
    )
    # Buckets with the same members are compared once.
    one = many.where("n > 1").groupBy("n", "low", "high").agg(F.min(F.struct("tree", "node", "head")).alias("one"))
    shared = stored(one.select("one.*"), "shared")
    members = stored(buckets.join(shared, ["tree", "node"]), "members")
    pairs = stored(members.where("fp <> head").select("fp", "head").distinct(), "pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["fp", "shingles"]
            )

    # The text of each candidate: of its first row.
    wanted = stored(
        distinct.join(members.select("fp").distinct(), "fp").select("fp", "first.doc_id", "first.row"), "wanted"
    )
    same = (F.col("_row") == F.col("row")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    # The hints keep one plan at every size: texts and sets move once a join.
    texts = docs.join(wanted.hint("merge"), same).select("fp", "_text")
    sets = texts.mapInArrow(run, "fp long, shingles array<long>")
    if not repeated_rows(marks).isEmpty():
        sets = sets.dropDuplicates(["fp"])
    sets = stored(sets, "sets")

    heads = sets.select(F.col("fp").alias("head"), F.col("shingles").alias("other"))
    size, other = F.size("shingles"), F.size("other")
    both = pairs.join(sets.hint("merge"), "fp").join(heads.hint("merge"), "head")
    both = both.where((F.least(size, other) * OF >= F.greatest(size, other) * LEAST))
    near = both.where(_near(F.size(F.array_intersect("shingles", "other")), size, other))
    star = stored(near.select(F.col("fp").alias("a"), F.col("head").alias("b")), "star")
    linked = stored(components(star), "linked").withColumnRenamed("node", "fp")
    # Buckets that the first links leave in several groups.
    rooted = stored(
        members.join(linked, "fp", "left").select("tree", "node", "fp", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    apart = rooted.groupBy("tree", "node").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    apart = stored(apart.where("least <> most").select("tree", "node"), "apart")
    weights = sets.select("fp", F.size("shingles").cast("long").alias("weight"))
    leaves = rooted.join(apart, ["tree", "node"], "left_semi").join(weights, "fp")
    rest = blocks(leaves, "fp", LEAF, "weight", HEAVIEST).drop("weight").join(sets, "fp")
    more = rest.groupBy("tree", "node", "first", "second").applyInPandas(_compare, "a long, b long")
    roots = stored(components(star.union(stored(more, "more"))), "roots")
    joined = distinct.select("fp").join(roots, F.col("fp") == F.col("node"), "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("group"))


def first_of_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns: of each group of near copies the one with the smallest id.

    Two texts are near copies if the sets of their 5-word shingles (lower case ASCII, single
    spaces) have a Jaccard similarity of at least 0.8; groups are linked in steps. The fingerprint
    of a set has the majority bits of its shingles' hashes, as in :mod:`simhash`. Texts without
    a word are copies of each other, a text of up to five words is one shingle. Nulls come last
    among ids, equal ids are told apart by a hash of the row, and of rows equal in all columns
    one stays; an empty table gives an empty result.
    """
    plain, names = renamed(docs)
    named = plain.select(
        F.col(names["doc_id"]).cast("long").alias("_id"),
        F.xxhash64(*plain.columns).alias("_row"),
        F.col(names["text"]).cast("string").alias("_text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, prints, bands = [], [], []
            for text in batch.column(2):
                hashes = shingles(text.as_py())
                marks.append(xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED))
                prints.append(majority(hashes))
                bands.append(band_keys(hashes).view(np.int64))
            fp, simhash = (pa.array(np.array(m, np.uint64).view(np.int64)) for m in (marks, prints))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), fp, simhash, pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "row", "fp", "simhash", "bands"],
            )

    schema = "doc_id long, row long, fp long, simhash long, bands array<long>"
    with scope(docs.sparkSession):
        marks = stored(named.mapInArrow(run, schema), "sketches")
        with scope(docs.sparkSession):
            groups = stored(copy_groups(named, marks), "groups", keep=True)
        return first_rows(docs, marks, groups)
