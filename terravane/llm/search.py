"""Ranked lexical search, reversed: documents stream through an index over the items' terms."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.tables import in_blocks, scope, stored

TOP = 10
#: Bytes of items' terms in an index, at most (but for an item that is larger by itself).
BLOCK = 16 << 20
#: Scores and postings a task holds at a time; bytes of a text split into terms at a time.
CELLS, PIECE = 1 << 20, 1 << 20

#: A term in lower-cased UTF-8: letters and digits of ASCII and whatever lies beyond it.
_TERM, _GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


def terms(text: str) -> Iterator[list[bytes]]:
    """Terms of a text, in order, in lists of bounded length; only A to Z are lower-cased."""
    data, at = text.encode().lower(), 0
    while at < len(data):
        found = _GAP.search(data, at + PIECE)
        stop = found.start() if found else len(data)
        yield _TERM.findall(data, at, stop)
        at = stop


@dataclass
class Index:
    """Items by term: those of term ``t`` stand at ``start[t]`` to ``start[t + 1]``."""

    ids: list[int | None]
    terms: dict[bytes, int]
    start: np.ndarray
    items: np.ndarray
    times: np.ndarray

    @classmethod
    def build(cls, rows: list) -> Index:
        """From rows of an item's id, its distinct terms and how often it holds each."""
        known: dict[bytes, int] = {}
        term = np.array([known.setdefault(bytes(t), len(known)) for r in rows for t in r["terms"]], np.int64)
        item = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
        times = np.array([n for r in rows for n in r["times"]], np.int64)
        order = np.argsort(term, kind="stable")
        start = np.append(0, np.cumsum(np.bincount(term, minlength=len(known))))
        return cls([r["item_id"] for r in rows], known, start, item[order], times[order])


def item_blocks(items: DataFrame, limit: int = BLOCK) -> DataFrame:
    """Every item's ``item_id``, ``terms`` and ``times``, with the ``block`` whose index it is in.

    Blocks follow from running sums of the terms' bytes, so that an index has a bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                own: Counter[bytes] = Counter()
                for some in terms(batch.column(1)[i].as_py()):
                    own.update(some)
                columns = [
                    batch.column(0).slice(i, 1),
                    batch.column(2).slice(i, 1),
                    pa.array([list(own)], pa.list_(pa.binary())),
                    pa.array([list(own.values())], pa.list_(pa.int64())),
                    pa.array([sum(map(len, own)) + 8 * len(own)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "key", "terms", "times", "bytes"])

    texts = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    texts = texts.dropDuplicates(["item_id", "text"]).select("item_id", "text", F.xxhash64("text").alias("key"))
    schema = "item_id long, key long, terms array<binary>, times array<long>, bytes long"
    found = stored(texts.mapInArrow(run, schema).where("bytes > 0"), "item-terms")
    return in_blocks(found, "bytes", limit, "item_id", "key").drop("bytes")


def term_counts(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), and the ``ids`` and counts ``tf`` of the index's
    terms, for every document with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(index.terms)
    names = ["doc_id", "n", "ids", "tf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = sent.value.get
        for batch in batches:
            rows, total, ids, tf = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                n, own = 0, Counter()
                for some in terms(text.as_py()):
                    n += len(some)
                    own.update(map(find, some))
                del own[None]
                if n:
                    rows.append(i)
                    total.append(n)
                    ids.append(list(own))
                    tf.append(list(own.values()))
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(total, pa.int64()),
                pa.array(ids, pa.list_(pa.int32())),
                pa.array(tf, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    return texts.mapInArrow(run, "doc_id long, n long, ids array<int>, tf array<long>")


class Heaps:
    """The best documents of every item so far: highest score first, then smallest id, null last."""

    def __init__(self, items: int, top: int):
        self.top, self.floor = top, np.ones(items, np.int64)
        self.rows = tuple(np.empty(0, kind) for kind in (np.int64, np.int64, bool, np.int64))

    def offer(self, docs: np.ndarray, none: np.ndarray, scores: np.ndarray) -> None:
        """Take ``scores`` (documents by items) in; a score below an item's last place is passed over."""
        if len(scores) > self.top:
            self.floor = np.maximum(self.floor, np.partition(scores, -self.top, axis=0)[-self.top])
        doc, item = np.nonzero(scores >= self.floor)
        if not len(doc):
            return
        new = (item, scores[doc, item], none[doc], docs[doc])
        item, score, none, docs = (np.concatenate(pair) for pair in zip(self.rows, new, strict=True))
        order = np.lexsort((docs, none, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        self.rows = tuple(column[order[place < self.top]] for column in (item, score, none, docs))
        last = order[place == self.top - 1]
        self.floor[item[last]] = np.maximum(self.floor[item[last]], score[last])


def scored(counts: DataFrame, index: Index, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``item``, ``doc_id`` and ``score`` of the ``top`` documents that each task has for an item."""
    sent = counts.sparkSession.sparkContext.broadcast(
        (len(index.ids), index.start, index.items, index.times, weights)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, start, items, times, weights = sent.value
        heaps, step = Heaps(width, top), max(1, CELLS // width)
        for whole in batches:
            for batch in (whole.slice(at, step) for at in range(0, len(whole), step)):
                n = batch.column(1).to_pylist()
                m = np.array([25 + 75 * x * n_docs // n_terms for x in n], np.int64)
                lists = batch.column(2)
                row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
                term = lists.flatten().to_numpy().astype(np.int64)
                tf = batch.column(3).flatten().to_numpy()
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                scores = np.zeros(len(batch) * width, np.int64)
                long = start[term + 1] - start[term]
                ends = np.cumsum(long)
                at = 0
                while at < len(term):
                    stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, "right")))
                    reps = long[at:stop]
                    shift = start[term[at:stop]] - (ends[at:stop] - reps - (ends[at - 1] if at else 0))
                    place = np.repeat(shift, reps) + np.arange(reps.sum())
                    cell = np.repeat(row[at:stop] * width, reps) + items[place]
                    np.add.at(scores, cell, np.repeat(value[at:stop], reps) * times[place])
                    at = stop
                ids = batch.column(0)
                none = ids.is_null().to_numpy(zero_copy_only=False)
                heaps.offer(ids.fill_null(0).to_numpy(), none, scores.reshape(len(batch), width))
        item, score, none, docs = heaps.rows
        columns = [pa.array(item), pa.array(docs, mask=none), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return counts.mapInArrow(run, "item long, doc_id long, score long")


def _best(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    The index goes to the documents: a block of items, bounded in bytes, is broadcast as lists of
    items by term. Each document's terms are counted once a block; frequencies over all
    documents give the terms' weights, a term's weight by its saturated count gives a score, and
    each task keeps ``top`` documents an item. The tasks' lists are merged in two steps, so that
    an item's do not come to one task at once.

    Only scores above 0 count; equal scores go by ascending ``doc_id``, null last. Repeated rows
    are documents of their own; items equal in id and text are one, items that share an id are
    ranked each by itself; null and blank texts hold no term, and an item without one has no
    rows; empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    with scope(spark):
        blocks = stored(item_blocks(items), "items", keep=True)
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for (block,) in blocks.select("block").distinct().orderBy("block").collect():
        own = blocks.where(F.col("block") == block).orderBy("item_id", "key")
        index = Index.build(own.select("item_id", "terms", "times").collect())
        with scope(spark):
            counts = stored(term_counts(docs, index), "term-counts")
            n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
            if not n_docs:
                break
            df = np.zeros(len(index.terms), np.int64)
            held = counts.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
            for term, n in held.collect():
                df[term] = n
            weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
            lists = scored(counts, index, np.array(weights, np.int64), n_docs, n_terms, top)
            lists = stored(lists, "heaps", keep=True)
        salted = lists.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(32)))
        best = _best(_best(salted, top, "item", "_salt").drop("rank"), top, "item")
        names = spark.createDataFrame(list(enumerate(index.ids)), "item long, item_id long")
        found = found.unionByName(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return found
