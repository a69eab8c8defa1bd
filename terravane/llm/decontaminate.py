"""Benchmark decontamination: exact pieces by the pigeonhole rule, then Myers' distance."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.llm.tables import in_blocks, scope, stored

#: One error is allowed for so many letters and digits of an item: its pieces are about as long.
LETTERS_PER_ERROR = 14
#: Bytes of items searched for in one pass over the documents: what is broadcast at a time.
BLOCK = 16 << 20

_OTHER = re.compile(r"[\W_]+")


def squeeze(text: str | None) -> str:
    """Letters and digits only, lower-cased: spacing, case and punctuation do not count."""
    return _OTHER.sub("", (text or "").lower())


def budget(item: str) -> int:
    """Errors allowed in an item, given as its letters."""
    return len(item) // LETTERS_PER_ERROR


def pieces(item: str) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of about equal length, with their offsets: one survives the errors."""
    cuts = np.linspace(0, len(item), budget(item) + 2).astype(int)
    return [(int(a), item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(item: str, text: str) -> int:
    """Least edit distance of ``item`` to any substring of ``text``, bit-parallel."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << len(item)) - 1, 1 << len(item) - 1
    plus, minus, score = full, 0, len(item)
    best = score
    for c in text:
        match = masks.get(c, 0)
        zero = (((match & plus) + plus) ^ plus) | match | minus
        up, down = minus | (full & ~(zero | plus)), plus & zero
        score += (1 if up & last else 0) - (1 if down & last else 0)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(zero | up)), up & zero
        best = min(best, score)
    return best


class Search:
    """All pieces of a set of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, squeeze(t)) for i, t in items]
        where: dict[str, dict[int, tuple[int, int]]] = {}
        for k, (_, item) in enumerate(self.items):
            for at, piece in pieces(item) if item else ():
                uses = where.setdefault(piece, {})
                uses[k] = (min(at, uses.get(k, (at, at))[0]), at)
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.empty = not where
        if where:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> dict[int, int]:
        """Items within their budget in ``text``, by position in the list, and the least distance.

        A piece hit says between which places the item would start, give or take the budget;
        windows that overlap are one, and only windows are compared.
        """
        if self.empty:
            return {}
        letters = squeeze(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (size, uses) in self.automaton.iter(letters):
            start = end + 1 - size
            for k, (low, high) in uses.items():
                item, slack = self.items[k][1], budget(self.items[k][1])
                windows.setdefault(k, []).append((start - high - slack, start - low + len(item) + slack))
        found: dict[int, int] = {}
        for k, spans in windows.items():
            item, best = self.items[k][1], None
            for low, high in _merged(spans):
                part = letters[max(0, low) : high]
                distance = 0 if item in part else myers(item, part)
                best = distance if best is None else min(best, distance)
                if best == 0:
                    break
            if best <= budget(item):
                found[k] = best
        return found


def _merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans in order, those that overlap as one."""
    spans = sorted(spans)
    low, high = spans[0]
    for a, b in spans[1:]:
        if a > high:
            yield low, high
            low, high = a, b
        high = max(high, b)
    yield low, high


def item_blocks(benchmark: DataFrame, limit: int = BLOCK) -> DataFrame:
    """``item_id``, ``text`` and ``block`` of every item, dealt out by bytes."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = rows.where("item_id is not null and text is not null").distinct()
    sized = items.withColumn("bytes", F.octet_length("text").cast("long"))
    return in_blocks(sized, "bytes", limit, "item_id", F.xxhash64("text")).drop("bytes")


def _searches(benchmark: DataFrame) -> Iterator[Broadcast]:
    """One block of the benchmark after the other, broadcast; the caller destroys what it has used."""
    spark = benchmark.sparkSession
    with scope(spark):
        blocks = stored(item_blocks(benchmark), "items")
        for (block,) in blocks.select("block").distinct().orderBy("block").collect():
            rows = blocks.where(F.col("block") == block).orderBy("item_id", "text").collect()
            sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])
            yield sent


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a benchmark item, one row for each document row and item.

    Columns: ``doc_id``, ``item_id``, ``distance`` (least edit distance between the letters of
    the item and a passage of the document) and ``budget``. An item is found if the distance is
    within its budget, one error for each 14 letters; an item shorter than that must occur as
    it is. Null ids of documents are carried, rows with a null text hold nothing; benchmark rows
    with a null id or text, or without a letter or digit, match nothing; repeated rows of
    either table are searched like any other, repeated benchmark rows once. Empty tables give
    an empty result.
    """
    spark = docs.sparkSession
    result = None
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, distance int, budget int"
    for sent in _searches(benchmark):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = Search(sent.value)
            for batch in batches:
                rows: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    for k, distance in search.find(text.as_py()).items():
                        rows.append((doc, search.items[k][0], distance, budget(search.items[k][1])))
                columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "distance", "budget"],
                )

        # Stored before the next block comes, so that one is held at a time.
        part = stored(texts.mapInArrow(run, schema), "hits", keep=True)
        sent.destroy()
        result = part if result is None else result.union(part)
    return spark.createDataFrame([], schema) if result is None else result


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no benchmark item; see :func:`contaminated`."""
    schema, at = T.StructType([*docs.schema.fields]), docs.columns.index("text")
    last = None
    for sent in _searches(benchmark):
        if last is not None:  # what the blocks so far leave is stored before the next one comes
            docs = stored(docs, "clean", keep=True)
            last.destroy()
        last = sent

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = Search(sent.value)
            for batch in batches:
                clean = [not search.find(text.as_py()) for text in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
