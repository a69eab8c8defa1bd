"""Language identification by bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.llm.tables import scope, stored

#: Labelled documents of each language that the filters are fitted on, about.
SAMPLE = 3000
#: N-grams of each language in the filters, at most; slots of the filters; probes per n-gram.
GRAMS, SLOTS, PROBES = 30_000, 1 << 19, 2
SIZES = (3, 4, 5)
#: A language with fewer teaching documents keeps n-grams of a single one.
FEW = 100
#: Code points and rows handled at a time: what a worker holds beside its Arrow batch.
PIECE, SLICE = 1 << 17, 256
UNDETERMINED = "und"

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _letters() -> np.ndarray:
    """Which code points are letters: made once on the driver and sent along."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _slices(column: pa.Array) -> Iterator[list]:
    """The values of a column, a few rows at a time."""
    for at in range(0, len(column), SLICE):
        yield column.slice(at, SLICE).to_pylist()


def gram_hashes(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of ``texts`` and the text each belongs to."""
    hashes, owners = zip(*_by_length(texts, letters), strict=True)
    return np.concatenate(hashes), np.concatenate(owners)


def _by_length(texts: list[str], letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The hashes and owners of :func:`gram_hashes`, one length of n-grams after the other.

    Texts are lower-cased, all but letters is a gap, and an n-gram holds no two gaps in a row.
    """
    parts = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(parts), dtype=np.int64), [len(p) for p in parts])
    word = letters[codes]
    keep = word.copy()
    keep[:-1] |= word[1:]
    keep[1:] |= word[:-1]
    double = ~word
    double[1:] &= word[:-1]  # a gap after a letter; the gap before the next one is dropped
    keep &= word | double
    keep[np.cumsum([0, *map(len, parts[:-1])])] = True
    codes, owner, word = codes[keep], owner[keep], word[keep]
    values = np.where(word, codes, 0).astype(np.uint64) + np.uint64(1)
    rolled = values
    for n in range(2, max(SIZES) + 1):
        rolled = rolled[:-1] * np.uint64(0x100000001B3) + values[n - 1 :]
        if n in SIZES:
            same = owner[: len(rolled)] == owner[n - 1 :]
            yield rolled[same], owner[: len(rolled)][same]


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in groups of about :data:`PIECE` code points; a longer text comes in several parts,
    which overlap so that no n-gram is lost."""
    rows, group, total = [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text or ""), PIECE):
            part = text[at : at + PIECE + max(SIZES) - 1]
            rows.append(row)
            group.append(part)
            total += len(part)
            if total >= PIECE:
                yield rows, group
                rows, group, total = [], [], 0
    if rows:
        yield rows, group


@dataclass
class Filters:
    """One Bloom filter for each language, bit by bit side by side: a slot holds the languages."""

    languages: list[str]
    table: np.ndarray  # slots x bytes of languages

    @classmethod
    def build(cls, grams: dict[str, np.ndarray]) -> Filters:
        languages = sorted(grams)
        table = np.zeros((SLOTS, max(1, -(-len(languages) // 8))), np.uint8)
        for i, language in enumerate(languages):
            for slots in cls.slots(grams[language]):
                table[slots, i // 8] |= np.uint8(1 << i % 8)
        return cls(languages, table)

    @staticmethod
    def slots(hashes: np.ndarray) -> list[np.ndarray]:
        shift = np.uint64(64 - SLOTS.bit_length() + 1)
        return [((hashes ^ (hashes >> np.uint64(29))) * np.uint64(m)) >> shift for m in _MIX[:PROBES]]

    def share(self, texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language, the share of n-grams that the language has, and their number.

        The popcount of a language's bits over all n-grams of the text is corrected for the
        filter's false positives, known from how full it is.
        """
        width = self.table.shape[1]
        counts = np.zeros((len(texts), width, 256), np.int64)
        for rows, group in _pieces(texts):
            for hashes, owners in _by_length(group, letters):
                first, *rest = self.slots(hashes)
                for byte in range(width):
                    column = self.table[:, byte]
                    mask = column[first]
                    for slots in rest:
                        mask &= column[slots]
                    found = np.bincount(owners * 256 + mask, minlength=len(group) * 256)
                    np.add.at(counts[:, byte], rows, found.reshape(len(group), 256))
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        hits = (counts @ bits).reshape(len(texts), -1)[:, : len(self.languages)]
        total = counts[:, 0].sum(axis=1)
        full = np.unpackbits(self.table, axis=1, bitorder="little").mean(axis=0)
        false = full[: len(self.languages)] ** PROBES
        share = (hits / np.maximum(total, 1)[:, None] - false) / (1 - false)
        return np.clip(share, 0, 1), total


def held_out() -> Column:
    """Documents kept apart from learning: the remainder is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Filters | None:
    """Filters from ``text`` and ``lang`` of labelled documents that are not held out.

    Each language learns from about ``sample`` documents picked by a hash of their id, and keeps
    its most frequent n-grams: seen in at least two of them (in one, if it has fewer than
    :data:`FEW`), and at least a tenth as frequent as in the language that has them most, so
    that a passage in another tongue does not count. What reaches the driver is
    :data:`GRAMS` hashes a language. None if nothing can be learned.
    """
    spark = docs.sparkSession
    known = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")
    ).where("doc_id is not null and text is not null and lang is not null")
    known = known.where(~held_out())
    with scope(spark):
        sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("known")), "languages")
        draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
        found = known.join(sizes, "lang").where(draw * F.col("known") < sample * 1_000_000).select("text", "lang")
        sent = spark.sparkContext.broadcast(_letters())

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for texts, langs in zip(_slices(batch.column(0)), _slices(batch.column(1)), strict=True):
                    for lang in set(langs):
                        own = [t for t, of in zip(texts, langs, strict=True) if of == lang]
                        for rows, group in _pieces(own):
                            for hashes, owners in _by_length(group, sent.value):
                                yield _counted(lang, hashes, np.array(rows)[owners])

        counts = found.mapInArrow(count, "lang string, gram long, n long, docs long")
        sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        counted = stored(sums, "grams")
        totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
        rates = counted.join(stored(totals, "totals"), "lang").withColumn("rate", F.col("n") / F.col("total"))
        best = rates.groupBy("gram").agg(F.max("rate").alias("best"))
        least = F.when(F.col("known") < FEW, 1).otherwise(2)
        own = rates.join(best, "gram").join(sizes, "lang").where((F.col("docs") >= least) & F.expr("rate >= 0.1 * best"))
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
        top = own.withColumn("_rank", rank).where(F.col("_rank") <= GRAMS).select("lang", "gram").toPandas()
    if not len(top):
        return None
    return Filters.build({lang: of.to_numpy(np.int64).view(np.uint64) for lang, of in top.groupby("lang")["gram"]})


def _counted(lang: str, hashes: np.ndarray, owners: np.ndarray) -> pa.RecordBatch:
    """Occurrences of each hash and the number of texts that hold it."""
    order = np.lexsort((owners, hashes))
    hashes, owners = hashes[order], owners[order]
    fresh = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
    other = fresh | np.append(True, owners[1:] != owners[:-1])[: len(hashes)]
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(hashes)))
    docs = np.diff(np.append(np.flatnonzero(other).searchsorted(first), other.sum()))
    columns = [pa.array([lang] * len(first), pa.string()), *map(pa.array, (hashes[first].view(np.int64), n, docs))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n", "docs"])


def _classified(texts: list[str | None], filters: Filters | None, letters: np.ndarray) -> tuple[list, list]:
    """Language and score of each text: the largest corrected share of its n-grams, of equal ones
    the first by name; ``und`` and 0 without a letter or where nothing was learned."""
    pred, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if filters is not None:
        share, total = filters.share(texts, letters)
        for i in np.flatnonzero(total):
            best = int(share[i].argmax())
            pred[i], score[i] = filters.languages[best], float(share[i, best])
    return pred, score


def _mapped(docs: DataFrame, filters: Filters | None, schema, result: Callable) -> DataFrame:
    """``result(batch, languages, scores)`` for every batch of ``docs``."""
    plain = filters and (filters.languages, filters.table)
    sent = docs.sparkSession.sparkContext.broadcast((plain, _letters()))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, letters = sent.value
        known = plain and Filters(*plain)
        for batch in batches:
            for start in range(0, len(batch), SLICE):
                part = batch.slice(start, SLICE)
                yield result(part, *_classified(part.column(at).to_pylist(), known, letters))

    return docs.mapInArrow(run, schema)


def keep_known(docs: DataFrame, filters: Filters | None, least: float) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is known with a score of ``least`` or more.

    If there was nothing to learn from, every row with a letter stays.
    """

    def result(batch: pa.RecordBatch, pred: list, score: list) -> pa.RecordBatch:
        known = [p != UNDETERMINED and s >= least for p, s in zip(pred, score, strict=True)]
        return batch.filter(pa.array(known, pa.bool_()))

    if filters is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return _mapped(docs, filters, T.StructType([*docs.schema.fields]), result)


def identify(docs: DataFrame) -> DataFrame:
    """Language of every row of ``docs`` by filters learned from the rows themselves.

    Returns ``doc_id``, ``held_out``, ``lang_pred`` and ``score``. Repeated rows each get a row;
    rows with a null id or a null label teach nothing but are classified; an empty table gives
    an empty result; columns other than ``doc_id``, ``text`` and ``lang`` are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    names = ["doc_id", "lang_pred", "score"]

    def result(batch: pa.RecordBatch, pred: list, score: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(score)], names)

    named = _mapped(texts, fit(docs), "doc_id long, lang_pred string, score double", result)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
