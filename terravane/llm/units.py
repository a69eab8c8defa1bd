"""Substring dedup: sentences of a line are hashed, and all but the first of each go."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.llm.tables import stored

#: Words of a unit at least: a shorter sentence joins the next one of its line, and a line that
#: is shorter in all is never removed.
WORDS = 6

#: Sentences end at a mark before white space, or at a mark of a script that writes none after
#: it, with the marks and closing quotes that follow.
_SENTENCE = re.compile(
    r"[^\n]*?(?:[.!?]+(?=\s)|[\u3002\uff01\uff1f\uff0e\uff61\u104b\u17d4\u0964\u06d4\u061f]"
    r"[\u3002\uff01\uff1f\uff0e\uff61.!?\u300d\u300f\u201d\u2019\uff09]*|(?=\n)|\Z)[^\S\n]*\n?"
)

#: Letters that stand for a word in scripts without spaces: two of Chinese or Japanese, four of
#: Thai, Lao, Burmese or Khmer.
_DENSE = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_LOOSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]")


def size(unit: str) -> int:
    """Words of a normalised unit; a word of a script without spaces counts by its letters."""
    if unit.isascii() or not (_DENSE.search(unit) or _LOOSE.search(unit)):
        return unit.count(" ") + 1
    total = 0
    for word in unit.split(" "):
        letters = len(_DENSE.findall(word)) / 2 + len(_LOOSE.findall(word)) / 4
        total += max(1, int(letters))
    return total


def units(text: str, words: int = WORDS) -> Iterator[tuple[int, int, str]]:
    """Consecutive spans that cover ``text``, with their normalised words."""
    start, held, end, count = 0, [], 0, 0
    for found in _SENTENCE.finditer(text):
        end = found.end()
        if end == found.start():
            continue
        part = found.group()
        more = part.lower().split()
        held += more
        count += size(" ".join(more)) if more else 0
        if count >= words or part.endswith("\n"):
            yield start, end, " ".join(held)
            start, held, count = end, [], 0
    if start < end:
        yield start, end, " ".join(held)


@F.arrow_udf(T.StringType())
def cut_out(text: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
    """The spans of each text, joined: one pass over a text, whatever the number of spans."""
    result = []
    for whole, first, last in zip(text, starts, stops, strict=True):
        own = whole.as_py()
        spans = () if own is None else zip(first.as_py(), last.as_py(), strict=True)
        result.append(None if own is None else "".join(own[a:b] for a, b in spans))
    return pa.array(result, pa.string())


def dedup_units(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Documents without the sentences that an earlier document or place already had.

    A unit is a sentence of a line with the white space after it, joined to the next one while
    it has fewer than ``words`` words (see :func:`size`); it compares in lower case with single spaces, by a 128
    bit digest. Units of fewer words are kept. Of equal units the first in the order of
    ``doc_id`` (nulls last), a hash of the text, and offset is kept, wherever it is.

    Returns ``doc_id``, ``text`` (what is kept), ``n_chars`` (of the original) and ``kept``,
    the offsets in the original of the spans that ``text`` joins, for each row; other columns
    are not read. A null text stays null without spans, an empty one empty; rows equal in id
    and text are one document and get the same result; an empty table gives an empty result.
    """
    key = F.xxhash64("text")
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, key long, start int, stop int, low long, high long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "key", "start", "stop", "low", "high"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            rows: list[tuple] = []
            for doc, mark, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                own = (doc.as_py(), mark.as_py())
                for start, stop, unit in units(text.as_py(), words):
                    if size(unit) >= words:
                        digest = xxhash.xxh3_128_digest(unit.encode())
                        low = int.from_bytes(digest[:8], "little", signed=True)
                        rows.append((*own, start, stop, low, int.from_bytes(digest[8:], "little", signed=True)))
                if len(rows) >= 50_000:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

    texts = base.where("text is not null").select("doc_id", key.alias("key"), "text")
    spans = stored(texts.mapInArrow(run, schema), "units")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "start")
    first = spans.groupBy("low", "high").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = first.where("first <> last").select("low", "high", "first.doc_id", "first.key", "first.start")
    repeated = stored(repeated.toDF("low", "high", "_doc", "_key", "_start"), "repeated-units")
    own = (
        F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")) & (F.col("start") == F.col("_start"))
    )
    later = spans.join(repeated, ["low", "high"]).where(~own)
    gone = F.array_sort(F.collect_set(F.struct("start", "stop")))
    cuts = stored(later.groupBy("doc_id", "key").agg(gone.alias("gone")), "cuts")
    cuts = cuts.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "gone")
    # The hint keeps one plan at every size: the texts move once.
    whole = base.withColumn("key", key).join(
        cuts.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")), "left"
    )
    nothing = F.array().cast("array<int>")
    starts = F.concat(F.array(F.lit(0)), F.coalesce(F.col("gone.stop"), nothing))
    stops = F.concat(F.coalesce(F.col("gone.start"), nothing), F.array(F.length("text")))
    gaps = F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), b.alias("stop")))
    kept = F.filter(gaps, lambda s: s["start"] < s["stop"])
    named = whole.select("doc_id", "text", "gone", F.when(F.col("text").isNotNull(), kept).alias("kept"))
    # Only texts with something to cut pass through Python.
    cut = cut_out(F.when(F.col("gone").isNotNull(), F.col("text")), F.col("kept.start"), F.col("kept.stop"))
    return named.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(cut).alias("text"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        "kept",
    )
