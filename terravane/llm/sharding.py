"""Shards along a Hilbert curve over quantised metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import positions, stored

SHARDS, BITS = 40, 4

#: Bytes of a row besides its text.
OVERHEAD = 16


def hilbert(x: Column, y: Column, z: Column, bits: int = BITS) -> Column:
    """Index along the Hilbert curve of a cell of three coordinates from 0 to ``2**bits - 1``.

    A level of the curve is a bit of each coordinate. From the highest level down, while a
    coordinate's bit is set the lower bits of the first are inverted, and while it is not they
    change places with that coordinate's; the Gray code of the result is the index.
    """
    cell = _cell(x, y, z)
    for level in range(bits - 1, 0, -1):
        cell = _then(cell, _turn(level))
    for step in (_prefix, _flip(bits)):
        cell = _then(cell, step)
    index = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for axis in "xyz":
            index = index * 2 + F.getbit(cell[axis], F.lit(level))
    return index


def _cell(*axes: Column) -> Column:
    return F.struct(*[c.cast("long").alias(n) for n, c in zip("xyz", axes, strict=True)])


def _then(cell: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` of a cell that is computed once, however often the step reads it."""
    return F.element_at(F.transform(F.array(cell), step), 1)


def _turn(level: int) -> Callable[[Column], Column]:
    low = (1 << level) - 1

    def step(s: Column) -> Column:
        first, at = s["x"], [s["x"], s["y"], s["z"]]
        for i in range(3):
            on = F.getbit(at[i], F.lit(level)) == 1
            swap = first.bitwiseXOR(at[i]).bitwiseAND(low)
            moved = F.when(on, first.bitwiseXOR(F.lit(low))).otherwise(first.bitwiseXOR(swap))
            if i:
                at[i] = F.when(on, at[i]).otherwise(at[i].bitwiseXOR(swap))
            first = moved
        return _cell(first, at[1], at[2])

    return step


def _prefix(s: Column) -> Column:
    y = s["y"].bitwiseXOR(s["x"])
    return _cell(s["x"], y, s["z"].bitwiseXOR(y))


def _flip(bits: int) -> Callable[[Column], Column]:
    def step(s: Column) -> Column:
        mask = F.lit(0).cast("long")
        for level in range(bits - 1, 0, -1):
            mask = mask.bitwiseXOR(F.getbit(s["z"], F.lit(level)) * ((1 << level) - 1))
        return _cell(*[s[n].bitwiseXOR(mask) for n in "xyz"])

    return step


def quantised(docs: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """Values of a text column with ``cell``, in order: value ``i`` of ``n`` is in ``i * 2**bits / n``.

    The order of the values is kept, nulls come last.
    """
    values = docs.select(F.col(column).alias("value")).distinct()
    ranked = positions(values, F.col("value").asc_nulls_last())
    cell = F.floor(F.col("_position") * (1 << bits) / max(ranked.count(), 1)).cast("int")
    return stored(ranked.select("value", cell.alias("cell")), "cells")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` runs along the curve; law ``rows``.

    The dimensions are ``source`` and ``lang`` in their order and the magnitude of the size;
    rows of a cell are ordered by text checksum and id, so equal texts of a cell are
    neighbours. Shards are runs of this order whose row counts differ by one at most. Returns
    ``doc_id``, ``size`` (bytes of the text and 16), ``text_crc32``, ``law``, ``shard``,
    ``slot`` (from 0 in each shard), ``grown_shard`` (null: rows move under this law) and
    ``curve``. A null text has 16 bytes and no checksum; null ids, sources and languages come
    last in their order; repeated rows keep a slot each; an empty table gives an empty result.
    """
    raw = F.col("text").cast("binary")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD
    rows = docs.select(
        F.col("doc_id").cast("long"),
        size.alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.col("source").cast("string").alias("_source"),
        F.col("lang").cast("string").alias("_lang"),
    )
    rows = stored(rows, "rows")
    source = quantised(rows, "_source").select(F.col("value").alias("_s"), F.col("cell").alias("_x"))
    lang = quantised(rows, "_lang").select(F.col("value").alias("_l"), F.col("cell").alias("_y"))
    cells = rows.join(source, F.col("_source").eqNullSafe(F.col("_s")))
    cells = cells.join(lang, F.col("_lang").eqNullSafe(F.col("_l")))
    magnitude = F.least(F.floor(F.log2(F.col("size") / OVERHEAD)), F.lit((1 << BITS) - 1))
    curve = hilbert(F.col("_x"), F.col("_y"), magnitude)
    keyed = cells.select("doc_id", "size", "text_crc32", curve.alias("curve"))
    order = ("curve", F.col("text_crc32").asc_nulls_last(), F.col("doc_id").asc_nulls_last(), "size")
    placed = positions(keyed, *order)
    n = rows.count()
    base, extra = divmod(n, shards)
    at = F.col("_position")
    # The first ``extra`` shards hold one row more than ``base``.
    long = extra * (base + 1)
    number = F.when(at < long, F.floor(at / (base + 1))).otherwise(
        extra + F.floor((at - long) / max(base, 1))
    )
    slot = F.when(at < long, at % (base + 1)).otherwise((at - long) % max(base, 1))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        number.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
