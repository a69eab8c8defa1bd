"""Long texts cut into fixed-width columns for tools with a cell limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane import constants as K
from terravane.operators.columns import type_at


def max_lengths(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Longest text of every field in one pass, one column per field."""
    return df.agg(*[F.max(F.length(F.col(f))).cast("bigint").alias(_leaf(f)) for f in fields])


def _leaf(path: str) -> str:
    return path.split(".")[-1]


def chunk_counts(
    df: DataFrame, fields: Sequence[str], width: int = K.CHUNK_WIDTH
) -> dict[str, int]:
    """Columns needed per field: one job that returns a single row of maxima."""
    longest = max_lengths(df, fields).first()
    return {f: -(-(longest[_leaf(f)] or 0) // width) for f in fields}


def chunk_columns(
    df: DataFrame,
    fields: Sequence[str],
    width: int = K.CHUNK_WIDTH,
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """Add ``<field>_0 ... <field>_{n-1}``, every one ``width`` characters of the text.

    ``n`` covers the longest text of the whole frame, so all parts of a table agree. Pass
    ``counts`` (for example from statistics of an earlier job) to avoid the extra pass over
    the field; a text they do not cover is an error. A text that ends before a chunk gives an
    empty chunk, a null text null.
    """
    if counts is None:
        counts = chunk_counts(df, fields, width)
    else:
        for f in fields:
            fits = F.length(F.col(f)) <= counts[f] * width
            error = F.raise_error(F.lit(f"{f} holds a text of over {counts[f]} x {width} characters"))
            df = df.where(F.when(fits | F.col(f).isNull(), True).otherwise(error.cast("boolean")))
    return df.select(
        "*",
        *[
            F.substring(F.col(f), 1 + i * width, width).alias(f"{_leaf(f)}_{i}")
            for f in fields
            for i in range(counts[f])
        ],
    )


def chunk_geometry(
    df: DataFrame, width: int = K.CHUNK_WIDTH, counts: Mapping[str, int] | None = None
) -> DataFrame:
    """Chunk every field of the ``geometry`` struct; records without one pass unchanged."""
    struct = type_at(df.schema, "geometry")
    if struct is None:
        return df
    return chunk_columns(df, [f"geometry.{name}" for name in struct.names], width, counts)
