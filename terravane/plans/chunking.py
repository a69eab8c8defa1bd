"""WKT texts as fixed-width columns, per object type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terravane import constants as K
from terravane.operators.chunks import chunk_geometry
from terravane.operators.columns import has_path, type_at
from terravane.sources.files import read_table, write_table


def observe_widths(df: DataFrame) -> tuple[DataFrame, Observation | None]:
    """``df`` and, once it has been written, the longest text of each field of its ``geometry``.

    The lengths are taken from the rows as they pass to the writer: no second read.
    """
    struct = type_at(df.schema, "geometry")
    if struct is None:
        return df, None
    seen = Observation("widths")
    longest = [F.max(F.length(F.col(f"geometry.{n}"))).cast("bigint").alias(n) for n in struct.names]
    return df.observe(seen, *longest), seen


def keep_widths(
    spark: SparkSession, seen: Observation | None, folder: str, object_type: str, grow: bool = False
) -> None:
    """Write the observed widths beside the table; with ``grow`` they only ever get larger, for
    a table of which parts were replaced."""
    if seen is None:
        return
    widths = {name: longest or 0 for name, longest in seen.get.items()}
    if grow:
        earlier = kept_widths(spark, folder, object_type)
        widths = {name: max(longest, earlier.get(name, 0)) for name, longest in widths.items()}
    rows = spark.createDataFrame(list(widths.items()), "field string, longest long")
    write_table(rows.coalesce(1), f"{folder}/_widths/{object_type}")


def kept_widths(spark: SparkSession, folder: str, object_type: str) -> dict[str, int]:
    """Longest text of each geometry field of a stored table, as :func:`keep_widths` left them."""
    rows = read_table(spark, f"{folder}/_widths/{object_type}").collect()
    return {r["field"]: r["longest"] for r in rows}


def observed_counts(spark: SparkSession, folder: str, object_type: str, width: int) -> dict[str, int]:
    """Chunk columns of each geometry field, from the kept widths."""
    kept = kept_widths(spark, folder, object_type)
    return {f"geometry.{name}": -(-longest // width) for name, longest in kept.items()}


def build_chunks(
    spark: SparkSession,
    folder: str,
    types: Iterable[str] = K.CHUNK_TYPES,
    width: int = K.CHUNK_WIDTH,
    observed: bool = False,
) -> list[str]:
    """Write ``<folder>/<object type>_geo_splitted`` for every type with geometry.

    A table in parts keeps its parts, all with the same columns: the number of chunks comes
    from the whole table, by a pass over it or (``observed``) from the widths that its ingest
    kept. A task reads whole parts' files, so nothing is shuffled.
    """
    written = []
    for object_type in types:
        df = read_table(spark, f"{folder}/{object_type}")
        if not has_path(df.schema, "geometry"):
            continue
        target = f"{folder}/{object_type}_geo_splitted"
        parts = "part" if "part" in df.columns else None
        counts = observed_counts(spark, folder, object_type, width) if observed else None
        write_table(chunk_geometry(df, width, counts), target, parts)
        written.append(target)
    return written
