"""WKT texts to one row per vertex with its grid cell."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.functions import grid, wkt
from terravane.operators.columns import has_path, record_ids, union_all

VERTEX_SCHEMA = T.StructType(
    [
        T.StructField("objType", T.StringType(), False),
        T.StructField("identificatie", T.LongType()),
        T.StructField("historieIdentificatie", T.LongType()),
        T.StructField("vlakID", T.IntegerType()),
        T.StructField("puntID", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("refID", T.IntegerType()),
    ]
)
_NULL_ID = "CAST(NULL AS int)"


def _carried(df: DataFrame, text: str) -> list[str]:
    return [c for c in df.columns if c != text]


# --- WKT text to coordinate texts: exploding a null text yields no rows ----------------------


def split_polygon(df: DataFrame, text: str, rings: str = "outer") -> DataFrame:
    """``vlakID`` null, ``puntID`` from 0 and the coordinate text of every vertex."""
    kept = _carried(df, text)
    ring = wkt.ring_body(F.col(text))
    if rings == "all":
        df = df.select(*kept, F.posexplode(wkt.ring_bodies(F.col(text))).alias("ringID", "_ring"))
        kept, ring = [*kept, "ringID"], F.col("_ring")
    return df.select(
        *kept,
        F.expr(_NULL_ID).alias("vlakID"),
        F.posexplode(wkt.vertices(ring)).alias("puntID", "vertex"),
    )


def split_multipolygon(df: DataFrame, text: str) -> DataFrame:
    """``vlakID`` and ``puntID`` from 0 and the coordinate text of every outer-ring vertex."""
    kept = _carried(df, text)
    members = df.select(
        *kept, F.posexplode(wkt.member_bodies(F.col(text))).alias("vlakID", "_member")
    )
    ring = wkt.member_ring(F.col("_member"))
    return members.select(
        *kept, "vlakID", F.posexplode(wkt.vertices(ring)).alias("puntID", "vertex")
    )


def split_point(df: DataFrame, text: str) -> DataFrame:
    """Both ids null and the coordinate text of the point."""
    return df.select(
        *_carried(df, text),
        F.expr(_NULL_ID).alias("vlakID"),
        F.expr(_NULL_ID).alias("puntID"),
        F.explode(wkt.vertices(wkt.ring_body(F.col(text)))).alias("vertex"),
    )


def locate(df: DataFrame, literal: bool = False) -> DataFrame:
    """Replace the coordinate text ``vertex`` by ``lat``, ``long`` and ``refID``.

    ``literal`` keeps the published tables' reading: first number as latitude, single
    precision, and the neighbour search of :func:`grid.nearest_cell_literal`.
    """
    first, second = (wkt.ordinate(F.col("vertex"), i) for i in (0, 1))
    if literal:
        lat, long = (c.cast("float").cast("double") for c in (first, second))
        cell = grid.nearest_cell_literal("lat", "long")
    else:
        lat, long = second, first
        cell = grid.nearest_cell("lat", "long")
    placed = df.select(*_carried(df, "vertex"), lat.alias("lat"), long.alias("long"))
    return placed.select("*", cell.alias("refID"))


# --- vertices with their place ---------------------------------------------------------------


def polygon_vertices(
    df: DataFrame, text: str, rings: str = "outer", literal: bool = False
) -> DataFrame:
    """Vertices of a ``POLYGON`` text.

    Only the outer ring by default; ``rings="all"`` adds ``ringID`` (0 is the outer ring).
    """
    return locate(split_polygon(df, text, rings), literal)


def multipolygon_vertices(df: DataFrame, text: str, literal: bool = False) -> DataFrame:
    """Outer-ring vertices of every member of a ``MULTIPOLYGON`` text."""
    return locate(split_multipolygon(df, text), literal)


def point_vertices(df: DataFrame, text: str, literal: bool = False) -> DataFrame:
    """One row per ``POINT`` text."""
    return locate(split_point(df, text), literal)


SPLITTERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "geo_multi_polygon": split_multipolygon,
    "geo_polygon": split_polygon,
    "geo_point": split_point,
}
_SPLIT_SCHEMA = T.StructType(
    [*VERTEX_SCHEMA.fields[:5], T.StructField("vertex", T.StringType())]
)


def vertex_frames(df: DataFrame, object_type: str, stored: bool = False) -> list[DataFrame]:
    """Coordinate texts, one frame per WKT field that the records' ``geometry`` struct has.

    Each branch needs only the ids and its own WKT column. ``stored`` says that ``df`` is read
    from a table: the scan then skips row groups in which the column has no value. On computed
    geometry that filter would only compute every text a second time.
    """
    tag: Column = F.lit(object_type).alias("objType")
    frames = []
    for field, split in SPLITTERS.items():
        if has_path(df.schema, "geometry", field):
            text = F.col(f"geometry.{field}")
            source = df.where(text.isNotNull()) if stored else df
            frames.append(split(record_ids(source, tag, text.alias("_wkt")), "_wkt"))
    return frames


def vertex_table(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    literal: bool = False,
    stored: bool = False,
) -> DataFrame:
    """The geo dimension rows of tables by object type; empty when none has a geometry.

    All branches share one schema, so coordinates are read after the union, in one step.
    """
    frames = [
        frame
        for object_type, df in sources.items()
        for frame in vertex_frames(df, object_type, stored)
    ]
    placed = locate(union_all(spark, frames, _SPLIT_SCHEMA), literal)
    return placed.select(*VERTEX_SCHEMA.names)
