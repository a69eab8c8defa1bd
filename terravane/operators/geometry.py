"""Register geometry to one struct of WKT texts per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.functions import gml
from terravane.functions.bind import quoted

GEOMETRY_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in K.GEOMETRY_FIELDS])


def geometry_struct(
    multi_polygon: Column | None = None,
    polygon: Column | None = None,
    point: Column | None = None,
) -> Column:
    """The three WKT fields in fixed order, a null text where there is no value."""
    parts = (multi_polygon, polygon, point)
    return F.struct(
        *[
            (F.lit(None) if part is None else part).cast("string").alias(name)
            for name, part in zip(K.GEOMETRY_FIELDS, parts, strict=True)
        ]
    )


def complete_geometry(df: DataFrame, name: str = "geometry") -> DataFrame:
    """Give a geometry struct the WKT fields it lacks, in fixed order."""
    have = df.schema[name].dataType.names
    return df.withColumn(
        name,
        geometry_struct(*[F.col(name)[f] if f in have else None for f in K.GEOMETRY_FIELDS]),
    )


def convert_geometry(
    df: DataFrame, method: str = "geodetic", decimals: int = K.WKT_DECIMALS
) -> DataFrame:
    """Add ``geometry`` to records that have a geometry column; others pass unchanged.

    Which elements exist is known from the schema; which a record fills is decided per row. No
    record is collected and no join is needed, so repeated identifiers cannot multiply rows.
    """
    if K.GEOMETRY_FIELD not in df.columns:
        return df
    root = gml.Element(quoted(K.GEOMETRY_FIELD), df.schema[K.GEOMETRY_FIELD].dataType)

    surface = root.path("Objecten:multivlak", "gml:MultiSurface")
    multi = None if surface is None else gml.multipolygon_wkt(surface, method, decimals)

    areas = [root.path("Objecten:vlak", "gml:Polygon"), root.path("gml:Polygon")]
    texts = [gml.polygon_wkt(a, method, decimals) for a in areas if a is not None]
    polygon = F.coalesce(*texts) if texts else None

    place = root.path("Objecten:punt", "gml:Point", "gml:pos")
    point = None if place is None else gml.point_wkt(place.text(), method, decimals)

    return df.withColumn("geometry", geometry_struct(multi, polygon, point))
