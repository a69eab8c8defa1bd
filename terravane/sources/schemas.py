"""XML record schemas: the core every job relies on, inference, and JSON files."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from terravane import constants as K

_TEXT = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_count", T.LongType())])


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _nested(*names: str, leaf: T.DataType) -> T.DataType:
    for name in reversed(names):
        leaf = T.StructType([T.StructField(name, leaf)])
    return leaf


_RING = _nested("gml:LinearRing", "gml:posList", leaf=_TEXT)
_POLYGON = _struct(
    **{
        "_srsDimension": T.LongType(),
        "_srsName": T.StringType(),
        "gml:exterior": _RING,
        "gml:interior": T.ArrayType(_RING),
    }
)
_GEOMETRY = _struct(
    **{
        "Objecten:multivlak": _nested(
            "gml:MultiSurface",
            "gml:surfaceMember",
            leaf=T.ArrayType(_nested("gml:Polygon", leaf=_POLYGON)),
        ),
        "Objecten:vlak": _nested("gml:Polygon", leaf=_POLYGON),
        "Objecten:punt": _nested("gml:Point", "gml:pos", leaf=T.StringType()),
        "gml:Polygon": _POLYGON,
    }
)

# object types without a geometry of their own
WITHOUT_GEOMETRY = {"OpenbareRuimte", "Nummeraanduiding"}


def core_schema(object_type: str) -> T.StructType:
    """Identity and geometry fields of a record, in the one form all jobs agree on.

    Identifiers are text, which keeps their leading zeros; holes and surface members are
    arrays however many there are.
    """
    fields = {
        K.ID_FIELD: _struct(_VALUE=T.StringType(), _domein=T.StringType()),
        K.HISTORY_FIELD: _nested(*K.HISTORY_PATH, leaf=T.LongType()),
    }
    if object_type not in WITHOUT_GEOMETRY:
        fields[K.GEOMETRY_FIELD] = _GEOMETRY
    return _nested(K.XML_TYPE_PREFIX + object_type, leaf=_struct(**fields))


def merge_types(found: T.DataType, core: T.DataType) -> T.DataType:
    """``found`` with every field that ``core`` names given its core type, others kept."""
    if isinstance(core, T.ArrayType):
        item = found.elementType if isinstance(found, T.ArrayType) else found
        return T.ArrayType(merge_types(item, core.elementType))
    if not isinstance(core, T.StructType) or not isinstance(found, T.StructType):
        return core
    wanted = {field.name: field.dataType for field in core.fields}
    merged = [
        T.StructField(
            f.name, merge_types(f.dataType, wanted[f.name]) if f.name in wanted else f.dataType
        )
        for f in found.fields
    ]
    known = set(found.names)
    merged += [T.StructField(name, kind) for name, kind in wanted.items() if name not in known]
    return T.StructType(merged)


def record_schema(found: T.StructType, object_type: str) -> T.StructType:
    """Inferred schema made stable: all found fields, with the core in its agreed form."""
    return merge_types(found, core_schema(object_type))


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()["value"]))


