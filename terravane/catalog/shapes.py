"""Register-shaped records derived from the star-schema tables by integer arithmetic.

Every record is anchored at RD metres computed from its key, so an SQL engine can compute the
same geometry without reading anything this package wrote. Functions return SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terravane import constants as K
from terravane.functions.bind import double, quoted
from terravane.sources.files import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def x0(key: str) -> str:
    return f"({key} * 7919L % 250000L + 20000L)"


def y0(key: str) -> str:
    return f"({key} * 104729L % 300000L + 310000L)"


def event_lat(key: str) -> str:
    """Latitudes over the national box, some of them north of it."""
    return f"double({key} * 7919 % 30500) / 10000D + {double(K.LAT_MIN)}"


def event_long(key: str) -> str:
    return f"double({key} * 104729 % 41000) / 10000D + {double(K.LONG_MIN)}"


OUTER = [(0, 0), (10, 0), (10, 10), (0, 0)]
INNER = [(6, 2), (8, 2), (8, 4), (6, 2)]
SHIFT = 100


def positions(key: str, points: list[tuple[int, int]], height: bool, shift: int = 0) -> str:
    words = [
        f"{x0(key)} + {dx + shift}, {y0(key)} + {dy + shift}" + (", '0'" if height else "")
        for dx, dy in points
    ]
    return f"concat_ws(' ', {', '.join(words)})"


def _struct(**fields: str) -> str:
    return f"named_struct({', '.join(f'{name!r}, {value}' for name, value in fields.items())})"


def _wrap(value: str, *names: str) -> str:
    for name in reversed(names):
        value = _struct(**{name: value})
    return value


def _ring(text: str, count: int) -> str:
    return _wrap(_struct(_VALUE=text, _count=f"{count}L"), "gml:LinearRing", "gml:posList")


def point_text(key: str) -> str:
    return f"if({key} % 7 <> 0, concat_ws(' ', {x0(key)}, {y0(key)}, '0'), NULL)"


def outer_text(key: str) -> str:
    return positions(key, OUTER, True)


def _polygon(key: str, height: bool, shift: int = 0) -> str:
    hole = _ring(positions(key, INNER, height, shift), len(INNER))
    return _struct(
        **{
            "_srsDimension": "3L" if height else "2L",
            "_srsName": "'EPSG:28992'",
            "gml:exterior": _ring(positions(key, OUTER, height, shift), len(OUTER)),
            "gml:interior": f"if({key} % 5 = 0, array({hole}), NULL)",
        }
    )


def polygon(key: str) -> str:
    """3-D gml:Polygon: one hole for every fifth key, null for every seventh."""
    return f"if({key} % 7 <> 0, {_polygon(key, True)}, NULL)"


def multi_surface(key: str) -> str:
    """gml:MultiSurface of two 2-D members, null for every seventh key."""
    members = [_wrap(_polygon(key, False, shift), "gml:Polygon") for shift in (0, SHIFT)]
    surface = _wrap(f"array({', '.join(members)})", "gml:MultiSurface", "gml:surfaceMember")
    return f"if({key} % 7 <> 0, {surface}, NULL)"


def _point(key: str) -> str:
    return f"if({key} % 7 <> 0, {_wrap(point_text(key), 'gml:Point', 'gml:pos')}, NULL)"


GEOMETRIES = {
    "punt": lambda key: _struct(**{"Objecten:punt": _point(key)}),
    "polygon": lambda key: _struct(**{"gml:Polygon": polygon(key)}),
    "vlak": lambda key: _struct(**{"Objecten:vlak": _wrap(polygon(key), "gml:Polygon")}),
    "multivlak": lambda key: _struct(**{"Objecten:multivlak": multi_surface(key)}),
}


def fields(key: str, geometry: str | None = None, version: str = "1L") -> dict[str, str]:
    """Identifier (it starts with a zero), history and geometry of a record, as SQL text."""
    number = f"concat('0599', lpad(string({key}), 12, '0'))"
    found = {
        K.ID_FIELD: _struct(_VALUE=number, _domein="'NL.IMBAG'"),
        K.HISTORY_FIELD: _wrap(f"bigint({version})", *K.HISTORY_PATH),
    }
    if geometry is not None:
        found[K.GEOMETRY_FIELD] = GEOMETRIES[geometry](key)
    return found


def record(key: str, geometry: str, version: str = "1L", **more: str) -> str:
    """The struct inside a type wrapper."""
    return _struct(**fields(key, geometry, version), **more)


def records(
    df: DataFrame, key: str, geometry: str | None, *keep: str, version: str = "1L"
) -> DataFrame:
    """The record's fields as columns beside the kept ones; ``df`` is a stored table."""
    if geometry is not None:
        df = dealt(df)
    columns = [
        f"{sql} AS {quoted(name)}" for name, sql in fields(key, geometry, version).items()
    ]
    return df.selectExpr(*keep, *columns)
