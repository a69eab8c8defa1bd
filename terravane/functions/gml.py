"""GML position text and geometry elements to WKT.

Inputs are SQL text: a column name, a field path or an expression. A malformed coordinate
gives a null geometry for its record, never a failed job, and never a geometry with that
vertex, ring or member left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.functions.bind import bind, quoted
from terravane.functions.numbers import fixed_text
from terravane.functions.projection import METHODS, rd_offset


@dataclass(frozen=True)
class Element:
    """A parsed XML element: its SQL path and its type, walked while the plan is built.

    XML inference gives a text element as string or as struct (when it has attributes), and a
    child as struct or array (when it repeats). Both forms are accepted everywhere.
    """

    sql: str
    type: T.DataType

    def child(self, name: str) -> Element | None:
        if not isinstance(self.type, T.StructType) or name not in self.type.names:
            return None
        return Element(f"{self.sql}.{quoted(name)}", self.type[name].dataType)

    def path(self, *names: str) -> Element | None:
        here: Element | None = self
        for name in names:
            here = here.child(name) if here is not None else None
        return here

    def text(self) -> str:
        value = self.child("_VALUE") or self
        return value.sql if isinstance(value.type, T.StringType) else f"string({value.sql})"

    def items(self) -> tuple[str, T.DataType]:
        """Repeated element as an array that is never null, and the type of one item."""
        if isinstance(self.type, T.ArrayType):
            return f"coalesce({self.sql}, array())", self.type.elementType
        return f"if({self.sql} IS NULL, array(), array({self.sql}))", self.type


# --- position text -----------------------------------------------------------------------


def _numbers(text: str) -> str:
    """array<double> of the words of ``text``; a word that is no number becomes null.

    Words may be separated by any run of white space. Most texts are single-spaced already,
    and a one-character split stays clear of the regex engine.
    """
    ragged = " OR ".join(f"contains(g_t, '{mark}')" for mark in ("\\n", "\\t", "\\r", "  "))
    words = f"if({ragged}, regexp_replace(g_t, '[ \\\\t\\\\r\\\\n]+', ' '), g_t)"
    split = f"try_cast(split({words}, ' ') AS array<double>)"
    return bind(f"btrim({text}, ' \\t\\r\\n')", "g_t", split)


def _starts(numbers: str, dimension: str) -> str:
    return f"sequence(0, array_size({numbers}) - 1, greatest(int({dimension}), 1))"


def position_pairs(text: str, dimension: str | int = 2) -> Column:
    """array<struct<x, y>>: the first two numbers of every ``dimension`` in the text."""
    pairs = f"""transform({_starts("g_n", str(dimension))},
        g_i -> named_struct('x', get(g_n, g_i), 'y', get(g_n, g_i + 1)))"""
    return F.expr(bind(_numbers(text), "g_n", pairs))


# --- WKT text ----------------------------------------------------------------------------


def _joined(parts: str) -> str:
    """Parts joined by a comma; null if any part is null, which array_join would skip."""
    return f"if(exists({parts}, g_e -> g_e IS NULL), NULL, array_join({parts}, ', '))"


def _coordinate(place: str, decimals: int) -> str:
    return (
        f"concat({fixed_text(f'{place}.long', decimals)}, ' ', "
        f"{fixed_text(f'{place}.lat', decimals)})"
    )


def point_wkt(text: str, method: str = "polynomial", decimals: int = K.WKT_DECIMALS) -> Column:
    """``POINT (long lat)`` of an ``x y`` or ``x y z`` text; the height is dropped."""
    offsets = f"""named_struct('x', {rd_offset("get(g_n, 0)", 0)},
        'y', {rd_offset("get(g_n, 1)", 1)})"""
    place = bind(offsets, "g_o", METHODS[method]("g_o.x", "g_o.y"))
    point = bind(place, "g_p", f"concat('POINT (', {_coordinate('g_p', decimals)}, ')')")
    sound = "array_size(g_n) BETWEEN 2 AND 3 AND NOT exists(g_n, g_e -> g_e IS NULL)"
    return F.expr(bind(_numbers(text), "g_n", f"if({sound}, {point}, NULL)"))


def _ring(text: str, dimension: str, method: str, decimals: int) -> str:
    def offsets(axis: int) -> str:
        return f"""transform({_starts("g_n", dimension)},
            g_i -> {rd_offset(f"get(g_n, g_i + {axis})", axis)})"""

    places = bind(
        _numbers(text),
        "g_n",
        f"zip_with({offsets(0)}, {offsets(1)}, (g_x, g_y) -> {METHODS[method]('g_x', 'g_y')})",
    )
    vertices = f"transform({places}, g_p -> {_coordinate('g_p', decimals)})"
    tail = "if(get(g_v, 0) = element_at(g_v, -1), ')', concat(', ', get(g_v, 0), ')'))"
    ring = f"if(array_size(g_v) >= 3, concat('(', {_joined('g_v')}, {tail}), NULL)"
    return bind(vertices, "g_v", ring)


def ring_text(
    text: str,
    dimension: str | int = 2,
    method: str = "polynomial",
    decimals: int = K.WKT_DECIMALS,
) -> Column:
    """``(long lat, long lat, ...)`` of a position list, closed if its ends differ.

    Null when a coordinate is malformed or fewer than three positions are given.
    """
    return F.expr(_ring(text, str(dimension), method, decimals))


_NO_TEXT = "CAST(NULL AS string)"


def _ring_positions(element: Element) -> str:
    positions = element.path("gml:LinearRing", "gml:posList")
    return _NO_TEXT if positions is None else positions.text()


def _polygon_body(polygon: Element, method: str, decimals: int) -> str:
    """``((outer), (inner), ...)`` of one gml:Polygon; null if any ring is null."""
    outer, inner = polygon.child("gml:exterior"), polygon.child("gml:interior")
    if outer is None:
        return _NO_TEXT
    declared = polygon.child("_srsDimension")
    dimension = "2" if declared is None else f"coalesce(try_cast({declared.sql} AS int), 2)"
    # one lambda renders outer and inner rings alike, so the ring expression appears once
    texts = [f"array({_ring_positions(outer)})"]
    if inner is not None:
        holes, hole_type = inner.items()
        texts.append(f"transform({holes}, g_h -> {_ring_positions(Element('g_h', hole_type))})")
    rings = f"transform(concat({', '.join(texts)}), g_r -> {_ring('g_r', dimension, method, decimals)})"
    return f"concat('(', {bind(rings, 'g_q', _joined('g_q'))}, ')')"


def polygon_wkt(
    polygon: Element, method: str = "polynomial", decimals: int = K.WKT_DECIMALS
) -> Column:
    """``POLYGON ((...), (...))`` of a gml:Polygon element with any number of holes."""
    return F.expr(f"concat('POLYGON ', {_polygon_body(polygon, method, decimals)})")


def multipolygon_wkt(
    surface: Element, method: str = "polynomial", decimals: int = K.WKT_DECIMALS
) -> Column:
    """``MULTIPOLYGON (((...)), ((...)))`` of a gml:MultiSurface element."""
    member = surface.child("gml:surfaceMember")
    if member is None:
        return F.expr(_NO_TEXT)
    members, member_type = member.items()
    polygon = Element("g_m", member_type).child("gml:Polygon")
    if polygon is None:
        return F.expr(_NO_TEXT)
    bodies = f"transform({members}, g_m -> {_polygon_body(polygon, method, decimals)})"
    joined = bind(bodies, "g_b", f"if(array_size(g_b) > 0, {_joined('g_b')}, NULL)")
    return F.expr(f"concat('MULTIPOLYGON (', {joined}, ')')")
