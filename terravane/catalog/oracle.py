"""SQL twins of the queries, computed from the base tables' keys alone."""

from __future__ import annotations

import math

from terravane import constants as K
from terravane.plans import model

SQL: dict[str, str] = {}


def _d(value: float) -> str:
    """Double literal: a bare decimal would be read as DECIMAL."""
    return f"({value!r}e0)" if "e" not in repr(value) else f"({value!r})"


def _x0(k: str) -> str:
    return f"(20000 + ({k} * 7919) % 250000)"


def _y0(k: str) -> str:
    return f"(310000 + ({k} * 104729) % 300000)"


OUTER = [(0, 0), (10, 0), (10, 10), (0, 0)]
INNER = [(6, 2), (8, 2), (8, 4), (6, 2)]


def _nested_sum(terms: dict[int, str], var: str) -> str:
    top = max(terms)
    total = terms[top]
    for power in range(top - 1, -1, -1):
        total = f"({var} * {total})"
        if power in terms:
            total = f"({total} + {terms[power]})"
    return total


def _series(terms: dict[tuple[int, int], float]) -> str:
    rows: dict[int, dict[int, str]] = {}
    for (p, q), value in terms.items():
        rows.setdefault(p, {})[q] = _d(value)
    return _nested_sum({p: _nested_sum(row, "dy") for p, row in rows.items()}, "dx")


LONG = f"({_series(K.LONG_TERMS)} / 3600.0e0 + {_d(K.WGS_ORIGIN_LONG)})"
LAT = f"({_series(K.LAT_TERMS)} / 3600.0e0 + {_d(K.WGS_ORIGIN_LAT)})"


def _offsets(x: str, y: str) -> str:
    return (
        f"(CAST({x} AS DOUBLE) - 155000.0e0) * 1e-5 AS dx, "
        f"(CAST({y} AS DOUBLE) - 463000.0e0) * 1e-5 AS dy"
    )


LAT_STEP = _d((K.LAT_MAX - K.LAT_MIN) / K.GRID_ROWS)
LONG_STEP = _d((K.LONG_MAX - K.LONG_MIN) / K.GRID_COLUMNS)


def _row(lat: str) -> str:
    return f"(({lat} - 50.75e0) / {LAT_STEP})"


def _column(long: str) -> str:
    return f"(({long} - 3.2e0) / {LONG_STEP})"


def _cell(lat: str, long: str) -> str:
    row = f"greatest(least(floor({_row(lat)} + 0.5e0), 44699), 0)"
    column = f"greatest(least(floor({_column(long)} + 0.5e0), 32699), 0)"
    return (
        f"CASE WHEN {lat} BETWEEN 50.75e0 AND 53.7e0 AND {long} BETWEEN 3.2e0 AND 7.22e0 "
        f"THEN CAST({row} * 32700 + {column} AS INTEGER) END"
    )


def _fixed(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"rpad({text}, CAST(strpos({text}, '.') + 16 AS INTEGER), '0')"


def _ring_values(rings: list[tuple[int, int, list[tuple[int, int]]]]) -> str:
    rows = [
        f"({member}, {ring}, {i}, {dx}, {dy})"
        for member, ring, points in rings
        for i, (dx, dy) in enumerate(points)
    ]
    return f"(VALUES {', '.join(rows)}) AS v(member, ring, pt, ox, oy)"


def _shifted(points: list[tuple[int, int]], by: int) -> list[tuple[int, int]]:
    return [(dx + by, dy + by) for dx, dy in points]


POLYGON = [(0, 0, OUTER), (0, 1, INNER)]
MULTI = [
    (m, r, _shifted(points, 100 * m)) for m in (0, 1) for r, points in ((0, OUTER), (1, INNER))
]


def _places(table: str, key: str, rings: list) -> str:
    """CTE ``places``: one row per vertex with its longitude and latitude."""
    return f"""
    raw AS (
      SELECT {key} AS k, member, ring, pt, {_offsets(f"{_x0(key)} + ox", f"{_y0(key)} + oy")}
      FROM {table}, {_ring_values(rings)}
      WHERE {key} % 7 <> 0 AND (ring = 0 OR {key} % 5 = 0)),
    places AS (SELECT k, member, ring, pt, {LAT} AS lat, {LONG} AS long FROM raw)"""


POINT = [(0, 0, [(0, 0)])]


def _wkt(table: str, key: str, rings: list, prefix: str, multi: bool) -> str:
    body = "'(' || string_agg(ring_text, ', ' ORDER BY ring) || ')'"
    outer = (
        f"'{prefix}(' || string_agg(member_text, ', ' ORDER BY member) || ')'"
        if multi
        else f"'{prefix}' || string_agg(member_text, '')"
    )
    return f"""
    WITH {_places(table, key, rings)},
    ring_texts AS (
      SELECT k, member, ring,
        '(' || string_agg({_fixed("long")} || ' ' || {_fixed("lat")}, ', ' ORDER BY pt) || ')'
          AS ring_text
      FROM places GROUP BY k, member, ring),
    member_texts AS (SELECT k, member, {body} AS member_text FROM ring_texts GROUP BY k, member),
    texts AS (SELECT k, {outer} AS wkt FROM member_texts GROUP BY k)
    SELECT t.{key}, wkt FROM {table} t LEFT JOIN texts ON k = t.{key}"""


def _identifier(k: str) -> str:
    return f"'0599' || lpad(CAST({k} AS VARCHAR), 12, '0')"


def _number(k: str) -> str:
    return f"(CAST(599000000000000 AS BIGINT) + {k})"


def _position_text(k: str, points: list[tuple[int, int]], height: bool = True) -> str:
    z = " || ' 0'" if height else ""
    return " || ' ' || ".join(
        f"({_x0(k)} + {dx}) || ' ' || ({_y0(k)} + {dy}){z}" for dx, dy in points
    )


def _point_text(k: str) -> str:
    return f"CASE WHEN {k} % 7 <> 0 THEN {_x0(k)} || ' ' || {_y0(k)} || ' 0' END"


# --- sources and sinks -------------------------------------------------------------------

SQL["xml_scan_inferred"] = f"""
SELECT {_number("s_suppkey")} AS identificatie, 'NL.IMBAG' AS domein, s_name AS naam,
  {_point_text("s_suppkey")} AS pos, CAST(1 AS BIGINT) AS versie FROM supplier"""

SQL["xml_scan_schema"] = f"""
SELECT {_identifier("o_orderkey")} AS identificatie, o_orderkey % 3 AS versie,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(3 AS BIGINT) END AS dimensie,
  CASE WHEN o_orderkey % 7 <> 0 THEN {_position_text("o_orderkey", OUTER)} END AS outer_text,
  CAST(CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_inner
FROM orders"""

SQL["xml_scan_split"] = SQL["xml_scan_schema"]

SQL["xml_from_text"] = f"""
SELECT {_number("c_custkey")} AS identificatie, CAST(1 AS BIGINT) AS "historieIdentificatie",
  CASE WHEN c_custkey % 7 <> 0 THEN {_position_text("c_custkey", OUTER)} END AS outer_text
FROM customer"""

SQL["xml_bad_records"] = """
SELECT o_orderkey, o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 AS malformed FROM orders"""

_HAS_AREA, _HAS_HOLE = "c_custkey % 7 <> 0", "c_custkey % 7 <> 0 AND c_custkey % 5 = 0"

SQL["xml_scan_variant"] = f"""
SELECT {_identifier("s_suppkey")} AS identificatie, s_suppkey % 3 AS versie, {_point_text("s_suppkey")} AS pos,
  CAST(NULL AS BIGINT) AS dimensie, CAST(NULL AS VARCHAR) AS outer_text, 0 AS n_inner,
  CAST(NULL AS VARCHAR) AS inner_text FROM supplier
UNION ALL
SELECT {_identifier("c_custkey")}, c_custkey % 3, NULL, CASE WHEN {_HAS_AREA} THEN 3 END,
  CASE WHEN {_HAS_AREA} THEN {_position_text("c_custkey", OUTER)} END, CASE WHEN {_HAS_HOLE} THEN 1 ELSE 0 END,
  CASE WHEN {_HAS_HOLE} THEN {_position_text("c_custkey", INNER)} END FROM customer"""

SQL["schema_drift"] = """
WITH found AS (
  SELECT unnest(['naam', 'oppervlakte', 'status/_sinds', 'nieuw']) AS element,
         unnest(['repeated', 'retyped', 'added', 'added']) AS kind,
         unnest([p_partkey % 10 = 1, p_partkey % 7 = 2, p_partkey % 5 = 3, p_partkey % 3 = 0]) AS here
  FROM part)
SELECT 'Objecten:Woonplaats/Objecten:' || element AS path, kind, count(*) AS n_records
FROM found WHERE here GROUP BY ALL"""

SQL["schema_roundtrip"] = """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY ALL"""

SQL["parquet_scan"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"""

SQL["parquet_roundtrip"] = "SELECT * FROM customer"

SQL["batched_parts"] = """
SELECT CAST((o_orderkey % 6400) // 100 AS INTEGER) AS part, count(*) AS n_rows
FROM orders GROUP BY 1"""

SQL["archive_records"] = f"""
SELECT {_identifier("s_suppkey")} AS identificatie, s_name AS naam, {_point_text("s_suppkey")} AS pos,
  '9999VBO' || (s_suppkey // 100) || '.zip' AS inner_archive,
  '9999VBO08102022-' || lpad(CAST(s_suppkey // 20 AS VARCHAR), 6, '0') || '.xml' AS member
FROM supplier"""

SQL["listed_files"] = "SELECT DISTINCT CAST(o_orderkey % 37 AS INTEGER) AS part FROM orders"

SQL["new_files"] = f"""
SELECT {_identifier("o_orderkey")} AS identificatie, coalesce(abs(o_orderkey % 3), 0) AS delivery
FROM orders"""

SQL["replaced_part"] = """
SELECT o_orderkey, CASE WHEN part IN (3, 5) THEN -o_custkey ELSE o_custkey END AS o_custkey, part
FROM (SELECT *, CAST((o_orderkey % 6400) // 100 AS INTEGER) AS part FROM orders)
WHERE part % 10 <> 7 AND (part NOT IN (3, 5) OR o_orderkey % 2 = 0)"""

SQL["archive_type_key"] = """
SELECT s_suppkey, 'Supplier#' AS type_key, 'bag/xml/Supplier#/' || s_suppkey || '.xml' AS blob_path
FROM supplier WHERE s_name LIKE 'Supplier#%'"""

SQL["ingest_table"] = f"""
SELECT {_number("p_partkey")} AS identificatie, CAST(1 AS BIGINT) AS "historieIdentificatie",
  p_name AS naam, wkt AS geo_multi_polygon,
  CAST(NULL AS VARCHAR) AS geo_polygon, CAST(NULL AS VARCHAR) AS geo_point
FROM part JOIN ({_wkt("part", "p_partkey", MULTI, "MULTIPOLYGON ", True)}) USING (p_partkey)"""

# --- projections and filters ---------------------------------------------------------------

SQL["struct_expand"] = "SELECT p_partkey, p_name, p_size FROM part"

SQL["nested_ids"] = f"""
SELECT {_number("l_orderkey")} AS identificatie,
  CAST(l_linenumber AS BIGINT) AS "historieIdentificatie", l_partkey FROM lineitem"""

SQL["struct_fields_completed"] = f"""
SELECT s_suppkey, CAST(NULL AS VARCHAR) AS geo_multi_polygon,
  CAST(NULL AS VARCHAR) AS geo_polygon, {_point_text("s_suppkey")} AS geo_point FROM supplier"""

SQL["point_wkt"] = f"""
WITH {_places("supplier", "s_suppkey", POINT)}
SELECT s_suppkey, CASE WHEN k IS NOT NULL
  THEN 'POINT (' || {_fixed("long")} || ' ' || {_fixed("lat")} || ')' END AS wkt
FROM supplier LEFT JOIN places ON k = s_suppkey"""

SQL["packed_geometry"] = f"""
SELECT s_suppkey, CAST(NULL AS VARCHAR) AS geo_multi_polygon,
  CAST(NULL AS VARCHAR) AS geo_polygon, wkt AS geo_point FROM ({SQL["point_wkt"]})"""

SQL["conditional_projection"] = f"""
SELECT {_number("s_suppkey")} AS identificatie, CAST(1 AS BIGINT) AS "historieIdentificatie",
  'Verblijfsobject' AS "objType", wkt FROM ({SQL["point_wkt"]})
UNION ALL SELECT {_number("n_nationkey")}, 1, 'Nummeraanduiding', NULL FROM nation"""

SQL["align_to_template"] = """
SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS geo_polygon_0,
  CAST(NULL AS VARCHAR) AS geo_polygon_1 FROM part"""

SQL["drop_null_rows"] = f"""
SELECT o_orderkey, {_point_text("o_orderkey")} AS geo_point FROM orders WHERE o_orderkey % 7 <> 0"""

SQL["suffix_filter"] = "SELECT page_id, url FROM pages WHERE suffix(url, '#top')"

# --- geometry ------------------------------------------------------------------------------

SQL["poslist_pairs"] = f"""
SELECT c_custkey, CAST(pt AS INTEGER) AS pos, CAST({_x0("c_custkey")} + ox AS DOUBLE) AS x,
  CAST({_y0("c_custkey")} + oy AS DOUBLE) AS y
FROM customer, {_ring_values([(0, 0, OUTER)])}"""

SQL["rd_to_wgs84_polynomial"] = f"""
WITH raw AS (SELECT c_custkey, {_offsets(_x0("c_custkey"), _y0("c_custkey"))} FROM customer)
SELECT c_custkey, {LAT} AS lat, {LONG} AS long FROM raw"""


def _geodetic_sql() -> str:
    """Projection inverse by fixed-point iteration, the datum shift by iterated latitude."""
    f = 1 / K.BESSEL_INV_F
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    lat0, long0 = math.radians(K.RD_LAT0), math.radians(K.RD_LONG0)
    n = math.sqrt(1 + e2 * math.cos(lat0) ** 4 / (1 - e2))
    radius = K.BESSEL_A * math.sqrt(1 - e2) / (1 - e2 * math.sin(lat0) ** 2)
    b0 = math.asin(math.sin(lat0) / n)
    s0 = e * math.sin(lat0)
    q0 = math.log(math.tan(math.pi / 4 + lat0 / 2)) - e / 2 * math.log((1 + s0) / (1 - s0))
    m = math.log(math.tan(math.pi / 4 + b0 / 2)) - n * q0
    wf = 1 / K.WGS84_INV_F
    we2 = wf * (2 - wf)
    rx, ry, rz = (math.radians(v / 3600) for v in K.RD_ROTATION)
    scale = 1 + K.RD_PPM * 1e-6
    tx, ty, tz = K.RD_SHIFT
    steps = [
        f"""a AS (SELECT c_custkey, CAST({_x0("c_custkey")} AS DOUBLE) - 155000e0 AS px,
          CAST({_y0("c_custkey")} AS DOUBLE) - 463000e0 AS py FROM customer)""",
        "b AS (SELECT *, sqrt(px * px + py * py) AS rho FROM a)",
        f"c AS (SELECT *, 2e0 * atan(rho / {_d(2 * radius * K.RD_K0)}) AS psi FROM b)",
        f"""d AS (SELECT *, asin(cos(psi) * {_d(math.sin(b0))}
          + sin(psi) * {_d(math.cos(b0))} * py / rho) AS sb FROM c)""",
        f"""g AS (SELECT *, asin(px / rho * sin(psi) / cos(sb)) / {_d(n)} + {_d(long0)} AS lo,
          (ln(tan(sb / 2e0 + {_d(math.pi / 4)})) - {_d(m)}) / {_d(n)} AS q FROM d)""",
        f"i0 AS (SELECT *, 2e0 * atan(exp(q)) - {_d(math.pi / 2)} AS la FROM g)",
    ]
    for step in range(1, 6):
        steps.append(
            f"""i{step} AS (SELECT * REPLACE (2e0 * atan(exp(q + {_d(e / 2)} *
              ln((1e0 + {_d(e)} * sin(la)) / (1e0 - {_d(e)} * sin(la))))) - {_d(math.pi / 2)} AS la)
              FROM i{step - 1})"""
        )
    steps += [
        f"h AS (SELECT *, {_d(K.BESSEL_A)} / sqrt(1e0 - {_d(e2)} * sin(la) * sin(la)) AS nu FROM i5)",
        f"""j AS (SELECT *, nu * cos(la) * cos(lo) AS gx, nu * cos(la) * sin(lo) AS gy,
          nu * {_d(1 - e2)} * sin(la) AS gz FROM h)""",
        f"""w AS (SELECT c_custkey,
          {_d(tx)} + {_d(scale)} * (gx - {_d(rz)} * gy + {_d(ry)} * gz) AS wx,
          {_d(ty)} + {_d(scale)} * ({_d(rz)} * gx + gy - {_d(rx)} * gz) AS wy,
          {_d(tz)} + {_d(scale)} * (-{_d(ry)} * gx + {_d(rx)} * gy + gz) AS wz FROM j)""",
        f"""l0 AS (SELECT *, sqrt(wx * wx + wy * wy) AS p,
          atan2(wz, sqrt(wx * wx + wy * wy) * {_d(1 - we2)}) AS wl FROM w)""",
    ]
    for step in range(1, 6):
        steps.append(
            f"""l{step} AS (SELECT * REPLACE (atan2(wz + {_d(we2 * K.WGS84_A)} * sin(wl)
              / sqrt(1e0 - {_d(we2)} * sin(wl) * sin(wl)), p) AS wl) FROM l{step - 1})"""
        )
    return f"""WITH {", ".join(steps)}
    SELECT c_custkey, CAST(floor(degrees(wl) * 1e6 + 0.5e0) AS BIGINT) AS lat_e6,
      CAST(floor(degrees(atan2(wy, wx)) * 1e6 + 0.5e0) AS BIGINT) AS long_e6 FROM l5"""


SQL["rd_to_wgs84_geodetic"] = _geodetic_sql()
SQL["polygon_wkt"] = _wkt("customer", "c_custkey", POLYGON, "POLYGON ", False)
SQL["area_wkt"] = _wkt("orders", "o_orderkey", POLYGON, "POLYGON ", False)
SQL["multipolygon_wkt"] = _wkt("part", "p_partkey", MULTI, "MULTIPOLYGON ", True)

_IDS = 'CAST(NULL AS INTEGER) AS "vlakID", CAST(pt AS INTEGER) AS "puntID"'
_PLACE = f'lat, long, {_cell("lat", "long")} AS "refID"'

SQL["polygon_vertices"] = f"""
WITH {_places("customer", "c_custkey", POLYGON)}
SELECT k AS c_custkey, {_IDS}, {_PLACE} FROM places WHERE ring = 0"""

SQL["polygon_vertices_all_rings"] = f"""
WITH {_places("customer", "c_custkey", POLYGON)}
SELECT k AS c_custkey, CAST(ring AS INTEGER) AS "ringID", {_IDS}, {_PLACE} FROM places"""

SQL["multipolygon_vertices"] = f"""
WITH {_places("part", "p_partkey", MULTI)}
SELECT k AS p_partkey, CAST(member AS INTEGER) AS "vlakID", CAST(pt AS INTEGER) AS "puntID", {_PLACE}
FROM places WHERE ring = 0"""

SQL["point_rows"] = f"""
WITH {_places("supplier", "s_suppkey", POINT)}
SELECT k AS s_suppkey, CAST(NULL AS INTEGER) AS "vlakID", CAST(NULL AS INTEGER) AS "puntID", {_PLACE}
FROM places"""

_EVENTS = """
  SELECT event_id, CAST((event_id * 7919) % 30500 AS DOUBLE) / 10000.0e0 + 50.75e0 AS lat,
    CAST((event_id * 104729) % 41000 AS DOUBLE) / 10000.0e0 + 3.2e0 AS long FROM events"""

SQL["grid_index"] = f"""
SELECT event_id, {_column("long")} + {_row("lat")} * 32700.0e0 AS grid_index FROM ({_EVENTS})"""

SQL["grid_center"] = f"""
WITH c AS (SELECT c_custkey, (c_custkey * 1048583) % (44700 * 32700) AS cell FROM customer)
SELECT c_custkey, cell, CAST(cell // 32700 AS DOUBLE) * {LAT_STEP} + 50.75e0 AS lat,
  CAST(cell % 32700 AS DOUBLE) * {LONG_STEP} + 3.2e0 AS long FROM c"""

SQL["nearest_cell"] = f"""SELECT event_id, {_cell("lat", "long")} AS "refID" FROM ({_EVENTS})"""


def _literal_search(places: str, keys: str) -> str:
    """CTE ``found``: published neighbour search over rows ``keys, lat, long`` of ``places``."""
    start = f"CAST(floor({_column('long')} + {_row('lat')} * 32700.0e0) AS BIGINT)"
    return f"""
    starts AS (SELECT *, {start} AS start FROM {places}),
    tried AS (
      SELECT s.*, (a.r * 3 + u.r) AS rank, start + a.o + u.o * 32700 AS cell
      FROM starts s, (VALUES (0, 0), (1, -1), (2, 1)) AS a(r, o), (VALUES (0, 0), (1, -1), (2, 1)) AS u(r, o)
      WHERE NOT (a.o = -1 AND start % 32700 = 0)
        AND NOT (a.o = 1 AND (start % 32700 + 32700) % 32700 = 32699)
        AND NOT (u.o = -1 AND start < 32700)
        AND NOT (u.o = 1 AND start > 44699 * 32700)),
    centred AS (
      SELECT *, lat - (floor(cell / 32700.0e0) * {LAT_STEP} + 50.75e0) AS dlat,
        long - (CAST((cell % 32700 + 32700) % 32700 AS DOUBLE) * {LONG_STEP} + 3.2e0) AS dlong
      FROM tried),
    ranked AS (
      SELECT *, row_number() OVER (
        PARTITION BY {keys} ORDER BY sqrt(dlat * dlat + dlong * dlong), rank) AS rn FROM centred),
    found AS (
      SELECT *, CAST(((cell + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648
        AS INTEGER) AS ref FROM ranked WHERE rn = 1)"""


SQL["nearest_cell_literal"] = f"""
WITH both_ways AS (
  SELECT event_id, 0 AS swapped, lat, long FROM ({_EVENTS})
  UNION ALL SELECT event_id, 1, long, lat FROM ({_EVENTS})),
{_literal_search("both_ways", "event_id, swapped")}
SELECT event_id, max(ref) FILTER (swapped = 0) AS "refID",
  max(ref) FILTER (swapped = 1) AS "swapped_refID" FROM found GROUP BY event_id"""


def _dimension_places() -> str:
    parts = []
    for name, table, key, rings, ids in (
        ("Verblijfsobject", "supplier", "s_suppkey", POINT, ("NULL", "NULL")),
        ("Woonplaats", "part", "p_partkey", MULTI, ("member", "pt")),
        ("Pand", "customer", "c_custkey", POLYGON, ("NULL", "pt")),
    ):
        parts.append(
            f"""SELECT * FROM (WITH {_places(table, key, rings)}
            SELECT '{name}' AS "objType", {_number("k")} AS identificatie,
              CAST(1 AS BIGINT) AS "historieIdentificatie",
              CAST({ids[0]} AS INTEGER) AS "vlakID", CAST({ids[1]} AS INTEGER) AS "puntID",
              lat, long FROM places WHERE ring = 0)"""
        )
    return " UNION ALL ".join(parts)


SQL["geo_dimension"] = f"""
SELECT "objType", identificatie, "historieIdentificatie", "vlakID", "puntID", {_PLACE}
FROM ({_dimension_places()})"""

SQL["stored_dimension"] = f"""SELECT * FROM ({SQL["geo_dimension"]}) WHERE "objType" = 'Pand'"""

SQL["geo_dimension_literal"] = f"""
WITH swapped AS (
  SELECT "objType", identificatie, "historieIdentificatie", "vlakID", "puntID",
    CAST(CAST(long AS FLOAT) AS DOUBLE) AS lat, CAST(CAST(lat AS FLOAT) AS DOUBLE) AS long
  FROM ({_dimension_places()})),
{_literal_search("swapped", '"objType", identificatie, "vlakID", "puntID"')}
SELECT "objType", identificatie, "historieIdentificatie", "vlakID", "puntID", lat, long,
  ref AS "refID" FROM found"""

# --- joins and unions ----------------------------------------------------------------------

SQL["full_outer_attach"] = """
SELECT o_orderkey, o_custkey, c_custkey, c_mktsegment
FROM orders FULL OUTER JOIN customer ON o_custkey = c_custkey AND o_orderkey % 2 = c_custkey % 2"""

SQL["union_fold"] = """
SELECT 'Verblijfsobject' AS "objType", count(*) AS n_rows, CAST(0 AS BIGINT) AS n_members
FROM supplier WHERE s_suppkey % 7 <> 0
UNION ALL
SELECT 'Woonplaats', count(*) * 8, count(*) * 8 FROM part WHERE p_partkey % 7 <> 0"""

# --- text chunks ---------------------------------------------------------------------------

SQL["max_text_length"] = """
SELECT max(length(text)) AS max_text, max(length(lang)) AS max_lang FROM documents"""



def _chunks(field: str, *ids: str) -> str:
    kept = ", ".join(ids)
    count = "CAST(ceil(max(length(text)) / 30000.0) AS BIGINT)"
    return f"""
    SELECT {kept}, '{field}_' || i AS chunk, substring(text, 1 + i * 30000, 30000) AS piece
    FROM (SELECT {kept}, text, unnest(range((SELECT {count} FROM documents))) AS i FROM documents)"""


SQL["chunk_columns"] = _chunks("text", "doc_id")
SQL["chunk_parts"] = _chunks("text", "doc_id", "source")
SQL["chunk_geometry"] = f"""{_chunks("geo_polygon", "doc_id")}
UNION ALL
SELECT doc_id, 'geo_point_0', CASE WHEN doc_id % 7 <> 0 THEN source END FROM documents"""

# --- model rules ---------------------------------------------------------------------------

SQL["conform"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS identificatie, {_point_text("c_custkey")} AS geometrie,
  c_mktsegment AS gebruiksdoel, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS oppervlakte,
  'in gebruik' AS status, CAST(NULL AS VARCHAR) AS geconstateerd,
  CAST(NULL AS VARCHAR) AS documentdatum, CAST(NULL AS VARCHAR) AS documentnummer,
  CAST(c_nationkey AS VARCHAR) AS hoofdadres, CAST(NULL AS VARCHAR) AS nevenadres,
  CAST(c_custkey % 100 AS VARCHAR) AS pand_identificatie FROM customer"""

SQL["check_not_null"] = """
SELECT 'o_orderkey' AS column_name, count(*) AS n_rows,
  count(*) FILTER (o_orderkey IS NULL) AS n_null FROM orders
UNION ALL SELECT 'geo_point', count(*), count(*) FILTER (o_orderkey % 7 = 0) FROM orders
UNION ALL SELECT 'status', count(*), count(*) FILTER (o_orderstatus = 'P') FROM orders"""

SQL["check_foreign_key"] = """
SELECT value, count(*) AS n_rows
FROM (SELECT CASE WHEN l_suppkey % 10 = 0 THEN -l_partkey ELSE l_partkey END AS value FROM lineitem)
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = value)
GROUP BY value"""

SQL["foreign_key_rows"] = """
SELECT l_orderkey, l_linenumber, used AS l_partkey
FROM (SELECT *, CASE WHEN l_suppkey % 10 = 0 THEN -l_partkey ELSE l_partkey END AS used FROM lineitem)
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = used)"""

SQL["check_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

SQL["check_domain"] = """
SELECT o_orderstatus AS value, count(*) AS n_rows FROM orders
WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1"""

SQL["check_length"] = """
SELECT 'p_name' AS column_name, count(*) AS n_rows, count(*) FILTER (length(p_name) > 9) AS n_too_long FROM part
UNION ALL SELECT 'p_brand', count(*), count(*) FILTER (length(p_brand) > 7) FROM part
UNION ALL SELECT 'p_type', count(*), count(*) FILTER (length(p_type) > 80) FROM part"""

SQL["length_rows"] = "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 9"

SQL["bridge_table"] = """
SELECT DISTINCT p_partkey, unnest([p_type, p_name || ' ' || p_brand]) AS gebruiksdoel FROM part"""


SQL["chunk_observed"] = SQL["chunk_columns"]

SQL["dimension_window"] = f"""
SELECT * FROM ({SQL["geo_dimension"]}) WHERE lat BETWEEN 51.9e0 AND 52.4e0 AND long BETWEEN 4.4e0 AND 5.1e0"""


# --- whole model ---------------------------------------------------------------------------

_MODEL = {
    "woonplaats": """
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS identificatie, n_name AS naam,
          'MULTIPOLYGON EMPTY' AS geometrie,
          CASE WHEN n_nationkey % 5 = 0 THEN 'Woonplaats onbekend' ELSE 'Woonplaats aangewezen' END
            AS status,
          'N' AS geconstateerd, DATE '2022-11-01' AS documentdatum,
          CAST(n_regionkey AS VARCHAR) AS documentnummer FROM nation""",
    "openbare_ruimte": """
        SELECT CAST(s_suppkey AS VARCHAR) AS identificatie, repeat(s_name, 5) AS naam, 'Weg' AS type,
          'uitgegeven' AS status, CASE WHEN s_suppkey % 7 <> 0 THEN 'N' END AS geconstateerd,
          DATE '2022-11-01' AS documentdatum, s_name AS documentnummer,
          lpad(CAST(s_nationkey + 3 AS VARCHAR), 4, '0') AS woonplaats_identificatie FROM supplier""",
    "nummeraanduiding": """
        SELECT CAST(c_custkey - c_custkey % 50 % 2 AS VARCHAR) AS identificatie,
          CAST(c_custkey AS VARCHAR) AS huisnummer, NULL AS huisletter,
          NULL AS huisnummertoevoeging, '3011AA' AS postcode,
          c_mktsegment AS type_adresseerbaar_object, 'uitgegeven' AS status, 'N' AS geconstateerd,
          CAST(NULL AS DATE) AS documentdatum, c_name AS documentnummer,
          CAST(c_nationkey AS VARCHAR) AS woonplaats_identificatie,
          CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 200 AS VARCHAR) END
            AS openbare_ruimte_identificatie FROM customer""",
    "pand": """
        SELECT CAST(p_partkey AS VARCHAR) AS identificatie, 'POLYGON EMPTY' AS geomtrie,
          CAST(p_size AS VARCHAR) AS oorspronkelijk_bouwjaar, 'in gebruik' AS status,
          'N' AS geconstateerd, DATE '2022-11-01' AS documentdatum FROM part""",
    "domeinwaarden_gebruiksdoel": """
        SELECT p_type AS waarde, max(p_brand) AS omschrijving FROM part GROUP BY p_type""",
    "verblijfsobject": f"""
        SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS identificatie,
          {_point_text("l_orderkey")} AS geometrie,
          CASE WHEN l_returnflag = 'R' THEN 'ECONOMY, TINY HOUSE' ELSE 'LARGE,PROMO,' END AS gebruiksdoel,
          CAST(l_quantity AS BIGINT) AS oppervlakte, l_linestatus AS status, 'N' AS geconstateerd,
          '2022-11-01' AS documentdatum, CAST(l_suppkey AS VARCHAR) AS documentnummer,
          CAST(l_orderkey % 500 AS VARCHAR) AS hoofdadres, CAST(NULL AS VARCHAR) AS nevenadres,
          CAST(CASE WHEN l_suppkey % 10 = 0 THEN -l_partkey ELSE l_partkey END AS VARCHAR) AS pand_identificatie FROM lineitem""",
    "woz_object": """
        SELECT CASE WHEN o_orderkey % 11 <> 0
            THEN CAST(o_orderkey - o_orderkey % 10 % 2 AS VARCHAR) END AS woz_objectnummer,
          CAST(o_custkey AS VARCHAR) AS nummeraanduiding FROM orders""",
    "woz_waarde": """
        SELECT CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS woz_objectnummer
        FROM events""",
}


def _rule_rows_sql() -> str:
    found = [
        f"SELECT 'verblijfsobject' AS table_name, identificatie AS row_key, 'not_null' AS rule, "
        f"'{column}' AS column_name FROM place WHERE {column} IS NULL"
        for column in ("geometrie", "oppervlakte", "status", "documentnummer", "pand_identificatie")
    ]
    breaks = {
        ("not_null", "identificatie"): "identificatie IS NULL",
        ("not_null", "geometrie"): "k % 7 = 0",
        ("max_length", "identificatie"): "length(identificatie) > 4",
        ("domain", "status"): "o_orderstatus = 'P'",
        ("unique", "identificatie"): "identificatie IN (SELECT identificatie FROM town GROUP BY 1 HAVING count(*) > 1)",
    }
    found += [
        f"SELECT 'woonplaats', CAST(k AS VARCHAR), '{rule}', '{column}' FROM town WHERE {condition}"
        for (rule, column), condition in breaks.items()
    ]
    found.append("""SELECT 'verblijfsobject', identificatie, 'unique', 'identificatie' FROM place
      WHERE identificatie IN (SELECT identificatie FROM place GROUP BY 1 HAVING count(*) > 1)""")
    return f"""
WITH place AS ({_MODEL["verblijfsobject"]}), town AS (
  SELECT o_orderkey AS k, o_orderstatus, CASE WHEN o_orderkey % 50 <> 0
    THEN CAST(o_orderkey - CASE WHEN o_orderkey % 40 = 1 THEN 1 ELSE 0 END AS VARCHAR) END AS identificatie FROM orders)
{" UNION ALL ".join(found)}"""


SQL["rule_rows"] = _rule_rows_sql()


def _model_report_sql() -> str:
    rules: list[str] = []

    def rule(table: str, name: str, column: str, count: str) -> None:
        rules.append(
            f"SELECT '{table}' AS table_name, '{name}' AS rule, '{column}' AS column_name, "
            f"CAST(({count}) AS BIGINT) AS n_violations"
        )

    for table in _MODEL:
        for column in model.required_columns(table):
            rule(table, "not_null", column, f"SELECT count(*) FROM m_{table} WHERE {column} IS NULL")
        for column, limit in model.MAX_LENGTHS.get(table, {}).items():
            rule(
                table, "max_length", column,
                f"SELECT count(*) FROM m_{table} WHERE length({column}) > {limit}",
            )
        if table in model.UNIQUE_KEYS:
            key = model.UNIQUE_KEYS[table]
            rule(
                table, "unique", key,
                f"""SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM m_{table}
                WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)""",
            )
    for (table, column), allowed in model.DOMAINS.items():
        values = ", ".join(f"'{v}'" for v in allowed)
        rule(
            table, "domain", column,
            f"SELECT count(*) FROM m_{table} WHERE {column} NOT IN ({values})",
        )
    for key in model.FOREIGN_KEYS:
        if key.table in _MODEL and key.parent in _MODEL:
            child = f"(SELECT {key.column} AS v FROM m_{key.table})"
            if (key.table, key.column) == ("verblijfsobject", "gebruiksdoel"):
                child = f"(SELECT trim(unnest(string_split({key.column}, ','))) AS v FROM m_{key.table})"
            rule(
                key.table, "foreign_key", key.column,
                f"""SELECT count(*) FROM {child} WHERE v IS NOT NULL AND v <> ''
                AND v NOT IN (SELECT {key.parent_column} FROM m_{key.parent}
                  WHERE {key.parent_column} IS NOT NULL)""",
            )
    tables = ", ".join(f"m_{name} AS ({sql})" for name, sql in _MODEL.items())
    return f"WITH {tables} {' UNION ALL '.join(rules)}"


SQL["model_report"] = _model_report_sql()
