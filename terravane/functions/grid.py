"""National grid of latitude and longitude cells, numbered row by row from the south-west.

Arguments are column names or SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terravane import constants as K
from terravane.functions.bind import bind, double

LAT_STEP = (K.LAT_MAX - K.LAT_MIN) / K.GRID_ROWS
LONG_STEP = (K.LONG_MAX - K.LONG_MIN) / K.GRID_COLUMNS


def _row(lat: str) -> str:
    return f"(({lat}) - {double(K.LAT_MIN)}) / {double(LAT_STEP)}"


def _column(long: str) -> str:
    return f"(({long}) - {double(K.LONG_MIN)}) / {double(LONG_STEP)}"


def _index(lat: str, long: str) -> str:
    return f"({_column(long)} + {_row(lat)} * {double(float(K.GRID_COLUMNS))})"


def grid_index(lat: str = "lat", long: str = "long") -> Column:
    """Fractional index of a coordinate, exactly as the published formula defines it.

    The row is not rounded first, so its fraction spills into the column; see
    :func:`nearest_cell` for the cell a coordinate lies in.
    """
    return F.expr(_index(lat, long))


def cell_lat(index: str) -> Column:
    return F.expr(f"floor(({index}) / {K.GRID_COLUMNS}) * {double(LAT_STEP)} + {double(K.LAT_MIN)}")


def cell_long(index: str) -> Column:
    return F.expr(
        f"pmod({index}, {K.GRID_COLUMNS}) * {double(LONG_STEP)} + {double(K.LONG_MIN)}"
    )


def _nearest(position: str, size: int) -> str:
    return f"greatest(least(floor({position} + 0.5D), {size - 1}), 0)"


def nearest_cell(lat: str = "lat", long: str = "long") -> Column:
    """Index of the nearest cell; null outside the national box.

    Both axes are rounded on their own, in closed form. The largest index is below 2^31.
    """
    row, column = _nearest(_row(lat), K.GRID_ROWS), _nearest(_column(long), K.GRID_COLUMNS)
    return F.expr(
        f"""CASE WHEN {lat} BETWEEN {double(K.LAT_MIN)} AND {double(K.LAT_MAX)}
            AND {long} BETWEEN {double(K.LONG_MIN)} AND {double(K.LONG_MAX)}
            THEN int({row} * {K.GRID_COLUMNS} + {column}) END"""
    )


def _spread(value: str) -> str:
    """The low 16 bits of ``value`` with a zero bit before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = bind(value, f"g_m{shift}", f"(g_m{shift} | shiftleft(g_m{shift}, {shift})) & {mask}L")
    return value


def morton_code(cell: str = "refID") -> Column:
    """Place of a cell along a curve that keeps neighbours together: the bits of its row and column
    in turn. Null for a null cell."""
    row, column = f"bigint(floor(({cell}) / {K.GRID_COLUMNS}))", f"bigint(pmod({cell}, {K.GRID_COLUMNS}))"
    return F.expr(f"shiftleft({_spread(row)}, 1) | {_spread(column)}")


def cell_of(lat: float, long: float) -> tuple[int, int]:
    """Row and column of the cell nearest to a place, the closest one for a place outside."""
    row, column = (lat - K.LAT_MIN) / LAT_STEP + 0.5, (long - K.LONG_MIN) / LONG_STEP + 0.5
    return min(max(int(row), 0), K.GRID_ROWS - 1), min(max(int(column), 0), K.GRID_COLUMNS - 1)


def interleave(row: int, column: int) -> int:
    """:func:`morton_code` of a row and a column."""
    return sum(((row >> b & 1) << 1 | (column >> b & 1)) << 2 * b for b in range(16))


def curve_ranges(low: tuple[int, int], high: tuple[int, int], pieces: int = 32) -> list[tuple[int, int]]:
    """Ranges of the curve that hold all cells from ``low`` to ``high`` (row, column), at most ``pieces``.

    Squares of the curve that reach over the edge of the box are quartered, largest first, as
    long as the ranges suffice; neighbouring ranges join.
    """
    whole, cut = [], [(16, 0, 0)]
    while cut and len(whole) + len(cut) + 3 <= pieces:
        size, row, column = cut.pop(0)
        last = (row + (1 << size) - 1, column + (1 << size) - 1)
        if row > high[0] or column > high[1] or last[0] < low[0] or last[1] < low[1]:
            continue
        if low[0] <= row and low[1] <= column and last[0] <= high[0] and last[1] <= high[1]:
            whole.append((size, row, column))
        else:
            half = 1 << size - 1
            cut += [(size - 1, r, c) for r in (row, row + half) for c in (column, column + half)]
    ranges: list[tuple[int, int]] = []
    for first, size in sorted((interleave(row, column), size) for size, row, column in whole + cut):
        joins = ranges and ranges[-1][1] + 1 == first
        start = ranges.pop()[0] if joins else first
        ranges.append((start, first + 4**size - 1))
    return ranges


def nearest_cell_literal(lat: str = "lat", long: str = "long") -> Column:
    """The published neighbour search, kept for comparison with existing tables.

    It starts from the unrounded row of :func:`grid_index`, so it can only return a cell near
    that wrong start, and it lets indexes beyond 32 bits wrap. Use :func:`nearest_cell` for
    new tables.
    """
    rows, columns = K.GRID_ROWS, K.GRID_COLUMNS
    start = f"bigint(floor({_index(lat, long)}))"
    side = f"pmod(g_s, {columns})"
    across = {"0": "true", "-1": f"{side} <> 0", "1": f"{side} <> {columns - 1}"}
    up = {
        "0": "true",
        f"-{columns}": f"g_s >= {columns}",
        f"{columns}": f"g_s <= {(rows - 1) * columns}",
    }
    # a tie goes to the first candidate of the array
    cells = [
        f"if({side_ok} AND {row_ok}, g_s + {step} + {row_step}, NULL)"
        for step, side_ok in across.items()
        for row_step, row_ok in up.items()
    ]
    offsets = f"""named_struct(
        'a', {lat} - (floor(g_c / {double(float(columns))}) * {double(LAT_STEP)} + {double(K.LAT_MIN)}),
        'b', {long} - (pmod(g_c, {columns}) * {double(LONG_STEP)} + {double(K.LONG_MIN)}))"""
    ranked = bind(
        offsets, "g_d", "named_struct('d', sqrt(g_d.a * g_d.a + g_d.b * g_d.b), 'k', g_k, 'c', g_c)"
    )
    best = f"array_min(transform(array({', '.join(cells)}), (g_c, g_k) -> if(g_c IS NULL, NULL, {ranked}))).c"
    # the low 32 bits as a signed int
    wrapped = "int(pmod(g_w + 2147483648, 4294967296) - 2147483648)"
    return F.expr(bind(bind(start, "g_s", best), "g_w", wrapped))
