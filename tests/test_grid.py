"""Grid cells, vertices and chunks: properties over generated input."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane import constants as K
from terravane.functions import grid
from terravane.operators import vertices
from terravane.operators.chunks import chunk_columns, chunk_geometry


def places(spark, rows):
    return spark.createDataFrame(rows, "lat double, long double")


def test_centre_of_every_sampled_cell_is_its_own_nearest(spark):
    total = K.GRID_ROWS * K.GRID_COLUMNS
    df = spark.range(0, total, 9973).selectExpr("id AS cell")
    df = df.select("cell", grid.cell_lat("cell").alias("lat"), grid.cell_long("cell").alias("long"))
    assert df.where(grid.nearest_cell() != F.col("cell")).count() == 0
    assert df.where(grid.nearest_cell().isNull()).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(50.75, 53.7), st.floats(3.2, 7.22)), min_size=1, max_size=40))
def test_nearest_cell_is_within_half_a_step(spark, rows):
    df = places(spark, rows).withColumn("cell", grid.nearest_cell())
    df = df.select("*", grid.cell_lat("cell").alias("a"), grid.cell_long("cell").alias("b"))
    for r in df.collect():
        # the last row and column lie one step inside the box
        assert abs(r["lat"] - r["a"]) <= grid.LAT_STEP * 1.0001
        assert abs(r["long"] - r["b"]) <= grid.LONG_STEP * 1.0001
        if r["lat"] < K.LAT_MAX - grid.LAT_STEP:
            assert abs(r["lat"] - r["a"]) <= grid.LAT_STEP * 0.5001


def test_outside_the_box_is_null(spark):
    rows = [(50.7, 5.0), (53.8, 5.0), (52.0, 3.1), (52.0, 7.3), (None, 5.0), (52.0, None)]
    assert [r[0] for r in places(spark, rows).select(grid.nearest_cell()).collect()] == [None] * 6


def literal_by_hand(lat, long):
    def centre(i):
        return 50.75 + grid.LAT_STEP * math.floor(i / 32700), 3.2 + grid.LONG_STEP * (i % 32700)

    start = math.floor((long - 3.2) / grid.LONG_STEP + 32700 * ((lat - 50.75) / grid.LAT_STEP))
    near = [
        start + dx + dy * 32700
        for dx in (0, -1, 1)
        for dy in (0, -1, 1)
        if not (dx == -1 and start % 32700 == 0)
        and not (dx == 1 and start % 32700 == 32699)
        and not (dy == -1 and start < 32700)
        and not (dy == 1 and start > 44700 * 32700 - 32700)
    ]
    best = min(near, key=lambda i: math.dist((lat, long), centre(i)))
    return (best + 2**31) % 2**32 - 2**31


def test_literal_search_matches_brute_force(spark):
    rows = [(50.75 + i * 0.0137 % 2.9, 3.2 + i * 0.0211 % 4.0) for i in range(200)]
    rows += [(long, lat) for lat, long in rows]
    got = places(spark, rows).select(grid.nearest_cell_literal()).collect()
    want = [literal_by_hand(*row) for row in rows]
    assert sum(a[0] == b for a, b in zip(got, want, strict=True)) == len(rows)


point = st.tuples(st.floats(3.2, 7.22), st.floats(50.75, 53.7))


def render(ring):
    return "(" + ", ".join(f"{x:.16f} {y:.16f}" for x, y in ring) + ")"


def same_place(row, want):
    assert (row["long"], row["lat"]) == pytest.approx(want, abs=1e-13)


rings = st.lists(st.lists(point, min_size=3, max_size=5), min_size=1, max_size=3)


@settings(max_examples=10, deadline=None)
@given(st.lists(rings, min_size=1, max_size=3))
def test_wkt_gives_back_its_vertices(spark, shapes):
    polygons = [(i, f"POLYGON ({', '.join(map(render, s))})") for i, s in enumerate(shapes)]
    df = spark.createDataFrame(polygons, "k int, wkt string")
    outer = {(r["k"], r["puntID"]): r for r in vertices.polygon_vertices(df, "wkt").collect()}
    every = {
        (r["k"], r["ringID"], r["puntID"]): r
        for r in vertices.polygon_vertices(df, "wkt", rings="all").collect()
    }
    assert len(outer) == sum(len(s[0]) for s in shapes)
    assert len(every) == sum(len(r) for s in shapes for r in s)
    for k, s in enumerate(shapes):
        for j, r in enumerate(s):
            for i, p in enumerate(r):
                same_place(every[k, j, i], p)
                if j == 0:
                    same_place(outer[k, i], p)
                    assert outer[k, i]["vlakID"] is None

    text = ", ".join(f"({', '.join(map(render, s))})" for s in shapes)
    multi = spark.createDataFrame([(f"MULTIPOLYGON ({text})",)], "wkt string")
    found = {(r["vlakID"], r["puntID"]): r for r in vertices.multipolygon_vertices(multi, "wkt").collect()}
    assert len(found) == sum(len(s[0]) for s in shapes)
    for k, s in enumerate(shapes):
        for i, p in enumerate(s[0]):
            same_place(found[k, i], p)


def test_points_nulls_and_empty_geometries(spark):
    df = spark.createDataFrame(
        [(1, "POINT (5.5 52.5)"), (2, None), (3, "POINT EMPTY"), (4, "POINT (x 52.5)")],
        "k int, wkt string",
    )
    rows = {r["k"]: r for r in vertices.point_vertices(df, "wkt").collect()}
    assert sorted(rows) == [1, 4]
    assert (rows[1]["long"], rows[1]["lat"], rows[1]["puntID"]) == (5.5, 52.5, None)
    assert (rows[4]["long"], rows[4]["lat"], rows[4]["refID"]) == (None, 52.5, None)
    empty = spark.createDataFrame([("POLYGON EMPTY",), (None,)], "wkt string")
    assert vertices.polygon_vertices(empty, "wkt").count() == 0
    assert vertices.polygon_vertices(empty, "wkt", rings="all").count() == 0
    assert vertices.multipolygon_vertices(empty, "wkt").count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=40), min_size=1, max_size=8))
def test_chunks_concatenate_to_the_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    cut = chunk_columns(df, ["text"], width=7)
    chunks = [c for c in cut.columns if c != "text"]
    assert len(chunks) == math.ceil(max(map(len, texts)) / 7)
    for row in cut.collect():
        assert "".join(row[c] for c in chunks) == row["text"]
        assert all(len(row[c]) <= 7 for c in chunks)


def test_chunks_of_null_and_given_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "abcdefghij")], "k int, text string")
    shaped = df.select("k", F.struct("text", F.lit(None).cast("string").alias("none")).alias("geometry"))
    cut = chunk_geometry(shaped, width=4).drop("geometry").orderBy("k")
    assert cut.columns == ["k", "text_0", "text_1", "text_2"]
    assert [tuple(r) for r in cut.collect()] == [(1, None, None, None), (2, "abcd", "efgh", "ij")]
    given_counts = chunk_columns(df, ["text"], 4, {"text": 3})
    assert given_counts.columns == ["k", "text", "text_0", "text_1", "text_2"]
    assert given_counts.count() == 2
    for short in (1, 0):
        with pytest.raises(Exception, match="characters"):
            chunk_columns(df, ["text"], 4, {"text": short}).collect()
