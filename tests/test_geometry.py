"""Geometry conversion of XML records, with declared and with inferred schemas."""

from __future__ import annotations

import pytest
import samples as X
from pyspark.sql import functions as F

from terravane.functions import gml
from terravane.functions.projection import rd_to_wgs84
from terravane.operators.geometry import convert_geometry
from terravane.sources import schemas, xml

SQUARE_3D = "100000 400000 0 100010 400000 0 100010 400010 0 100000 400000 0"
SQUARE_2D = "100000 400000 100010 400000 100010 400010 100000 400000"
HOLE_3D = "100006 400002 0 100008 400002 0 100008 400004 0 100006 400002 0"
HOLE_2D = "100006 400002 100008 400002 100008 400004 100006 400002"
OTHER_2D = "100100 400100 100110 400100 100110 400110 100100 400100"
SQUARE = [(100000, 400000), (100010, 400000), (100010, 400010), (100000, 400000)]
HOLE = [(100006, 400002), (100008, 400002), (100008, 400004), (100006, 400002)]
OTHER = [(100100, 400100), (100110, 400100), (100110, 400110), (100100, 400100)]


def expected(members):
    return [[[X.to_wgs84(*p) for p in ring] for ring in rings] for rings in members]


def assert_wkt(text, members):
    got, want = X.numbers_of(text), expected(members)
    assert [[len(r) for r in m] for m in got] == [[len(r) for r in m] for m in want]
    for a, b in zip(got, want, strict=True):
        for r, s in zip(a, b, strict=True):
            for p, q in zip(r, s, strict=True):
                assert p == pytest.approx(q, abs=1e-12)


CASES = {
    # key: (geometry, field, members)
    "01": (X.punt("100000 400000 3.5"), "geo_point", [[SQUARE[:1]]]),
    "02": (X.vlak(SQUARE_3D), "geo_polygon", [[SQUARE]]),
    "03": (X.vlak(SQUARE_3D, HOLE_3D), "geo_polygon", [[SQUARE, HOLE]]),
    "04": (X.vlak(SQUARE_3D, HOLE_3D, HOLE_3D), "geo_polygon", [[SQUARE, HOLE, HOLE]]),
    "05": (X.vlak(SQUARE_2D, HOLE_2D, dimension=2), "geo_polygon", [[SQUARE, HOLE]]),
    "06": (X.vlak(SQUARE_2D, dimension=None), "geo_polygon", [[SQUARE]]),
    "07": (X.polygon(SQUARE_3D), "geo_polygon", [[SQUARE]]),
    "08": (X.polygon(SQUARE_2D, HOLE_2D, dimension=2), "geo_polygon", [[SQUARE, HOLE]]),
    "09": (X.multivlak(X.polygon(SQUARE_2D, dimension=2)), "geo_multi_polygon", [[SQUARE]]),
    "10": (
        X.multivlak(X.polygon(SQUARE_2D, HOLE_2D, dimension=2), X.polygon(OTHER_2D, dimension=2)),
        "geo_multi_polygon",
        [[SQUARE, HOLE], [OTHER]],
    ),
    # a declared dimension counts for members too
    "11": (X.multivlak(X.polygon(SQUARE_3D)), "geo_multi_polygon", [[SQUARE]]),
    # an open ring is closed; white space is free
    "12": (
        X.polygon("\n 100000  400000\t100010 400000\n100010 400010 ", dimension=2),
        "geo_polygon",
        [[SQUARE]],
    ),
}
NULL_CASES = {
    "20": X.punt("100000 oops 0"),
    "21": X.polygon("100000 400000 x 100010 400000 0 100010 oops 0 100000 400000 0"),
    "22": X.polygon(SQUARE_3D, "1 2 0 3 four 0 5 6 0 1 2 0"),
    "23": X.multivlak(X.polygon(SQUARE_2D, dimension=2), X.polygon("1 2 bad 4 5 6", dimension=2)),
    "24": X.polygon("100000 400000 100010 400000", dimension=2),
    "25": X.polygon("100000 400000 100010 400000 100010", dimension=2),
    "26": X.punt("1"),
}


def write(folder, name, *records):
    (folder / name).write_text(X.document(*records))
    return str(folder)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("records")
    texts = [X.record("Pand", f"05991{k}", g) for k, (g, *_rest) in CASES.items()]
    texts += [X.record("Pand", f"05991{k}", g) for k, g in NULL_CASES.items()]
    texts.append(X.record("Pand", "0599130"))
    return write(path, "a.xml", *texts)


def converted(df):
    rows = convert_geometry(df, "polynomial").select(
        F.expr("string(`Objecten:identificatie`._VALUE)").alias("id"), "geometry.*"
    )
    return {r["id"][-2:]: r for r in rows.collect()}


def check(rows):
    for key, (_, field, members) in CASES.items():
        assert_wkt(rows[key][field], members)
        others = {"geo_multi_polygon", "geo_polygon", "geo_point"} - {field}
        assert all(rows[key][o] is None for o in others)
    for key in [*NULL_CASES, "30"]:
        assert rows[key][1:] == (None, None, None), key


def test_declared_schema(spark, folder):
    check(converted(xml.read_records(spark, folder, "Pand", schemas.core_schema("Pand"))))


def test_without_ansi(spark, folder):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        check(converted(xml.read_records(spark, folder, "Pand", schemas.core_schema("Pand"))))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_xml_source(spark, folder):
    check(converted(xml.read_records(spark, folder, "Pand", schemas.core_schema("Pand"), split=False)))


def test_completed_schema(spark, folder):
    schema = xml.infer_schema(spark, folder, "Pand")
    check(converted(xml.read_records(spark, folder, "Pand", schema)))
    found = spark.read.format("xml").option("rowTag", "sl-bag-extract:bagObject").load(folder)
    assert schema == schemas.record_schema(found.schema, "Pand")


def test_files_are_split_between_tasks(spark, tmp_path):
    records = [X.record("Pand", f"{i:04d}", X.polygon(SQUARE_3D)) for i in range(400)]
    path = write(tmp_path, "a.xml", *records)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = xml.read_records(spark, path, "Pand", schemas.core_schema("Pand"), "file")
        assert df.rdd.getNumPartitions() > 10
        rows = df.select("Objecten:identificatie._VALUE", "file").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(r[0] for r in rows) == [f"{i:04d}" for i in range(400)]
    assert {r["file"].split("/")[-1] for r in rows} == {"a.xml"}


def test_other_spelling_of_the_closing_tag_is_refused_not_lost(spark, tmp_path):
    texts = [X.record("Pand", str(i), X.polygon(SQUARE_3D)) for i in range(3)]
    texts[1] = texts[1].replace("</sl-bag-extract:bagObject>", "</sl-bag-extract:bagObject >")
    path = write(tmp_path, "a.xml", *texts)
    with pytest.raises(Exception, match="split=False"):
        xml.read_records(spark, path, "Pand", schemas.core_schema("Pand")).collect()
    whole = xml.read_records(spark, path, "Pand", schemas.core_schema("Pand"), split=False)
    assert whole.count() == 3


def test_inferred_schema(spark, folder):
    check(converted(xml.read_inferred(spark, folder, "Pand")))


def test_completed_schema_keeps_all_fields_and_leading_zeros(spark, tmp_path):
    extra = "<Objecten:status>Pand in gebruik</Objecten:status>"
    path = write(tmp_path, "a.xml", X.record("Pand", "0599001", X.polygon(SQUARE_3D), more=extra))
    schema = xml.infer_schema(spark, path, "Pand")
    row = xml.read_records(spark, path, "Pand", schema).first()
    assert row["Objecten:identificatie"]["_VALUE"] == "0599001"
    assert row["Objecten:status"] == "Pand in gebruik"
    assert schema["Objecten:Pand"].dataType["Objecten:geometrie"].dataType.names[:1] == ["gml:Polygon"]


def test_single_interior_inferred_as_struct(spark, tmp_path):
    path = write(tmp_path, "a.xml", X.record("Pand", "1", X.vlak(SQUARE_3D, HOLE_3D)))
    rows = convert_geometry(xml.read_inferred(spark, path, "Pand"), "polynomial").select("geometry.geo_polygon")
    assert_wkt(rows.first()[0], [[SQUARE, HOLE]])


def test_position_list_without_attributes_is_plain_text(spark, tmp_path):
    text = X.record("Pand", "1", X.polygon(SQUARE_3D)).replace(' count="4"', "")
    path = write(tmp_path, "a.xml", text)
    for df in (
        xml.read_inferred(spark, path, "Pand"),
        xml.read_records(spark, path, "Pand", schemas.core_schema("Pand")),
    ):
        assert_wkt(convert_geometry(df, "polynomial").select("geometry.geo_polygon").first()[0], [[SQUARE]])


def test_record_without_geometry_column_passes_unchanged(spark, tmp_path):
    path = write(tmp_path, "a.xml", X.record("Nummeraanduiding", "1"))
    df = xml.read_inferred(spark, path, "Nummeraanduiding")
    assert convert_geometry(df, "polynomial").columns == df.columns


def test_versions_of_one_object_stay_apart(spark, tmp_path):
    records = [X.record("Pand", "1", X.polygon(SQUARE_3D), version=v) for v in (1, 2, 2)]
    df = convert_geometry(
        xml.read_records(spark, write(tmp_path, "a.xml", *records), "Pand", schemas.core_schema("Pand"))
    )
    assert df.count() == 3


def test_both_area_kinds_give_one_polygon(spark, tmp_path):
    both = X.vlak(SQUARE_3D) + X.polygon(HOLE_3D)
    path = write(tmp_path, "a.xml", X.record("Pand", "1", both))
    df = convert_geometry(xml.read_records(spark, path, "Pand", schemas.core_schema("Pand")), "polynomial")
    assert_wkt(df.select("geometry.geo_polygon").first()[0], [[SQUARE]])


def test_text_is_fixed_to_sixteen_decimals(spark):
    df = spark.createDataFrame([("155000 463000 0",), ("-300000 100000 0",)], "pos string")
    near, far = [r[0] for r in df.select(gml.point_wkt("pos")).collect()]
    assert near == "POINT (5.3872062100000000 52.1551744000000000)"
    long, lat = far.removeprefix("POINT (").removesuffix(")").split(" ")
    assert len(long.split(".")[1]) == len(lat.split(".")[1]) == 16
    assert (float(long), float(lat)) == pytest.approx(X.to_wgs84(-300000, 100000), abs=1e-9)


def test_projection_methods_agree_within_a_metre(spark):
    df = spark.range(2000).selectExpr(
        "double(20000 + id * 7919 % 250000) AS x", "double(310000 + id * 104729 % 300000) AS y"
    )
    fast, exact = rd_to_wgs84("x", "y"), rd_to_wgs84("x", "y", "geodetic")
    gap = df.select(
        F.max(F.abs(fast.lat - exact.lat) * 111000), F.max(F.abs(fast.long - exact.long) * 69000)
    ).first()
    assert max(gap) < 0.5


def test_geodetic_at_and_beside_the_origin(spark):
    df = spark.createDataFrame(
        [(155000.0, 463000.0), (155000.0, 463100.0), (155100.0, 463000.0)], "x double, y double"
    )
    at = rd_to_wgs84("x", "y", "geodetic")
    for row, xy in zip(df.select(at.long, at.lat).collect(), df.collect(), strict=True):
        assert tuple(row) == pytest.approx(X.to_wgs84(*xy), abs=1e-5)


def test_geodetic_wkt(spark):
    df = spark.createDataFrame([(SQUARE_2D,)], "pos string")
    text = df.select(gml.ring_text("pos", 2, "geodetic", 9)).first()[0]
    points = X.numbers_of(f"POLYGON ({text})")[0][0]
    for got, xy in zip(points, SQUARE, strict=True):
        assert got == pytest.approx(X.to_wgs84(*xy), abs=1e-5)
