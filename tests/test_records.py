"""Records that do not end or parse, records without a schema, and what a schema misses."""

from __future__ import annotations

import pytest
import samples as X
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.catalog.queries import QUERIES
from terravane.sources import drift, schemas, variants, xml

SMALL = "/root/testdata/sf0.001"
SQUARE, HOLE = "1 1 0 9 1 0 9 9 0 1 1 0", "2 2 0 3 2 0 3 3 0 2 2 0"
CLOSING = "</sl-bag-extract:bagObject>"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def broken_file(folder):
    """Eight records: the third lacks an inner closing tag, the fifth and the last their own."""
    texts = [X.record("Pand", f"0{i}", X.polygon(SQUARE, HOLE)) for i in range(8)]
    texts[2] = texts[2].replace("</gml:posList>", "", 1)
    texts[4] = texts[4].replace(CLOSING, "")
    texts[7] = texts[7].replace(CLOSING, "")
    (folder / "a.xml").write_text(X.document(*texts))
    return str(folder)


def test_both_readers_agree_on_a_malformed_file(spark, tmp_path):
    path, schema = broken_file(tmp_path), schemas.core_schema("Pand")
    ids = {}
    for split in (True, False):
        rows = xml.read_records(spark, path, "Pand", schema, "file", split=split)
        bad = xml.bad_records(spark, path, schema, split=split)
        ids[split] = sorted(r[0] for r in rows.select(f"`{K.ID_FIELD}`._VALUE").collect())
        texts = sorted(r["record"] for r in bad.collect())
        assert len(texts) == 3 and all(t.startswith("<sl-bag-extract:bagObject>") for t in texts)
        assert [i for i in range(8) if any(f">0{i}</Objecten" in t for t in texts)] == [2, 4, 7]
    assert ids[True] == ids[False] == ["00", "01", "03", "05", "06"]


@pytest.mark.parametrize("name", ["xml_scan_split", "xml_scan_schema", "xml_from_text", "xml_bad_records", "xml_scan_variant"])
def test_a_record_is_parsed_once(spark, name):
    plan = optimized(QUERIES[name](spark, SMALL))
    assert plan.count("from_xml") == 1 and plan.count("Relation") == 1


def test_bad_and_good_records_come_from_one_scan(spark, tmp_path):
    rows = xml.parsed(
        xml.record_texts(spark, broken_file(tmp_path), "file"), "record", schemas.core_schema("Pand")
    ).groupBy(F.col(xml.CORRUPT).isNotNull()).count()
    assert sorted(tuple(r) for r in rows.collect()) == [(False, 5), (True, 3)]


def test_variants_equal_the_fixed_schema(spark, tmp_path):
    texts = [X.record("Pand", "0012", X.polygon(SQUARE)), X.record("Pand", "07", X.polygon(SQUARE, HOLE))]
    texts += [X.record("Pand", "3", X.polygon(SQUARE, HOLE, SQUARE)), X.record("Pand", "4"), X.record("Woonplaats", "5")]
    (tmp_path / "a.xml").write_text(X.document(*texts))
    area, ring = (K.GEOMETRY_FIELD, "gml:Polygon"), ("gml:LinearRing", "gml:posList")
    rows = variants.read_variants(spark, str(tmp_path), "Pand").select(
        variants.identifier("record").alias("id"),
        variants.text("fields", *area, "gml:exterior", *ring).alias("outer"),
        F.transform(variants.listed("fields", *area, "gml:interior"), lambda v: variants.text(v, *ring)).alias("inner"),
    )
    fixed = xml.read_records(spark, str(tmp_path), "Pand", schemas.core_schema("Pand"))
    polygon = f"`{K.GEOMETRY_FIELD}`.`gml:Polygon`"
    text = "`gml:LinearRing`.`gml:posList`._VALUE"
    fixed = fixed.selectExpr(
        f"`{K.ID_FIELD}`._VALUE AS id", f"{polygon}.`gml:exterior`.{text} AS outer",
        f"coalesce(transform({polygon}.`gml:interior`, i -> i.{text}), array()) AS inner",
    ).where("id IS NOT NULL")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, fixed.collect()))
    assert rows.count() == 4


@pytest.mark.parametrize(
    ("text", "shape"),
    [
        ("VOID", "VOID"),
        ("BIGINT", "BIGINT"),
        ("ARRAY<OBJECT<a: STRING, `b:c`: ARRAY<DOUBLE>>>", [{"a": "STRING", "b:c": ["DOUBLE"]}]),
        ("OBJECT<`a, <x>`: VOID, `q``r`: OBJECT<>>", {"a, <x>": "VOID", "q`r": {}}),
    ],
)
def test_shapes(text, shape):
    assert drift.shape_of(text) == shape


def test_shapes_as_spark_writes_them(spark):
    row = spark.sql("""SELECT schema_of_variant(parse_json('{"a:b": [1, {"c`d": "x"}], "e": {}, "f": 1.5}')) AS s""").first()
    assert drift.shape_of(row["s"].replace("DECIMAL(2,1)", "DECIMAL")).keys() == {"a:b", "e", "f"}


SAVED = "a struct<x: bigint, y: array<string>, z: struct<_VALUE: double, _n: bigint>, t: string, d: date>"


@pytest.mark.parametrize(
    ("found", "want"),
    [
        ({"a": {"x": "BIGINT", "y": "STRING", "z": "DECIMAL", "t": "DOUBLE", "d": "DATE"}}, set()),
        ({"a": "VOID"}, set()),
        ({"a": {"y": ["BIGINT"], "z": {"_VALUE": "BIGINT", "_n": "BIGINT"}}}, set()),
        ({"a": {"x": "STRING", "z": "STRING", "d": "TIMESTAMP"}}, {("a/x", "retyped"), ("a/z", "retyped"), ("a/d", "retyped")}),
        ({"a": {"x": ["BIGINT"], "t": ["STRING"]}, "b": "VOID"}, {("a/x", "repeated"), ("a/t", "repeated"), ("b", "added")}),
        ({"a": {"t": {"u": "STRING"}, "x": {"_VALUE": "BIGINT", "_m": "STRING"}}}, {("a/t", "nested"), ("a/x/_m", "added")}),
        ({"a": "STRING"}, {("a", "retyped")}),
        ({"a": {"z": {"_VALUE": "STRING", "w": "VOID"}}}, {("a/z/_VALUE", "retyped"), ("a/z/w", "added")}),
    ],
)
def test_differences(spark, found, want):
    assert set(drift.differences(found, T.StructType.fromDDL(SAVED))) == want


def test_drift_of_odd_extracts(spark, tmp_path):
    schema = schemas.core_schema("Pand")
    assert drift.schema_drift(spark, broken_file(tmp_path), schema).collect() == []
    (tmp_path / "a.xml").write_text(X.document())
    assert drift.schema_drift(spark, str(tmp_path), schema).collect() == []
