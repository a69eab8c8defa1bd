"""Joins, unions, model rules, and the shape of the plans."""

from __future__ import annotations

import pytest
from compare import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.catalog.queries import QUERIES
from terravane.operators import quality
from terravane.operators.attach import attach
from terravane.operators.columns import align_columns, has_path, type_at, union_all
from terravane.operators.geometry import complete_geometry
from terravane.operators.vertices import VERTEX_SCHEMA, vertex_table
from terravane.plans import model
from terravane.plans.dimension import geo_dimension
from terravane.sources.files import write_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- attach ----------------------------------------------------------------------------------


def sides(spark):
    left = [(i % 5 if i % 6 else None, i % 2, f"l{i}") for i in range(60)] + [(77, 0, "x")] * 40
    right = [(i % 7 if i % 4 else None, i % 2, f"r{i}") for i in range(40)] + [(77, 0, "y")] * 3
    a = spark.createDataFrame(left, "id int, v int, l string").select(F.struct("id", "v").alias("k"), "l")
    b = spark.createDataFrame(right, "rid int, rv int, r string")
    return a, b


def test_full_attach_equals_a_full_join(spark):
    a, b = sides(spark)
    got = attach(a, b, {"k.id": "rid", "k.v": "rv"}).select("k.id", "k.v", "l", "rid", "rv", "r")
    want = a.join(b, (a.k.id == b.rid) & (a.k.v == b.rv), "full").select("k.id", "k.v", "l", "rid", "rv", "r")
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_other_joins(spark, how):
    a, b = sides(spark)
    got = attach(a, b, {"k.id": "rid", "k.v": "rv"}, how).select("l", "rid", "r")
    want = a.join(b, (a.k.id == b.rid) & (a.k.v == b.rv), how).select("l", "rid", "r")
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect())


def test_full_attach_shuffles_each_side_once(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["full_outer_attach"](spark, sf_dir)
        df.collect()
        text = plan(df).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert text.count("ReusedExchange") == 2
    assert "FullOuter" not in text


# --- columns ---------------------------------------------------------------------------------


def test_paths():
    schema = T.StructType().add("a", T.StructType().add("b", T.LongType()))
    assert has_path(schema, "a", "b") and type_at(schema, "a", "b") == T.LongType()
    assert not has_path(schema, "a", "c") and not has_path(schema, "a", "b", "c")


def test_union_of_none_and_of_differing_names(spark):
    assert union_all(spark, [], VERTEX_SCHEMA).schema == VERTEX_SCHEMA
    assert vertex_table(spark, {}).count() == 0
    schema = T.StructType().add("a", "integer").add("b", "string")
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    other = spark.createDataFrame([("y", 2)], "b string, a int")
    assert sorted(map(tuple, union_all(spark, [one, other], schema).collect())) == [(1, "x"), (2, "y")]


def test_alignment_and_backfill(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert align_columns(df, ["b", "a", "c"]).columns == ["a", "b", "c"]
    shaped = df.select(F.struct(F.lit("p").alias("geo_point")).alias("geometry"))
    assert tuple(complete_geometry(shaped).first()["geometry"]) == (None, None, "p")


# --- rules -----------------------------------------------------------------------------------


def test_orphans_with_a_hot_value(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(9,)] * 30 + [(None,)] * 20 + [(2,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "pk int")
    got = quality.check_foreign_key(child, "fk", parent, "pk").collect()
    assert [tuple(r) for r in got] == [(9, 30)]
    assert quality.orphan_rows(child, "fk", parent, "pk").count() == 30


def test_bridge_skips_blanks_and_repeats(spark):
    df = spark.createDataFrame([(1, " a x , b, a x,"), (2, None), (3, " ")], "k int, v string")
    arrays = df.select("k", F.split("v", ",").alias("v"))
    for table in (df, arrays):
        got = quality.bridge_table(table, "k", "v", ("k", "w")).collect()
        assert sorted(map(tuple, got)) == [(1, "a x"), (1, "b")]


def test_a_null_key_is_not_repeated(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1)], "k int, v int")
    assert [tuple(r) for r in quality.check_unique(df, ["k", "v"]).collect()] == [(2, 1, 2)]


def test_model_is_complete():
    assert len(model.TABLES) == 11 and len(model.FOREIGN_KEYS) == 13 and len(model.UNIQUE_KEYS) == 9
    for key in model.FOREIGN_KEYS:
        assert key.column in model.table_schema(key.table).names
        assert key.parent_column in model.table_schema(key.parent).names
    for table, limits in model.MAX_LENGTHS.items():
        assert set(limits) <= set(model.table_schema(table).names)


def test_conform(spark):
    df = spark.createDataFrame([("1", "2022-11-01"), ("x", "soon")], "a string, d string")
    got = model.conform(df, "verblijfsobject", {"oppervlakte": "a", "documentdatum": "d"})
    assert [f.dataType for f in got.schema] == [f.dataType for f in model.table_schema("verblijfsobject")]
    assert [r["oppervlakte"] for r in got.collect()] == [1, None]
    dated = model.conform(df, "pand", {"documentdatum": F.col("d")})
    assert [str(r["documentdatum"]) for r in dated.collect()] == ["2022-11-01", "None"]
    with pytest.raises(ValueError):
        model.conform(df, "pand", {"geometrie": "a"})


def test_report_counts_rows_per_rule(spark):
    towns = spark.createDataFrame(
        [("0599", "Woonplaats aangewezen"), ("0599", "?"), ("05990", None)], "identificatie string, status string"
    )
    streets = spark.createDataFrame([("1", "0599"), ("2", "0001"), ("3", None)], "identificatie string, w string")
    report = model.model_report(
        {
            "woonplaats": model.conform(towns, "woonplaats", {"identificatie": "identificatie", "status": "status"}),
            "openbare_ruimte": model.conform(
                streets, "openbare_ruimte", {"identificatie": "identificatie", "woonplaats_identificatie": "w"}
            ),
        }
    )
    found = {(r["table_name"], r["rule"], r["column_name"]): r["n_violations"] for r in report.collect()}
    assert found["woonplaats", "unique", "identificatie"] == 2
    assert found["woonplaats", "domain", "status"] == 1
    assert found["woonplaats", "not_null", "status"] == 1
    assert found["woonplaats", "not_null", "naam"] == 3
    assert found["woonplaats", "max_length", "identificatie"] == 1
    assert found["openbare_ruimte", "foreign_key", "woonplaats_identificatie"] == 1
    assert found["openbare_ruimte", "unique", "identificatie"] == 0


# --- plans -----------------------------------------------------------------------------------

MAP_ONLY = [
    "polygon_wkt", "area_wkt", "multipolygon_wkt", "point_wkt", "polygon_vertices",
    "multipolygon_vertices", "point_rows", "geo_dimension", "geo_dimension_literal",
    "nearest_cell", "nearest_cell_literal", "rd_to_wgs84_geodetic", "chunk_columns", "conform",
    "drop_null_rows", "suffix_filter", "ingest_table", "xml_scan_schema",
]


@pytest.mark.parametrize("name", MAP_ONLY)
def test_map_only(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Exchange", "Join", "Python", "MapInArrow"):
        assert node not in text


def test_no_query_uses_a_cartesian_product_or_python(spark, sf_dir):
    for name, query in QUERIES.items():
        text = plan(query(spark, sf_dir))
        if name == "schema_drift":  # Python sees the distinct shapes of records, counted before, and no record
            above, below = text.split("MapInArrow compare(shape")
            assert "MapInArrow" not in below and "HashAggregate(keys=[_groupingexpression" in below
            text = above
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInArrow"):
            assert node not in text, name


def test_stored_dimension_prunes_and_pushes_down(spark, sf_dir, tmp_path, capsys):
    from terravane.catalog.queries import _pand_tables

    df = _pand_tables(spark, sf_dir).withColumn("unused", F.lit("x"))
    write_table(df, f"{tmp_path}/Pand")
    rows = geo_dimension(spark, str(tmp_path), "Pand")
    rows.explain("formatted")
    text = capsys.readouterr().out
    for field in ("geo_multi_polygon", "geo_polygon", "geo_point"):
        assert f"IsNotNull(geometry.{field})" in text
        assert f"geometry:struct<{field}:string>>" in text
    assert "unused" not in text and "Exchange" not in text
    assert rows.count() == QUERIES["geo_dimension"](spark, sf_dir).where("objType = 'Pand'").count()


def test_scan_reads_what_it_needs(spark, sf_dir):
    text = plan(QUERIES["parquet_scan"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "o_orderpriority" not in text


# --- hot keys --------------------------------------------------------------------------------


@pytest.fixture
def small_skew_limits(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot(spark, key: str, payload: str):
    """A third of the rows share key 7; incompressible payloads make bytes follow rows."""
    return spark.range(0, 60000, 1, 8).selectExpr(
        f"if(id % 3 = 0, 7, id) AS {key}", f"sha2(string(id), 256) AS {payload}"
    )


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_hot_key_is_split_in_a_full_attach(spark, small_skew_limits):
    left = hot(spark, "k", "l")
    right = spark.range(0, 90000, 1, 4).selectExpr("id AS r", "sha2(string(-id), 256) AS v")
    for a, b, keys in ((left, right, {"k": "r"}), (right, left, {"r": "k"})):
        df = attach(a, b, keys)
        assert "skew=true" in final_plan(df)
        # every left row matches one of 40,000 right keys; the other right keys stay alone
        assert df.count() == 60000 + (90000 - 40000)


def test_hot_orphan_is_split(spark, small_skew_limits):
    child = hot(spark, "k", "l")
    parent = spark.range(100, 50000).selectExpr("id AS p")
    df = quality.orphan_rows(child, "k", parent, "p")
    assert "skew=true" in final_plan(df)
    keys = quality.check_foreign_key(child, "k", parent, "p")
    counts = {r["value"]: r["n_rows"] for r in keys.collect()}
    assert counts[7] == 20001 and sum(counts.values()) == df.count()


def test_hot_part_is_written_by_several_tasks(spark, small_skew_limits, tmp_path):
    from terravane.sources.files import read_table, write_parts

    df = hot(spark, "k", "l").withColumn("p", F.when(F.col("k") == 7, 0).otherwise(F.col("k") % 5 + 1))
    write_parts(df, str(tmp_path / "t"), F.col("p"), rebalance=True)
    assert len(list((tmp_path / "t" / "part=0").glob("*.parquet"))) > 1
    assert read_table(spark, str(tmp_path / "t")).count() == 60000
