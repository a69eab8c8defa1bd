"""One query per operator, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.catalog import shapes as S
from terravane.functions import gml, grid, names
from terravane.functions.projection import rd_to_wgs84
from terravane.operators import chunks, quality, vertices
from terravane.operators.attach import attach
from terravane.operators.columns import align_columns, drop_null, expand_struct, path_or_null, record_ids, union_all
from terravane.operators.geometry import complete_geometry, convert_geometry, geometry_struct
from terravane.plans import chunking, dimension, model
from terravane.plans.dimension import geo_dimension as stored_geo_dimension
from terravane.plans.ingest import object_table
from terravane.sources import deliveries, drift, files, members, schemas, variants, xml
from terravane.sources.workspace import work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks -------------------------------------------------------------------


def _id_text() -> str:
    return f"`{K.ID_FIELD}`._VALUE"


def _version() -> str:
    return f"`{K.HISTORY_FIELD}`.`{K.HISTORY_PATH[0]}`.`{K.HISTORY_PATH[1]}`"


@query
def xml_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "xml-supplier")
    record = F.expr(S.record("s_suppkey", "punt", **{"Objecten:naam": "s_name"}))
    xml.write_records(S.table(spark, sf_dir, "supplier"), folder, "Verblijfsobject", record)
    df = xml.read_inferred(spark, folder, "Verblijfsobject")
    return df.select(
        F.expr(_id_text()).alias("identificatie"),
        F.expr(f"`{K.ID_FIELD}`._domein").alias("domein"),
        F.col("`Objecten:naam`").alias("naam"),
        F.expr(f"`{K.GEOMETRY_FIELD}`.`Objecten:punt`.`gml:Point`.`gml:pos`").alias("pos"),
        F.expr(_version()).alias("versie"),
    )


def _orders_xml(spark: SparkSession, sf_dir: str, split: bool) -> DataFrame:
    folder = work_folder(spark, "xml-orders")
    record = F.expr(S.record("o_orderkey", "polygon", version="o_orderkey % 3"))
    xml.write_records(S.table(spark, sf_dir, "orders"), folder, "Pand", record)
    df = xml.read_records(spark, folder, "Pand", schemas.core_schema("Pand"), split=split)
    area = f"`{K.GEOMETRY_FIELD}`.`gml:Polygon`"
    return df.selectExpr(
        f"{_id_text()} AS identificatie",
        f"{_version()} AS versie",
        f"{area}._srsDimension AS dimensie",
        f"{area}.`gml:exterior`.`gml:LinearRing`.`gml:posList`._VALUE AS outer_text",
        f"coalesce(array_size({area}.`gml:interior`), 0) AS n_inner",
    )


@query
def xml_scan_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_xml(spark, sf_dir, split=False)


@query
def xml_scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_xml(spark, sf_dir, split=True)


@query
def xml_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(F.expr(S.record("c_custkey", "polygon")).alias("Objecten:Pand"))
    text = S.table(spark, sf_dir, "customer").select(
        F.to_xml(record, {"rowTag": K.XML_ROW, "validateName": "false"}).alias("record")
    )
    df = xml.parse_records(text, "record", "Pand", schemas.core_schema("Pand"))
    return record_ids(
        df,
        F.expr(
            f"`{K.GEOMETRY_FIELD}`.`gml:Polygon`.`gml:exterior`.`gml:LinearRing`.`gml:posList`._VALUE"
        ).alias("outer_text"),
    )


@query
def xml_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract of all orders, some without an inner or their own closing tag: every record with
    whether it is malformed, good and bad ones from one pass."""
    record = F.struct(F.expr(S.record("o_orderkey", "polygon")).alias("Objecten:Pand"))
    text = F.to_xml(record, {"rowTag": K.XML_ROW, "validateName": "false"})
    inner = F.when(F.col("o_orderkey") % 13 == 0, F.replace(text, F.lit(f"</{K.ID_FIELD}>"), F.lit(""))).otherwise(text)
    outer = F.when(F.col("o_orderkey") % 17 == 0, F.replace(inner, F.lit(f"</{K.XML_ROW}>"), F.lit(""))).otherwise(inner)
    folder = work_folder(spark, "xml-broken")
    S.table(spark, sf_dir, "orders").select(outer.alias("value")).write.text(folder)
    rows = xml.parsed(xml.record_texts(spark, folder, "file"), "record", schemas.core_schema("Pand"))
    number = F.regexp_extract(xml.CORRUPT, r"0599(\d{12})", 1)
    found = F.coalesce(F.col(f"`Objecten:Pand`.{_id_text()}").substr(5, 12), number)
    return rows.select(found.cast("bigint").alias("o_orderkey"), F.col(xml.CORRUPT).isNotNull().alias("malformed"))


@query
def xml_scan_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of record read without a schema: points of suppliers, polygons of customers."""
    found = []
    for name, key, shape in (("supplier", "s_suppkey", "punt"), ("customer", "c_custkey", "polygon")):
        folder = work_folder(spark, f"xml-{name}")
        record = F.expr(S.record(key, shape, version=f"{key} % 3"))
        xml.write_records(S.table(spark, sf_dir, name), folder, "Verblijfsobject", record)
        found.append(folder)
    rows = variants.read_variants(spark, found, "Verblijfsobject")
    area, ring = (K.GEOMETRY_FIELD, "gml:Polygon"), ("gml:LinearRing", "gml:posList")
    return rows.select(
        variants.identifier("record").alias("identificatie"),
        variants.field("fields", *K.HISTORY_FIELDS, kind="bigint").alias("versie"),
        variants.field("fields", K.GEOMETRY_FIELD, "Objecten:punt", "gml:Point", "gml:pos").alias("pos"),
        variants.field("fields", *area, "_srsDimension", kind="bigint").alias("dimensie"),
        variants.text("fields", *area, "gml:exterior", *ring).alias("outer_text"),
        F.size(variants.listed("fields", *area, "gml:interior")).alias("n_inner"),
        variants.text(F.get(variants.listed("fields", *area, "gml:interior"), 0), *ring).alias("inner_text"),
    )


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract of all parts against the schema saved from an earlier one: an element more, one
    that repeats, one whose numbers became text, and one that became a structure."""
    folder, k = work_folder(spark, "xml-drift"), "p_partkey"
    more = {
        "Objecten:naam": "if(p_partkey % 10 = 1, array(p_name, p_brand), array(p_name))",
        "Objecten:oppervlakte": "if(p_partkey % 7 = 2, concat('x', p_size), string(p_size))",
        "Objecten:status": "if(p_partkey % 5 = 3, named_struct('_VALUE', NULL, '_sinds', '2022'), named_struct('_VALUE', p_type, '_sinds', NULL))",
        "Objecten:nieuw": "if(p_partkey % 3 = 0, named_struct('Objecten:deel', p_brand), NULL)",
    }
    xml.write_records(S.table(spark, sf_dir, "part"), folder, "Woonplaats", F.expr(S.record(k, "multivlak", **more)))
    saved = "`Objecten:Woonplaats` struct<`Objecten:naam`: string, `Objecten:oppervlakte`: bigint, `Objecten:status`: string>"
    schema = schemas.record_schema(T.StructType.fromDDL(saved), "Woonplaats")
    path = work_folder(spark, "schema-drift")
    schemas.save_schema(spark, schema, path)
    return drift.schema_drift(spark, folder, schemas.load_schema(spark, path))


@query
def schema_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "schema")
    schemas.save_schema(spark, S.table(spark, sf_dir, "lineitem").schema, path)
    schema = schemas.load_schema(spark, path)
    df = spark.read.schema(schema).parquet(f"{sf_dir}/lineitem.parquet")
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("sum_qty"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = files.read_table(spark, f"{sf_dir}/orders.parquet")
    return df.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "customer")
    files.write_table(S.table(spark, sf_dir, "customer"), folder)
    return files.read_table(spark, folder)


SOURCE_FILES = 6400


@query
def batched_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "parts")
    number = F.pmod(F.col("o_orderkey"), F.lit(SOURCE_FILES)) + 1
    name = F.concat(F.lit("bag/9999PND08102022-"), F.lpad(number.cast("string"), 6, "0"), F.lit(".xml"))
    df = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", name.alias("file"))
    files.write_parts(df, folder, names.batch_of(F.col("file")), rebalance=True)
    return files.part_counts(files.read_table(spark, folder))


@query
def archive_type_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = F.concat(F.lit("data/9999"), F.col("s_name"), F.lit("08102022.zip"))
    member = F.concat(F.lit("tmp/"), F.col("s_suppkey").cast("string"), F.lit(".xml"))
    return S.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        names.archive_type(archive).alias("type_key"),
        names.member_path("bag/xml", archive, member).alias("blob_path"),
    )


@query
def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers written into nested archives and read back straight from them."""
    folder, k = work_folder(spark, "archives"), F.col("s_suppkey")
    record = F.struct(F.expr(S.record("s_suppkey", "punt", **{"Objecten:naam": "s_name"})).alias("Objecten:Verblijfsobject"))
    text = F.to_xml(record, {"rowTag": K.XML_ROW, "validateName": "false"})
    number = F.lpad(F.floor(k / 20).cast("string"), 6, "0")
    rows = S.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("lvbag-"), F.floor(k / 1000).cast("string"), F.lit(".zip")).alias("archive"),
        F.concat(F.lit("9999VBO"), F.floor(k / 100).cast("string"), F.lit(".zip")).alias("inner"),
        F.concat(F.lit("9999VBO08102022-"), number, F.lit(".xml")).alias("member"),
        text.alias("record"),
    )
    packed = rows.groupBy("archive", "inner", "member").agg(F.listagg("record", F.lit("\n")).alias("content"))
    members.write_archives(packed, folder).write.format("noop").mode("overwrite").save()
    more = T.StructType([T.StructField("Objecten:naam", T.StringType())])
    schema = schemas.record_schema(T.StructType([T.StructField("Objecten:Verblijfsobject", more)]), "Verblijfsobject")
    found = xml.parse_records(members.archive_records(spark, folder), "record", "Verblijfsobject", schema)
    return found.select(
        F.expr(_id_text()).alias("identificatie"),
        F.col("`Objecten:naam`").alias("naam"),
        F.expr(f"`{K.GEOMETRY_FIELD}`.`Objecten:punt`.`gml:Point`.`gml:pos`").alias("pos"),
        F.col("archive").alias("inner_archive"),
        "member",
    )


@query
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part folders of one type found by listing its files, beside a type whose name goes on from it."""
    root = work_folder(spark, "listed")
    orders = S.table(spark, sf_dir, "orders").select("o_orderkey")
    files.write_parts(orders, f"{root}/Pand", F.pmod(F.col("o_orderkey"), F.lit(37)))
    files.write_parts(orders, f"{root}/Pand_geo_splitted", F.lit(99))
    found = files.list_files(spark, f"{root}/Pand").where("length > 0")
    part = F.regexp_extract("path", r"/Pand/part=(\d+)/[^/]+$", 1)
    return found.select(part.cast("int").alias("part")).distinct()


@query
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in three deliveries by key: each run takes the files that came since the one before."""
    folder, state, target = (work_folder(spark, f"deliveries-{n}") for n in ("xml", "state", "table"))
    orders, schema = S.table(spark, sf_dir, "orders"), schemas.core_schema("Pand")
    record = F.struct(F.expr(S.record("o_orderkey", "polygon")).alias("Objecten:Pand"))
    text = F.to_xml(record, {"rowTag": K.XML_ROW, "validateName": "false"})
    number = F.coalesce(F.abs(F.col("o_orderkey") % 3), F.lit(0))
    for delivery in (0, 1, 2, None):
        if delivery is not None:
            some = orders.where(number == delivery).select(text.alias("value"))
            some.write.mode("append").text(folder)
        deliveries.ingest_new(spark, folder, "Pand", schema, target, state, "polynomial", suffix=".txt")
    rows = files.read_table(spark, f"{target}/records")
    return rows.select(F.expr(_id_text()).alias("identificatie"), F.col("delivery").cast("bigint").alias("delivery"))


@query
def replaced_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in parts by key: two parts written anew, and those gone that a manifest lost."""
    folder = work_folder(spark, "replaced")
    part = F.floor(F.pmod(F.col("o_orderkey"), F.lit(SOURCE_FILES)) / 100).cast("int")
    orders = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", part.alias("part"))
    files.write_parts(orders, folder, F.col("part"), rebalance=True)
    again = orders.where("part IN (3, 5) AND o_orderkey % 2 = 0").withColumn("o_custkey", -F.col("o_custkey"))
    files.replace_parts(again, folder, F.col("part"))
    files.drop_lost_parts(spark, folder, orders.select("part").distinct().where("part % 10 <> 7"))
    return files.read_table(spark, folder)


@query
def ingest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML to the stored object table and back: scan, geometry, Parquet."""
    source, target = work_folder(spark, "xml-part"), work_folder(spark, "table-part")
    record = F.expr(S.record("p_partkey", "multivlak", **{"Objecten:naam": "p_name"}))
    xml.write_records(S.table(spark, sf_dir, "part"), source, "Woonplaats", record)
    schema = xml.infer_schema(spark, source, "Woonplaats")
    files.write_table(object_table(spark, source, "Woonplaats", schema, "polynomial"), target)
    return record_ids(
        files.read_table(spark, target),
        F.col("`Objecten:naam`").alias("naam"),
        "geometry.geo_multi_polygon",
        "geometry.geo_polygon",
        "geometry.geo_point",
    )


# --- projections and filters ---------------------------------------------------------------


@query
def struct_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = S.table(spark, sf_dir, "part").select(
        F.struct("p_partkey", "p_name", "p_size").alias("Objecten:Pand")
    )
    return expand_struct(wrapped, "Objecten:Pand")


@query
def nested_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "lineitem")
    records = S.records(
        df, "l_orderkey", None, "l_partkey", "l_quantity", version="l_linenumber"
    )
    return record_ids(records, "l_partkey")


@query
def struct_fields_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A geometry struct of one field, backfilled to all three in fixed order."""
    df = S.table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.struct(F.expr(S.point_text("s_suppkey")).alias("geo_point")).alias("geometry")
    )
    return complete_geometry(df).select("s_suppkey", "geometry.*")


@query
def conditional_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a type that has geometry and of one that has none, by the tables' schemas."""
    places = S.records(S.table(spark, sf_dir, "nation"), "n_nationkey", None)
    frames = [("Verblijfsobject", _point_tables(spark, sf_dir)), ("Nummeraanduiding", convert_geometry(places))]
    rows = [
        record_ids(df, F.lit(name).alias("objType"), path_or_null(df, "geometry", "geo_point").alias("wkt"))
        for name, df in frames
    ]
    return rows[0].unionByName(rows[1])


@query
def packed_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _point_tables(spark, sf_dir)
    return df.select("s_suppkey", "geometry.geo_multi_polygon", "geometry.geo_polygon", "geometry.geo_point")


@query
def align_to_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return align_columns(df, ["p_partkey", "geo_polygon_0", "geo_polygon_1"])


@query
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(S.point_text("o_orderkey")).alias("geo_point")
    )
    return drop_null(df, "geo_point")


@query
def suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "pages").select("page_id", "url")
    return df.where(names.has_suffix(F.col("url"), "#top"))


# --- geometry ------------------------------------------------------------------------------


@query
def poslist_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = S.table(spark, sf_dir, "customer").select(
        "c_custkey", F.posexplode(gml.position_pairs(S.outer_text("c_custkey"), 3)).alias("pos", "pair")
    )
    return pairs.select("c_custkey", "pos", "pair.x", "pair.y")


def _anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"double({S.x0('c_custkey')}) AS x", f"double({S.y0('c_custkey')}) AS y"
    )


@query
def rd_to_wgs84_polynomial(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = rd_to_wgs84("x", "y")
    return _anchors(spark, sf_dir).select("c_custkey", at.lat.alias("lat"), at.long.alias("long"))


def _e6(degrees: Column) -> Column:
    return F.floor(degrees * 1e6 + 0.5).cast("bigint")


@query
def rd_to_wgs84_geodetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = rd_to_wgs84("x", "y", "geodetic")
    return _anchors(spark, sf_dir).select(
        "c_custkey", _e6(at.lat).alias("lat_e6"), _e6(at.long).alias("long_e6")
    )


@query
def point_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = S.point_text("s_suppkey")
    return S.table(spark, sf_dir, "supplier").select("s_suppkey", gml.point_wkt(text).alias("wkt"))


def _pand_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "customer")
    return convert_geometry(S.records(df, "c_custkey", "polygon", "c_custkey"), "polynomial")


def _area_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "orders")
    return convert_geometry(S.records(df, "o_orderkey", "vlak", "o_orderkey"), "polynomial")


def _multi_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "part")
    return convert_geometry(S.records(df, "p_partkey", "multivlak", "p_partkey"), "polynomial")


def _point_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "supplier")
    return convert_geometry(S.records(df, "s_suppkey", "punt", "s_suppkey"), "polynomial")


@query
def polygon_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pand_tables(spark, sf_dir).select("c_custkey", F.col("geometry.geo_polygon").alias("wkt"))


@query
def area_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_tables(spark, sf_dir).select("o_orderkey", F.col("geometry.geo_polygon").alias("wkt"))


@query
def multipolygon_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _multi_tables(spark, sf_dir).select(
        "p_partkey", F.col("geometry.geo_multi_polygon").alias("wkt")
    )


@query
def polygon_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _pand_tables(spark, sf_dir).select("c_custkey", F.col("geometry.geo_polygon").alias("wkt"))
    return vertices.polygon_vertices(df, "wkt")


@query
def polygon_vertices_all_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _pand_tables(spark, sf_dir).select("c_custkey", F.col("geometry.geo_polygon").alias("wkt"))
    return vertices.polygon_vertices(df, "wkt", rings="all")


@query
def multipolygon_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _multi_tables(spark, sf_dir).select(
        "p_partkey", F.col("geometry.geo_multi_polygon").alias("wkt")
    )
    return vertices.multipolygon_vertices(df, "wkt")


@query
def point_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _point_tables(spark, sf_dir).select("s_suppkey", F.col("geometry.geo_point").alias("wkt"))
    return vertices.point_vertices(df, "wkt")


def _event_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{S.event_lat('event_id')} AS lat", f"{S.event_long('event_id')} AS long"
    )


@query
def grid_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_places(spark, sf_dir).select(
        "event_id", grid.grid_index("lat", "long").alias("grid_index")
    )


@query
def grid_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.pmod(F.col("c_custkey") * 1048583, F.lit(K.GRID_ROWS * K.GRID_COLUMNS))
    df = S.table(spark, sf_dir, "customer").select("c_custkey", cell.alias("cell"))
    return df.select(
        "c_custkey",
        "cell",
        grid.cell_lat("cell").alias("lat"),
        grid.cell_long("cell").alias("long"),
    )


@query
def nearest_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_places(spark, sf_dir).select(
        "event_id", grid.nearest_cell("lat", "long").alias("refID")
    )


@query
def nearest_cell_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _event_places(spark, sf_dir)
    return places.select(
        "event_id",
        grid.nearest_cell_literal("lat", "long").alias("refID"),
        grid.nearest_cell_literal("long", "lat").alias("swapped_refID"),
    )


def _dimension(spark: SparkSession, sf_dir: str, literal: bool) -> DataFrame:
    sources = {
        "Verblijfsobject": _point_tables(spark, sf_dir),
        "Woonplaats": _multi_tables(spark, sf_dir),
        "Pand": _pand_tables(spark, sf_dir),
    }
    return vertices.vertex_table(spark, sources, literal)


@query
def geo_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, literal=False)


@query
def geo_dimension_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, literal=True)


@query
def stored_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension job over a stored object table."""
    folder = work_folder(spark, "tables")
    files.write_table(_pand_tables(spark, sf_dir).drop("c_custkey"), f"{folder}/Pand")
    return stored_geo_dimension(spark, folder, "Pand")


@query
def dimension_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of a box, looked up in a dimension stored along the curve."""
    folder = work_folder(spark, "by-place")
    dimension.write_by_place(_dimension(spark, sf_dir, literal=False), folder)
    return dimension.window(spark, folder, 51.9, 4.4, 52.4, 5.1)


# --- joins and unions ----------------------------------------------------------------------


@query
def full_outer_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = S.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("struct(struct(o_custkey AS id, pmod(o_orderkey, 2) AS version) AS key)").alias("o"),
    )
    customers = S.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.expr("pmod(c_custkey, 2) AS c_version")
    )
    joined = attach(orders, customers, {"o.key.id": "c_custkey", "o.key.version": "c_version"})
    return joined.select(
        "o_orderkey", F.col("o.key.id").alias("o_custkey"), "c_custkey", "c_mktsegment"
    )


@query
def union_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tagged(df: DataFrame, name: str, field: str) -> DataFrame:
        return record_ids(df, F.lit(name).alias("objType"), F.col(f"geometry.{field}").alias("wkt"))

    points = tagged(_point_tables(spark, sf_dir), "Verblijfsobject", "geo_point")
    members = tagged(_multi_tables(spark, sf_dir), "Woonplaats", "geo_multi_polygon")
    frames = [
        vertices.point_vertices(points, "wkt"),
        vertices.multipolygon_vertices(members, "wkt"),
    ]
    counted = union_all(spark, frames, vertices.VERTEX_SCHEMA)
    return counted.groupBy("objType").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("vlakID").alias("n_members")
    )


# --- text chunks ---------------------------------------------------------------------------


@query
def max_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = chunks.max_lengths(S.table(spark, sf_dir, "documents"), ["text", "lang"])
    return df.select(F.col("text").alias("max_text"), F.col("lang").alias("max_lang"))


def _as_rows(df: DataFrame, *ids: str) -> DataFrame:
    """Chunk columns as rows: how many there are depends on the data, the row form does not."""
    names = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), names, "chunk", "piece")


@query
def chunk_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    return _as_rows(chunks.chunk_columns(df, ["text"]).drop("text"), "doc_id")


@query
def chunk_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of a geometry struct, one of them null throughout."""
    text, source = F.col("text"), F.when(F.col("doc_id") % 7 != 0, F.col("source"))
    df = S.table(spark, sf_dir, "documents").select(
        "doc_id", geometry_struct(polygon=text, point=source).alias("geometry")
    )
    return _as_rows(chunks.chunk_geometry(df).drop("geometry"), "doc_id")


@query
def chunk_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "chunks")
    df = S.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cut = chunks.chunk_columns(df, ["text"]).drop("text")
    files.write_table(cut, folder, "source", rebalance=True)
    return _as_rows(files.read_table(spark, folder), "doc_id", "source")


@query
def chunk_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widths observed while the table is written: its texts are read once, to be cut."""
    folder = work_folder(spark, "observed")
    df = S.table(spark, sf_dir, "documents").select("doc_id", geometry_struct(polygon=F.col("text")).alias("geometry"))
    watched, widths = chunking.observe_widths(df)
    files.write_table(watched, f"{folder}/texts")
    chunking.keep_widths(spark, widths, folder, "texts")
    counts = chunking.observed_counts(spark, folder, "texts", K.CHUNK_WIDTH)
    cut = chunks.chunk_geometry(files.read_table(spark, f"{folder}/texts"), counts=counts)
    rows = _as_rows(cut.drop("geometry"), "doc_id")
    return rows.withColumn("chunk", F.replace("chunk", F.lit("geo_polygon"), F.lit("text")))


# --- model rules ---------------------------------------------------------------------------


@query
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return model.conform(
        S.table(spark, sf_dir, "customer"),
        "verblijfsobject",
        {
            "identificatie": k,
            "geometrie": F.expr(S.point_text("c_custkey")),
            "gebruiksdoel": "c_mktsegment",
            # only even keys hold a number
            "oppervlakte": F.when(k % 2 == 0, k.cast("string")).otherwise(F.col("c_name")),
            "status": F.lit("in gebruik"),
            "hoofdadres": "c_nationkey",
            "pand_identificatie": k % 100,
        },
    )


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(S.point_text("o_orderkey")).alias("geo_point"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )
    return quality.check_not_null(df)


#: A part that does not exist on every tenth supplier's lines.
_PART_USED = "if(l_suppkey % 10 = 0, -l_partkey, l_partkey)"


@query
def check_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = S.table(spark, sf_dir, "lineitem").selectExpr(f"{_PART_USED} AS l_partkey")
    return quality.check_foreign_key(child, "l_partkey", S.table(spark, sf_dir, "part"), "p_partkey")


@query
def foreign_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = S.table(spark, sf_dir, "lineitem")
    child = lines.selectExpr("l_orderkey", "l_linenumber", f"{_PART_USED} AS l_partkey")
    return quality.orphan_rows(child, "l_partkey", S.table(spark, sf_dir, "part"), "p_partkey")


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(S.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_domain(S.table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@query
def check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_length(
        S.table(spark, sf_dir, "part"), {"p_name": 9, "p_brand": 7, "p_type": 80}
    )


@query
def length_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.too_long_rows(
        S.table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", 9
    )


@query
def bridge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(", ", "p_type", F.concat_ws(" ", "p_name", "p_brand"), "p_type").alias("uses")
    )
    return quality.bridge_table(df, "p_partkey", "uses", ("p_partkey", "gebruiksdoel"))


@query
def rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of two tables that break a rule of their own or share a key, with the rules."""
    town = model.conform(S.table(spark, sf_dir, "orders"), "woonplaats", {
        "identificatie": F.expr("if(o_orderkey % 50 <> 0, o_orderkey - int(o_orderkey % 40 = 1), NULL)"),
        "naam": "o_orderpriority",
        "geometrie": F.expr(S.point_text("o_orderkey")),
        "status": F.expr("if(o_orderstatus = 'P', 'Woonplaats onbekend', 'Woonplaats aangewezen')"),
        "geconstateerd": F.lit("N"),
        "documentdatum": F.lit("2022-11-01"),
        "documentnummer": "o_orderkey",
    })
    place = model_tables(spark, sf_dir)["verblijfsobject"]
    found = []
    for table, df, row in (("woonplaats", town, "documentnummer"), ("verblijfsobject", place, "identificatie")):
        folder = work_folder(spark, f"checked-{table}")
        model.write_checked(df, table, folder)
        rows = model.quarantined_rows(spark, folder)
        found.append(rows.select(F.lit(table).alias("table_name"), F.col(row).alias("row_key"), "rule", "column_name"))
    return found[0].union(found[1])


@query
def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.model_report(model_tables(spark, sf_dir))


def model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Eight model tables filled from driver tables, with rule breaks of every kind."""
    used = ("nation", "supplier", "customer", "part", "orders", "lineitem", "events")
    t = {name: S.table(spark, sf_dir, name) for name in used}
    town = F.lpad(F.col("n_nationkey").cast("string"), 4, "0")
    return {
        "woonplaats": model.conform(t["nation"], "woonplaats", {
            "identificatie": town,
            "naam": "n_name",
            "geometrie": F.lit("MULTIPOLYGON EMPTY"),
            "status": F.expr(
                "if(n_nationkey % 5 = 0, 'Woonplaats onbekend', 'Woonplaats aangewezen')"
            ),
            "geconstateerd": F.lit("N"),
            "documentdatum": F.lit("2022-11-01"),
            "documentnummer": "n_regionkey",
        }),
        "openbare_ruimte": model.conform(t["supplier"], "openbare_ruimte", {
            "identificatie": "s_suppkey",
            "naam": F.repeat("s_name", 5),
            "type": F.lit("Weg"),
            "status": F.lit("uitgegeven"),
            "geconstateerd": F.when(F.col("s_suppkey") % 7 != 0, "N"),
            "documentdatum": F.lit("2022-11-01"),
            "documentnummer": "s_name",
            "woonplaats_identificatie": F.lpad((F.col("s_nationkey") + 3).cast("string"), 4, "0"),
        }),
        "nummeraanduiding": model.conform(t["customer"], "nummeraanduiding", {
            "identificatie": F.col("c_custkey") - F.col("c_custkey") % 50 % 2,
            "huisnummer": "c_custkey",
            "postcode": F.lit("3011AA"),
            "type_adresseerbaar_object": "c_mktsegment",
            "status": F.lit("uitgegeven"),
            "geconstateerd": F.lit("N"),
            "documentdatum": F.lit("not a date"),
            "documentnummer": "c_name",
            "woonplaats_identificatie": "c_nationkey",
            "openbare_ruimte_identificatie": F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") % 200),
        }),
        "pand": model.conform(t["part"], "pand", {
            "identificatie": "p_partkey",
            "geomtrie": F.lit("POLYGON EMPTY"),
            "oorspronkelijk_bouwjaar": "p_size",
            "status": F.lit("in gebruik"),
            "geconstateerd": F.lit("N"),
            "documentdatum": F.lit("2022-11-01"),
        }),
        "domeinwaarden_gebruiksdoel": model.conform(
            t["part"].groupBy("p_type").agg(F.max("p_brand").alias("text")),
            "domeinwaarden_gebruiksdoel", {"waarde": "p_type", "omschrijving": "text"},
        ),
        "verblijfsobject": model.conform(t["lineitem"], "verblijfsobject", {
            "identificatie": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "geometrie": F.expr(S.point_text("l_orderkey")),
            "gebruiksdoel": F.when(F.col("l_returnflag") == "R", "ECONOMY, TINY HOUSE").otherwise("LARGE,PROMO,"),
            "oppervlakte": F.col("l_quantity").cast("bigint"),
            "status": "l_linestatus",
            "geconstateerd": F.lit("N"),
            "documentdatum": F.lit("2022-11-01"),
            "documentnummer": "l_suppkey",
            "hoofdadres": F.col("l_orderkey") % 500,
            "pand_identificatie": F.expr(_PART_USED),
        }),
        "woz_object": model.conform(t["orders"], "woz_object", {
            "woz_objectnummer": F.expr(
                "if(o_orderkey % 11 <> 0, o_orderkey - o_orderkey % 10 % 2, NULL)"
            ),
            "nummeraanduiding": "o_custkey",
        }),
        "woz_waarde": model.conform(t["events"], "woz_waarde", {
            "woz_objectnummer": F.when(F.col("event_type") != "view", F.col("user_id")),
            "vastgestelde_waarde": "value",
            "tijdstip_registratie_waardegegevens": "ts",
        }),
    }
