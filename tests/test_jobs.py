"""Archives to XML to tables, dimension and chunks: the jobs end to end."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

import pytest
import samples as X
from pyspark.sql import functions as F

from terravane.functions import names
from terravane.plans.chunking import build_chunks
from terravane.plans.dimension import build_dimensions, geo_dimension
from terravane.plans.ingest import ingest, prepare_schema
from terravane.sources import archives, files, schemas, xml
from terravane.sources.workspace import work_folder


def square(n: int) -> str:
    x, y = 100000 + 50 * n, 400000 + 50 * n
    return f"{x} {y} 0 {x + 10} {y} 0 {x + 10} {y + 10} 0 {x} {y} 0"


def pand_files(count: int, per_file: int = 3) -> dict[str, str]:
    return {
        f"9999PND08102022-{i + 1:06d}.xml": X.document(
            *[X.record("Pand", f"0599{i:06d}{j}", X.polygon(square(i * per_file + j))) for j in range(per_file)]
        )
        for i in range(count)
    }


def zipped(members: dict[str, str | bytes]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return buffer.getvalue()


@pytest.fixture(scope="module")
def extract(tmp_path_factory):
    folder = tmp_path_factory.mktemp("extract")
    town = X.document(X.record("Woonplaats", "0599", X.multivlak(X.polygon(square(1)), X.polygon(square(2)))))
    number = X.document(X.record("Nummeraanduiding", "0599200000000001"))
    outer = {
        "9999PND08102022.zip": zipped(pand_files(7)),
        "9999WPL08102022.zip": zipped({"9999WPL08102022-000001.xml": town}),
        "9999NUM08102022.zip": zipped({"9999NUM08102022-000001.xml": number}),
        "readme.txt": b"not an archive",
    }
    path = folder / "lvbag-extract-nl.zip"
    path.write_bytes(zipped(outer))
    return str(path)


@pytest.fixture(scope="module")
def source(spark, extract, tmp_path_factory):
    folder = tmp_path_factory.mktemp("xml")
    archives.expand(spark, extract, str(folder), tasks=4)
    return folder


def test_expand_writes_every_member_once(source, spark, extract):
    found = sorted(str(p.relative_to(source)) for p in source.rglob("*.xml"))
    assert found == sorted(
        [f"PND/{n}" for n in pand_files(7)]
        + ["WPL/9999WPL08102022-000001.xml", "NUM/9999NUM08102022-000001.xml"]
    )
    for name, text in pand_files(7).items():
        assert (source / "PND" / name).read_text() == text
    # a second run (or a task run again) leaves the same files
    manifest = archives.expand(spark, extract, str(source), tasks=2)
    assert manifest.count() == 9
    assert sorted(str(p.relative_to(source)) for p in source.rglob("*.xml")) == found


def test_expand_accepts_uris(spark, extract, tmp_path):
    target = f"file://{tmp_path}/x"
    assert archives.expand(spark, f"file://{extract}", target, tasks=2).count() == 9
    assert len(list(Path(tmp_path, "x", "PND").glob("*.xml"))) == 7


def test_members_for_one_file_are_refused(spark, tmp_path):
    page = X.document(X.record("Pand", "1"))
    inner = zipped({"a/x-000001.xml": page, "b/x-000001.xml": page})
    path = tmp_path / "twice.zip"
    path.write_bytes(zipped({"9999PND01.zip": inner}))
    with pytest.raises(ValueError, match="2 members"):
        archives.expand(spark, str(path), str(tmp_path / "xml"), tasks=2)
    assert not list(Path(tmp_path, "xml", "PND").glob("*.xml"))


def test_a_second_extract_replaces_the_first(spark, tmp_path):
    for number in ("000001", "000002"):
        inner = zipped({f"9999PND-{number}.xml": X.document(X.record("Pand", number))})
        path = tmp_path / f"{number}.zip"
        path.write_bytes(zipped({"9999PND01.zip": inner}))
        assert archives.expand(spark, str(path), str(tmp_path / "xml"), tasks=2).count() == 1
    assert [p.name for p in Path(tmp_path, "xml", "PND").glob("*.xml")] == ["9999PND-000002.xml"]


def test_malformed_records_are_set_aside(spark, tmp_path):
    good = [X.record("Pand", i, X.polygon(square(1))) for i in ("01", "02", "03")]
    text = X.document(*good)
    broken = text.replace("02</Objecten:identificatie>", "02")
    assert broken != text
    (tmp_path / "PND").mkdir()
    (tmp_path / "PND" / "9999PND-000001.xml").write_text(broken)
    schema, paths = schemas.core_schema("Pand"), f"{tmp_path}/PND"
    rows = xml.read_records(spark, paths, "Pand", schema).select("`Objecten:identificatie`._VALUE").collect()
    assert sorted(r[0] for r in rows) == ["01", "03"]
    ingest(spark, paths, "Pand", f"{tmp_path}/t", schema)
    bad = files.read_table(spark, f"{tmp_path}/t/_bad/Pand").collect()
    assert len(bad) == 1 and ">02" in bad[0]["record"]
    assert files.read_table(spark, f"{tmp_path}/t/Pand").count() == 2


def test_a_rare_field_reaches_the_schema(spark, tmp_path):
    records = [X.record("Pand", str(i)) for i in range(300)]
    records[150] = records[150].replace("</Objecten:Pand>", "<Objecten:rare>x</Objecten:rare></Objecten:Pand>")
    (tmp_path / "a.xml").write_text(X.document(*records))
    assert "Objecten:rare" in str(xml.infer_schema(spark, str(tmp_path), "Pand"))


def test_names(spark):
    df = spark.createDataFrame([("data/9999PND08102022.zip", "x/9999PND08102022-000123.xml")], "a string, m string")
    row = df.select(
        names.archive_type(F.col("a")),
        names.member_path("bag/xml", F.col("a"), F.col("m")),
        names.file_number(F.col("m")),
        names.batch_of(F.col("m")),
        names.batch_of(F.lit("no-number.xml")),
    ).first()
    assert tuple(row) == ("PND", "bag/xml/PND/9999PND08102022-000123.xml", 123, 1, 0)


@pytest.fixture(scope="module")
def tables(spark, source, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for code, kind in (("PND", "Pand"), ("WPL", "Woonplaats"), ("NUM", "Nummeraanduiding")):
        schema = prepare_schema(spark, f"{source}/{code}", kind, f"{folder}/_schemas/{kind}")
        ingest(spark, f"{source}/{code}", kind, str(folder), schema, batch_files=3)
    return folder


def test_parts_follow_the_source_files(spark, tables):
    df = files.read_table(spark, f"{tables}/Pand")
    assert {r["part"]: r["n_rows"] for r in files.part_counts(df).collect()} == {0: 9, 1: 9, 2: 3}
    assert df.select("geometry.geo_polygon").where("geo_polygon IS NULL").count() == 0


def test_shorter_run_leaves_no_stale_part(spark, source, tmp_path):
    schema = schemas.core_schema("Pand")
    ingest(spark, f"{source}/PND", "Pand", str(tmp_path), schema, batch_files=3)
    ingest(spark, f"{source}/PND", "Pand", str(tmp_path), schema, batch_files=100)
    assert [p.name for p in Path(tmp_path, "Pand").glob("part=*")] == ["part=0"]


def test_dimensions(spark, tables):
    written = build_dimensions(spark, str(tables), ["Woonplaats", "Nummeraanduiding", "Pand"])
    assert [Path(w).name for w in written] == ["dim_Woonplaats", "dim_Pand"]
    pand = files.read_table(spark, f"{tables}/dim_Pand")
    assert pand.count() == 21 * 4
    assert pand.where("refID IS NULL OR vlakID IS NOT NULL").count() == 0
    towns = files.read_table(spark, f"{tables}/dim_Woonplaats").orderBy("vlakID", "puntID").collect()
    assert [(r["vlakID"], r["puntID"]) for r in towns] == [(m, p) for m in (0, 1) for p in range(4)]
    assert towns[0]["identificatie"] == 599
    assert (towns[0]["long"], towns[0]["lat"]) == pytest.approx(X.to_wgs84(100050, 400050), abs=5e-6)
    assert geo_dimension(spark, str(tables), "Nummeraanduiding") is None


def test_chunks_share_columns_over_parts(spark, tables):
    written = build_chunks(spark, str(tables), ["Woonplaats", "Nummeraanduiding", "Pand"], width=50)
    assert [Path(w).name for w in written] == ["Woonplaats_geo_splitted", "Pand_geo_splitted"]
    df = files.read_table(spark, f"{tables}/Pand_geo_splitted")
    pieces = [c for c in df.columns if c.startswith("geo_polygon_")]
    assert len(pieces) > 1 and "part" in df.columns
    rejoined = df.select(F.concat(*pieces).alias("a"), F.col("geometry.geo_polygon").alias("b"))
    assert rejoined.where("a <> b").count() == 0
    # the chunked sibling is not part of the table it was made from
    assert files.read_table(spark, f"{tables}/Pand").count() == 21


def test_listing_takes_a_folder_and_a_suffix(spark, tables):
    found = [r["path"] for r in files.list_files(spark, f"{tables}/Pand").collect()]
    assert found and all("/Pand/part=" in p and p.endswith(".snappy.parquet") for p in found)
    assert files.list_files(spark, f"{tables}/Pand", ".zip").count() == 0


def test_schema_file_round_trip(spark, tmp_path):
    schema = schemas.core_schema("Verblijfsobject")
    schemas.save_schema(spark, schema, f"{tmp_path}/s")
    schemas.save_schema(spark, schema, f"{tmp_path}/s")
    assert schemas.load_schema(spark, f"{tmp_path}/s") == schema


def test_records_in_a_text_column(spark):
    text = X.record("Pand", "0599001", X.polygon(square(1)))
    df = xml.parse_records(
        spark.createDataFrame([(text,)], "t string"), "t", "Pand", schemas.core_schema("Pand")
    )
    assert df.select("Objecten:identificatie._VALUE").first()[0] == "0599001"


def test_work_folder_needs_a_shared_root_on_a_cluster(spark):
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(RuntimeError):
        work_folder(Cluster, "x")
    Cluster.conf.get = staticmethod(lambda key, default=None: "hdfs://shared/cp/" if "checkpoint" in key else default)
    assert work_folder(Cluster, "x").startswith("hdfs://shared/cp/x-")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_command_line_runs_the_whole_chain(spark, extract, tmp_path):
    from terravane import jobs

    raw, stored = f"{tmp_path}/xml", f"{tmp_path}/tables"
    jobs.main(["expand", extract, raw, "--tasks", "2"])
    jobs.main(["ingest", raw, stored, "--types", "Pand", "Woonplaats", "Nummeraanduiding", "--method", "geodetic"])
    jobs.main(["dimension", stored, "--types", "Pand", "Woonplaats"])
    jobs.main(["chunks", stored, "--types", "Pand", "--width", "40"])
    assert sorted(p.name for p in Path(stored).iterdir() if not p.name.startswith("_")) == [
        "Nummeraanduiding", "Pand", "Pand_geo_splitted", "Woonplaats", "dim_Pand", "dim_Woonplaats",
    ]
    assert files.read_table(spark, f"{stored}/dim_Pand").count() == 84


def test_type_without_records_gives_empty_tables(spark, tmp_path):
    source, stored = tmp_path / "xml", str(tmp_path / "tables")
    source.mkdir()
    (source / "9999LIG08102022-000001.xml").write_text(X.document())
    schema = prepare_schema(spark, str(source), "Ligplaats", f"{stored}/_schemas/Ligplaats")
    assert schema == schemas.core_schema("Ligplaats")
    ingest(spark, str(source), "Ligplaats", stored, schema)
    build_dimensions(spark, stored, ["Ligplaats"])
    build_chunks(spark, stored, ["Ligplaats"])
    assert files.read_table(spark, f"{stored}/Ligplaats").count() == 0
    assert files.read_table(spark, f"{stored}/dim_Ligplaats").count() == 0
    assert "geo_polygon_0" not in files.read_table(spark, f"{stored}/Ligplaats_geo_splitted").columns
