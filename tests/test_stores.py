"""Archives read in place, deliveries, replaced parts, quarantine, kept widths, lookup by place."""

from __future__ import annotations

import io
import re
import zipfile
from pathlib import Path

import pytest
import samples as X
from pyspark.sql import functions as F

from terravane import constants as K
from terravane.catalog.queries import QUERIES, model_tables
from terravane.functions import grid
from terravane.plans import dimension, model
from terravane.plans.chunking import build_chunks, kept_widths
from terravane.plans.ingest import ingest
from terravane.sources import deliveries, files, members, schemas, xml

SMALL = "/root/testdata/sf0.001"
SQUARE = "100000 400000 0 100010 400000 0 100010 400010 0 100000 400000 0"


def ids_of(rows) -> list[str]:
    return sorted(r[0] for r in rows.select(f"`{K.ID_FIELD}`._VALUE").collect())


def counting(spark):
    """A step that passes rows on, and the number of rows that have passed it, over all jobs."""
    passed = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    return (lambda df: df.mapInArrow(run, df.schema)), passed


# --- archives -------------------------------------------------------------------------------


def zipped(content: dict[str, str | bytes], how: int = zipfile.ZIP_STORED) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", how) as archive:
        for name, data in content.items():
            archive.writestr(name, data)
    return buffer.getvalue()


@pytest.mark.parametrize("how", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_records_of_nested_archives(spark, tmp_path, how):
    pages = {f"x/9999PND-{i:06d}.xml": X.document(*[X.record("Pand", f"é{i}-{j}") for j in range(5)]) for i in range(7)}
    inner = zipped({**pages, "notes.txt": "no records"}, zipfile.ZIP_DEFLATED)
    (tmp_path / "a.zip").write_bytes(zipped({"9999PND.zip": inner, "leeg.zip": zipped({}), "readme.txt": "x"}, how))
    for size in (1 << 30, 200):
        rows = members.archive_records(spark, str(tmp_path / "a.zip"), slice_bytes=size)
        assert (rows.rdd.getNumPartitions() > 2) == (size == 200)
        found = xml.parse_records(rows, "record", "Pand", schemas.core_schema("Pand"))
        assert ids_of(found) == sorted(f"é{i}-{j}" for i in range(7) for j in range(5))
        assert {(r["archive"], r["member"]) for r in rows.collect()} == {("9999PND.zip", n[2:]) for n in pages}
    assert [p.name for p in tmp_path.iterdir()] == ["a.zip"]


def test_pieces_across_blocks(monkeypatch):
    monkeypatch.setattr(members, "BLOCK_BYTES", 7)
    text = "<r>één" + members.CLOSING + "<r>twee" + members.CLOSING + "\n</stand>"
    assert list(members.pieces(io.BytesIO(text.encode()))) == ["<r>één", "<r>twee", "\n</stand>"]


def test_written_archives_read_back(spark, tmp_path):
    rows = [(f"{a}.zip", f"{i}.zip", f"{m}.xml", f"{a}{i}{m}" * 50) for a in "ab" for i in "cd" for m in "efg"]
    df = spark.createDataFrame(rows, "archive string, inner string, member string, content string")
    assert sorted(r["members"] for r in members.write_archives(df, f"file://{tmp_path}").collect()) == [6, 6]
    with zipfile.ZipFile(tmp_path / "a.zip") as outer, outer.open("c.zip") as slot, zipfile.ZipFile(slot) as inner:
        assert inner.read("e.xml") == b"ace" * 50


# --- deliveries -----------------------------------------------------------------------------


def deliver(folder: Path, name: str, *ids: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.xml").write_text(X.document(*[X.record("Pand", i, X.polygon(SQUARE)) for i in ids]))


def test_every_file_is_taken_once_also_after_a_broken_run(spark, tmp_path):
    source, state, taken = tmp_path / "in", str(tmp_path / "state"), []

    def job(records, number):
        if fails:
            raise RuntimeError("stopped half way")
        taken.append((number, sorted(r["record"].split("Pand\">")[1][:2] for r in records.collect())))

    fails = False
    deliver(source, "one", "01", "02")
    deliveries.take_new(spark, str(source), state, job)
    deliver(source, "two", "03")
    deliver(source, "three", "04")
    fails = True
    with pytest.raises(Exception, match="stopped half way"):
        deliveries.take_new(spark, str(source), state, job)
    fails = False
    deliver(source, "four", "05")
    deliveries.take_new(spark, str(source), state, job)
    deliveries.take_new(spark, str(source), state, job)
    assert taken == [(0, ["01", "02"]), (1, ["03", "04"]), (2, ["05"])]


def test_deliveries_become_parts_of_a_table(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "state")
    for name, ids in (("one", ["01"]), ("two", ["02", "03"])):
        deliver(source, name, *ids)
        text = (source / f"{name}.xml").read_text()
        (source / f"{name}.xml").write_text(text.replace("03</Objecten:id", "03</Objecten:di"))
        deliveries.ingest_new(spark, str(source), "Pand", schemas.core_schema("Pand"), target, state)
    rows = files.read_table(spark, f"{target}/records")
    assert sorted((r["delivery"], r[K.ID_FIELD]["_VALUE"]) for r in rows.collect()) == [(0, "01"), (1, "02")]
    assert files.read_table(spark, f"{target}/bad").count() == 1
    assert sorted(r["n_records"] for r in files.read_table(spark, f"{target}/files").collect()) == [1, 2]


def test_a_delivery_is_read_once(spark, tmp_path, monkeypatch):
    source, target, step = tmp_path / "in", str(tmp_path / "t"), deliveries.cut_records
    count, passed = counting(spark)
    monkeypatch.setattr(deliveries, "cut_records", lambda values: count(step(values)))
    deliver(source, "one", "01", "02", "03")
    text = (source / "one.xml").read_text()
    (source / "one.xml").write_text(text.replace("03</Objecten:id", "03</Objecten:di"))
    deliveries.ingest_new(spark, str(source), "Pand", schemas.core_schema("Pand"), target, str(tmp_path / "state"))
    assert files.read_table(spark, f"{target}/records").count() == 2
    assert files.read_table(spark, f"{target}/bad").count() == 1
    assert passed.value == 3


def test_every_order_comes_in_a_delivery(spark, tmp_path):
    keys = [0, 1, 2, 3, 4, 5, 5, 8, -1, -5, None, None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(str(tmp_path / "orders.parquet"))
    found = sorted(((r["identificatie"], r["delivery"]) for r in QUERIES["new_files"](spark, str(tmp_path)).collect()), key=str)
    assert found == sorted(((k if k is None else f"0599{str(k).rjust(12, '0')}", abs(k or 0) % 3) for k in keys), key=str)


# --- parts ----------------------------------------------------------------------------------


def parts_of(spark, folder) -> list[tuple]:
    return sorted((r["part"], r["k"]) for r in files.read_table(spark, folder).collect())


def test_a_job_that_breaks_off_leaves_the_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    files.write_parts(spark.range(40).selectExpr("id AS k"), folder, F.col("k") % 4)
    before = parts_of(spark, folder)
    broken = spark.range(4000).selectExpr("if(id = 3999, raise_error('stopped'), id) AS k", "int(id % 2) AS part")
    with pytest.raises(Exception, match="stopped"):
        files.replace_parts(broken, folder, F.col("part"))
    assert parts_of(spark, folder) == before
    files.replace_parts(spark.range(100, 102).selectExpr("id AS k"), folder, F.lit(2))
    files.replace_parts(spark.range(200, 201).selectExpr("id AS k"), folder, F.lit(9))
    want = [p for p in before if p[0] != 2] + [(2, 100), (2, 101), (9, 200)]
    assert parts_of(spark, folder) == sorted(want)
    manifest = spark.createDataFrame([(0,), (2,), (9,)], "part int")
    assert files.drop_lost_parts(spark, folder, manifest) == [1, 3]
    assert parts_of(spark, folder) == sorted(p for p in want if p[0] in (0, 2, 9))
    assert files.drop_lost_parts(spark, folder, manifest) == []


def test_one_part_of_an_extract_is_run_again(spark, tmp_path):
    source, folder = tmp_path / "PND", str(tmp_path / "t")
    source.mkdir()

    def extract(number, ids):
        (source / f"9999PND-{number:06d}.xml").write_text(X.document(*[X.record("Pand", i, X.polygon(SQUARE)) for i in ids]))

    def run(**options):
        ingest(spark, str(source), "Pand", folder, schemas.core_schema("Pand"), batch_files=1, **options)
        return sorted((r["part"], r[K.ID_FIELD]["_VALUE"]) for r in files.read_table(spark, f"{folder}/Pand").collect())

    for n in (1, 2, 3):
        extract(n, [f"0{n}"])
    assert run() == [(0, "01"), (1, "02"), (2, "03")]
    extract(1, ["11"])
    extract(2, ["21", "22"])
    assert run(parts=[1]) == [(0, "01"), (1, "21"), (1, "22"), (2, "03")]
    with pytest.raises(ValueError, match="not written in parts"):
        ingest(spark, str(source), "Woonplaats", folder, schemas.core_schema("Woonplaats"), parts=[1])


# --- rules ----------------------------------------------------------------------------------


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


def test_good_and_broken_rows_are_all_rows(spark, tmp_path):
    tables = model_tables(spark, SMALL)
    for name, df in tables.items():
        folder = f"{tmp_path}/{name}"
        model.write_checked(df, name, folder)
        sound, broken = model.sound_rows(spark, folder), model.quarantined_rows(spark, folder)
        assert sound.columns == df.columns
        counts = {(r["rule"], r["column_name"]): r["count"] for r in broken.groupBy("rule", "column_name").count().collect()}
        report = model.model_report({name: df}).where("rule <> 'foreign_key' AND n_violations > 0").collect()
        assert counts == {(r["rule"], r["column_name"]): r["n_violations"] for r in report}
        assert sound.count() + broken.drop("rule", "column_name").distinct().count() <= df.count()
        again = {(r["rule"], r["n_violations"]) for r in model.model_report({name: sound}).where("rule <> 'foreign_key'").collect()}
        assert not [r for r in again if r[1]]


def test_row_rules_take_one_scan(spark):
    df = model_tables(spark, SMALL)["woz_waarde"]
    assert plan_of(model.checked(df, "woz_waarde")).count("Scan parquet") == 1


def test_report_reads_a_table_once_and_shuffles_values_once(spark):
    plan = plan_of(QUERIES["model_report"](spark, SMALL))
    # Eight tables; one of them is itself an aggregate of its source.
    assert plan.count("Scan parquet") == 8
    assert len(set(re.findall(r"hashpartitioning\(scope#\d+, value#\d+", plan))) == 1


# --- widths ---------------------------------------------------------------------------------


def test_chunks_from_kept_widths_equal_those_of_a_second_read(spark, tmp_path):
    (tmp_path / "a").mkdir()
    records = [X.record("Ligplaats", str(i), X.polygon(" ".join([SQUARE] * (1 + i % 9)))) for i in range(30)]
    (tmp_path / "a" / "x.xml").write_text(X.document(*records))
    folder = str(tmp_path / "t")
    ingest(spark, f"{tmp_path}/a", "Ligplaats", folder, schemas.core_schema("Ligplaats"))
    longest = files.read_table(spark, f"{folder}/Ligplaats").agg(F.max(F.length("geometry.geo_polygon"))).first()[0]
    assert kept_widths(spark, folder, "Ligplaats") == {"geo_multi_polygon": 0, "geo_polygon": longest, "geo_point": 0}
    found = {}
    for observed in (False, True):
        build_chunks(spark, folder, ["Ligplaats"], width=300, observed=observed)
        rows = files.read_table(spark, f"{folder}/Ligplaats_geo_splitted").drop("geometry")
        found[observed] = (rows.columns, sorted(map(str, rows.collect())))
    assert found[True] == found[False] and "geo_polygon_3" in found[True][0]


# --- places ---------------------------------------------------------------------------------


def test_morton_code_interleaves_row_and_column(spark):
    cells = [0, 1, 32_699, 32_700, 44_699 * 32_700 + 32_699, 123_456_789]
    rows = spark.createDataFrame([(c,) for c in cells], "refID int").select(grid.morton_code()).collect()
    assert [r[0] for r in rows] == [grid.interleave(*divmod(c, 32_700)) for c in cells]
    assert spark.sql("SELECT int(NULL) AS refID").select(grid.morton_code()).first()[0] is None


@pytest.mark.parametrize("pieces", [4, 32, 500])
def test_curve_ranges_hold_the_whole_box(pieces):
    low, high = (1000, 2000), (1037, 2101)
    ranges = grid.curve_ranges(low, high, pieces)
    codes = [grid.interleave(r, c) for r in range(low[0], high[0] + 1) for c in range(low[1], high[1] + 1)]
    assert all(any(a <= code <= b for a, b in ranges) for code in codes)
    assert len(ranges) <= pieces and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
    if pieces == 500:
        assert sum(b - a + 1 for a, b in ranges) == len(codes)


def test_a_lookup_by_place_reads_few_row_groups(spark, tmp_path):
    rows = QUERIES["geo_dimension"](spark, "/root/testdata/sf0.01")
    folder = str(tmp_path / "dim")
    dimension.write_by_place(rows, folder, **{"parquet.block.size": 4096, "parquet.page.size": 1024})
    df = dimension.window(spark, folder, 52.0, 4.5, 52.1, 4.6)
    found = df.collect()
    want = rows.where("lat BETWEEN 52.0 AND 52.1 AND long BETWEEN 4.5 AND 4.6").collect()
    assert sorted(map(str, found)) == sorted(map(str, want)) and found
    total, read = rows.count(), scanned(df)
    assert read < total / 4


def test_rows_are_computed_once_for_a_layout_by_place(spark, tmp_path):
    rows = QUERIES["geo_dimension"](spark, SMALL).coalesce(2)
    count, passed = counting(spark)
    dimension.write_by_place(count(rows), str(tmp_path / "dim"))
    total = rows.count()
    assert files.read_table(spark, str(tmp_path / "dim")).count() == total == passed.value


def test_vertices_of_one_row_group_are_made_by_several_tasks(spark, tmp_path):
    n = 3 * files.DEAL
    for name, key in (("customer", "c_custkey"), ("part", "p_partkey"), ("supplier", "s_suppkey")):
        keys = spark.range(n if name != "supplier" else 70).withColumnRenamed("id", key)
        keys.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = QUERIES["geo_dimension_literal"](spark, str(tmp_path))
    tasks = rows.groupBy("objType", F.spark_partition_id().alias("task")).count().collect()
    for kind, vertices in (("Pand", 4), ("Woonplaats", 8)):
        counts = [r["count"] for r in tasks if r["objType"] == kind]
        assert sum(counts) == vertices * sum(k % 7 != 0 for k in range(n))
        assert len(counts) == 3 and max(counts) < 1.1 * vertices * files.DEAL


def scanned(df) -> int:
    """Rows that the scan of ``df`` gave out, from its metrics."""
    plan = df._jdf.queryExecution().executedPlan()
    nodes = [plan.finalPhysicalPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan]
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    raise AssertionError("no scan")


# --- command line ---------------------------------------------------------------------------


def test_drift_deliveries_and_layouts_by_command(spark, tmp_path):
    from terravane import jobs

    raw, stored = f"{tmp_path}/xml", f"{tmp_path}/tables"
    Path(raw, "PND").mkdir(parents=True)
    deliver(Path(raw, "PND"), "9999PND-000001", "01", "02")
    kinds = ["--types", "Pand"]
    jobs.main(["ingest", raw, stored, *kinds])
    schemas_of = ["--schemas", f"{stored}/_schemas", *kinds]
    page = (Path(raw) / "PND" / "9999PND-000001.xml").read_text()
    more = page.replace("</Objecten:Pand>", "<Objecten:nieuw>1</Objecten:nieuw></Objecten:Pand>", 1)
    (Path(raw) / "PND" / "9999PND-000102.xml").write_text(more)
    jobs.main(["drift", raw, stored, *schemas_of])
    drift = files.read_table(spark, f"{stored}/_drift/Pand").collect()
    assert [tuple(r) for r in drift] == [("Objecten:Pand/Objecten:nieuw", "added", 1)]
    jobs.main(["ingest", raw, stored, *schemas_of, "--parts", "1"])
    assert files.part_counts(files.read_table(spark, f"{stored}/Pand")).orderBy("part").collect() == [(0, 2), (1, 2)]
    jobs.main(["dimension", stored, *kinds, "--by-place"])
    jobs.main(["chunks", stored, *kinds, "--observed", "--width", "40"])
    assert dimension.window(spark, f"{stored}/dim_Pand", 50.8, 3.3, 53.6, 7.1).count() == 16
    assert "geo_polygon_2" in files.read_table(spark, f"{stored}/Pand_geo_splitted").columns
    for _ in range(2):
        jobs.main(["new", raw, f"{tmp_path}/new", *schemas_of])
    assert files.read_table(spark, f"{tmp_path}/new/Pand/records").count() == 4
