"""Time the headline queries; prints one JSON line.

``queries`` holds the second run of each query in the session, ``cold`` the first. A run
covers building the plan, planning and executing it in full.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import partial

from pyspark.sql import functions as F

from terravane.catalog import shapes
from terravane.catalog.queries import QUERIES
from terravane.plans.ingest import object_table
from terravane.session import build_session
from terravane.sources.drift import schema_drift
from terravane.sources.schemas import core_schema
from terravane.sources.variants import read_variants
from terravane.sources.workspace import work_folder
from terravane.sources.xml import read_records, write_records

HEADLINE = [
    "geo_dimension",
    "polygon_vertices",
    "multipolygon_vertices",
    "area_wkt",
    "point_rows",
    "nearest_cell",
    "rd_to_wgs84_geodetic",
    "stored_dimension",
    "chunk_columns",
    "chunk_parts",
    "batched_parts",
    "full_outer_attach",
    "check_foreign_key",
    "foreign_key_rows",
    "check_unique",
    "check_not_null",
    "bridge_table",
    "model_report",
    "rule_rows",
    "archive_records",
    "replaced_part",
    "chunk_observed",
    "dimension_window",
]


def xml_jobs(spark, sf_dir: str) -> dict:
    """Jobs over an XML extract of all orders; writing the extract is not timed."""
    folder, schema = work_folder(spark, "bench-xml"), core_schema("Pand")
    record = F.expr(shapes.record("o_orderkey", "polygon"))
    write_records(shapes.table(spark, sf_dir, "orders"), folder, "Pand", record)
    return {
        "xml_read_source": lambda: read_records(spark, folder, "Pand", schema, split=False),
        "xml_read_split": lambda: read_records(spark, folder, "Pand", schema),
        "xml_to_geometry": lambda: object_table(spark, folder, "Pand", schema),
        "xml_to_geometry_polynomial": lambda: object_table(spark, folder, "Pand", schema, "polynomial"),
        "xml_to_variants": lambda: read_variants(spark, folder, "Pand"),
        "xml_drift": lambda: schema_drift(spark, folder, schema),
    }


def run(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__sql__files__maxPartitionBytes="16m",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    jobs = {name: partial(QUERIES[name], spark, sf_dir) for name in HEADLINE}
    for name, build in {**jobs, **xml_jobs(spark, sf_dir)}.items():
        cold[name] = run(build)
        warm[name] = run(build)
    spark.stop()
    result = {
        "metric": "headline queries, warm total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    sys.exit(main())
