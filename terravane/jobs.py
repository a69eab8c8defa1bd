"""Command line of the jobs, for ``spark-submit``.

    jobs.py expand   <archive.zip> <xml folder>
    jobs.py ingest   <xml folder> <table folder> [--method polynomial] [--schemas <folder>]
                     [--types Pand --parts 3 17]
    jobs.py new      <xml folder> <table folder> --schemas <folder>
    jobs.py drift    <xml folder> <table folder> --schemas <folder>
    jobs.py dimension <table folder> [--by-place]
    jobs.py chunks   <table folder> [--observed]

The XML folder holds one folder per type code (``PND``, ``VBO``, ...), as ``expand`` writes it.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from terravane import constants as K
from terravane.functions.projection import METHODS
from terravane.plans.chunking import build_chunks
from terravane.plans.dimension import build_dimensions
from terravane.plans.ingest import ingest, prepare_schema
from terravane.session import build_session
from terravane.sources.archives import expand
from terravane.sources.deliveries import ingest_new
from terravane.sources.drift import schema_drift
from terravane.sources.files import write_table
from terravane.sources.schemas import load_schema


def ingest_all(
    spark: SparkSession,
    source: str,
    folder: str,
    types: list[str],
    method: str,
    schemas: str | None,
    parts: list[int] | None = None,
) -> None:
    """Ingest every type; with ``schemas``, a folder of an earlier run, nothing is inferred.

    ``parts`` runs these parts of a large type again, under its saved schema.
    """
    for code, object_type in K.OBJECT_TYPES.items():
        if object_type in types:
            paths, kept = f"{source}/{code}", f"{folder}/_schemas/{object_type}"
            if schemas:
                schema = load_schema(spark, f"{schemas}/{object_type}")
            else:
                schema = prepare_schema(spark, paths, object_type, kept)
            ingest(spark, paths, object_type, folder, schema, method, parts=parts)


def ingest_deliveries(spark: SparkSession, source: str, folder: str, types: list[str], method: str, schemas: str) -> None:
    """Add the files that came since the last run, type by type, to ``<folder>/<type>``."""
    for code, object_type in K.OBJECT_TYPES.items():
        if object_type in types:
            schema, state = load_schema(spark, f"{schemas}/{object_type}"), f"{folder}/_state/{object_type}"
            ingest_new(spark, f"{source}/{code}", object_type, schema, f"{folder}/{object_type}", state, method)


def report_drift(spark: SparkSession, source: str, folder: str, types: list[str], schemas: str) -> None:
    """Write what the saved schemas do not read of an extract to ``<folder>/_drift/<type>``."""
    for code, object_type in K.OBJECT_TYPES.items():
        if object_type in types:
            schema = load_schema(spark, f"{schemas}/{object_type}")
            write_table(schema_drift(spark, f"{source}/{code}", schema), f"{folder}/_drift/{object_type}")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(description="Register jobs")
    jobs = root.add_subparsers(dest="job", required=True)
    step = jobs.add_parser("expand")
    step.add_argument("archive")
    step.add_argument("folder")
    step.add_argument("--tasks", type=int)
    step = jobs.add_parser("ingest")
    step.add_argument("source")
    step.add_argument("folder")
    step.add_argument("--types", nargs="*", default=list(K.OBJECT_TYPES.values()))
    step.add_argument("--method", choices=sorted(METHODS), default="geodetic")
    step.add_argument("--schemas", help="folder of saved schemas: <table folder>/_schemas")
    step.add_argument("--parts", type=int, nargs="+", help="replace these parts of a large type only")
    for job in ("new", "drift"):
        step = jobs.add_parser(job)
        step.add_argument("source")
        step.add_argument("folder")
        step.add_argument("--types", nargs="*", default=list(K.OBJECT_TYPES.values()))
        step.add_argument("--schemas", required=True)
        if job == "new":
            step.add_argument("--method", choices=sorted(METHODS), default="geodetic")
    step = jobs.add_parser("dimension")
    step.add_argument("folder")
    step.add_argument("--by-place", action="store_true", help="sort along the curve, for lookups by place")
    step.add_argument("--types", nargs="*", default=K.DIMENSION_TYPES)
    step = jobs.add_parser("chunks")
    step.add_argument("folder")
    step.add_argument("--types", nargs="*", default=K.CHUNK_TYPES)
    step.add_argument("--width", type=int, default=K.CHUNK_WIDTH)
    step.add_argument("--observed", action="store_true", help="use the widths that ingest kept")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"terravane-{args.job}")
    if args.job == "expand":
        expand(spark, args.archive, args.folder, args.tasks)
    elif args.job == "ingest":
        ingest_all(spark, args.source, args.folder, args.types, args.method, args.schemas, args.parts)
    elif args.job == "new":
        ingest_deliveries(spark, args.source, args.folder, args.types, args.method, args.schemas)
    elif args.job == "drift":
        report_drift(spark, args.source, args.folder, args.types, args.schemas)
    elif args.job == "dimension":
        build_dimensions(spark, args.folder, args.types, args.by_place)
    else:
        build_chunks(spark, args.folder, args.types, args.width, args.observed)


if __name__ == "__main__":
    main()
