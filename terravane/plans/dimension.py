"""Geo dimension: one row per vertex of every registered geometry."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane import constants as K
from terravane.functions import grid
from terravane.operators.columns import has_path
from terravane.operators.vertices import vertex_table
from terravane.sources.files import read_table, remove_folder, write_table
from terravane.sources.workspace import work_folder

# vertices per output file; a row takes some 30 bytes once encoded
MAX_RECORDS = 20_000_000


def geo_dimension(
    spark: SparkSession, folder: str, object_type: str, literal: bool = False
) -> DataFrame | None:
    """Dimension rows of one stored object type, None when the type has no geometry.

    Map-only: ids and one WKT column are read per branch, vertices stream out of the scan.
    """
    df = read_table(spark, f"{folder}/{object_type}")
    if not has_path(df.schema, "geometry"):
        return None
    return vertex_table(spark, {object_type: df}, literal, stored=True)


def write_by_place(rows: DataFrame, folder: str, max_records: int = MAX_RECORDS, **options: int | str) -> None:
    """Write dimension rows along the curve of :func:`grid.morton_code`, those without a cell last.

    Files and the row groups in them hold runs of the curve, so that a lookup by place reads
    those of its neighbourhood only. Rows of one cell are told apart by their ids: no cell,
    however crowded, fixes the size of a task. The rows are stored once before: the bounds of the
    ranges are drawn from all of them, which would compute every row a second time, and those of
    large partitions a third. ``options`` go to the Parquet writer.
    """
    spark = rows.sparkSession
    stage = work_folder(spark, "placed")
    order = [F.col("curve").asc_nulls_last(), "identificatie", "historieIdentificatie", "vlakID", "puntID"]
    try:
        write_table(rows.withColumn("curve", grid.morton_code("refID")), stage)
        ordered = read_table(spark, stage).repartitionByRange(*order).sortWithinPartitions(*order)
        ordered.write.mode("overwrite").option("maxRecordsPerFile", max_records).options(**options).parquet(folder)
    finally:
        remove_folder(spark, stage)


def window(spark: SparkSession, folder: str, south: float, west: float, north: float, east: float) -> DataFrame:
    """Dimension rows written by :func:`write_by_place` whose vertices lie in a box of degrees.

    The box becomes a few ranges of the curve, which the scan holds against the bounds of files
    and row groups; latitude and longitude decide row by row.
    """
    ranges = grid.curve_ranges(grid.cell_of(south, west), grid.cell_of(north, east))
    near = reduce(or_, [F.col("curve").between(a, b) for a, b in ranges])
    inside = F.col("lat").between(south, north) & F.col("long").between(west, east)
    return read_table(spark, folder).where(near & inside).drop("curve")


def build_dimensions(
    spark: SparkSession, folder: str, types: Iterable[str] = K.DIMENSION_TYPES, by_place: bool = False
) -> list[str]:
    """Write ``<folder>/dim_<object type>`` for every type with geometry.

    ``by_place`` sorts each along the curve, at the price of one shuffle, for :func:`window`.
    """
    written = []
    for object_type in types:
        rows = geo_dimension(spark, folder, object_type)
        if rows is not None:
            target = f"{folder}/dim_{object_type}"
            if by_place:
                write_by_place(rows, target)
            else:
                write_table(rows, target, max_records=MAX_RECORDS)
            written.append(target)
    return written
