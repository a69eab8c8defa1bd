"""Register extract in XML to one Parquet table per object type."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.functions.names import batch_of
from terravane.operators.geometry import convert_geometry
from terravane.plans.chunking import keep_widths, observe_widths
from terravane.sources.files import read_table, remove_folder, replace_parts, write_parts, write_table
from terravane.sources.schemas import load_schema, save_schema
from terravane.sources.workspace import work_folder
from terravane.sources.xml import Paths, bad, good, infer_schema, parsed, read_records, record_texts, unwrap


def prepare_schema(
    spark: SparkSession, paths: Paths, object_type: str, schema_file: str
) -> T.StructType:
    """Infer the record schema once and keep it for later extracts."""
    schema = infer_schema(spark, paths, object_type)
    save_schema(spark, schema, schema_file)
    return load_schema(spark, schema_file)


def object_table(
    spark: SparkSession,
    paths: Paths,
    object_type: str,
    schema: T.StructType,
    method: str = "geodetic",
    file_column: str | None = None,
) -> DataFrame:
    """Records with all their fields and ``geometry``: one scan, no shuffle, no Python worker."""
    return convert_geometry(read_records(spark, paths, object_type, schema, file_column), method)


def ingest(
    spark: SparkSession,
    paths: Paths,
    object_type: str,
    folder: str,
    schema: T.StructType,
    method: str = "geodetic",
    batch_files: int = K.BATCH_FILES,
    parts: Collection[int] | None = None,
) -> str:
    """Write ``<folder>/<object type>``; the large types as ``part=<i>`` folders.

    A part holds ``batch_files`` consecutively numbered source files. All parts are written
    by one job, the rows of a part together, a large part over several tasks. Every record is
    parsed once, into a table in the shared folder that the object table and the malformed records,
    ``<folder>/_bad/<object type>``, are both taken from and that is removed in the end.

    With ``parts`` only the source files of these parts of a large type are read, and only these
    parts of the table and of its malformed records are replaced. Widths of the geometry texts
    are observed while the table is written and kept in ``<folder>/_widths``, see
    :func:`terravane.plans.chunking.kept_widths`.
    """
    stage, source = work_folder(spark, f"parsed-{object_type}"), F.col("file")
    texts = record_texts(spark, paths, "file")
    if parts is not None:
        if object_type not in K.BATCHED_TYPES:
            raise ValueError(f"{object_type} is not written in parts")
        texts = texts.where(batch_of(source, batch_files).isin(*parts))
    write_table(parsed(texts, "record", schema), stage)
    rows = read_table(spark, stage)
    target, broken = f"{folder}/{object_type}", f"{folder}/_bad/{object_type}"
    if object_type in K.BATCHED_TYPES:
        found = bad(rows).withColumn("part", batch_of(source, batch_files))
        (write_parts if parts is None else replace_parts)(found, broken, F.col("part"))
    else:
        write_table(bad(rows), broken)
    df = convert_geometry(unwrap(good(rows), object_type, F.col("file").alias("_source_file")), method)
    df, widths = observe_widths(df)
    if object_type not in K.BATCHED_TYPES:
        write_table(df.drop("_source_file"), target)
    else:
        df = df.withColumn("part", batch_of(F.col("_source_file"), batch_files)).drop("_source_file")
        if parts is None:
            write_parts(df, target, F.col("part"), rebalance=True)
        else:
            replace_parts(df, target, F.col("part"))
    keep_widths(spark, widths, folder, object_type, grow=parts is not None)
    remove_folder(spark, stage)
    return target
