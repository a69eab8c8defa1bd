"""Parquet tables and file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARQUET_SUFFIX = ".snappy.parquet"
#: Rows that a task turns into geometry, a few seconds of work, and the most tasks they go to.
DEAL, TASKS = 20_000, 4_000


def list_files(spark: SparkSession, folder: str, suffix: str = PARQUET_SUFFIX) -> DataFrame:
    """Files below ``folder`` whose name ends in ``suffix``: path, length, modificationTime.

    A folder, not a name prefix: a sibling such as ``Pand_geo_splitted`` never matches
    ``Pand``. File contents are not read.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of one table; ``part=`` folders become a column that prunes."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(folder)


def dealt(df: DataFrame) -> DataFrame:
    """Rows of a stored table dealt out to tasks of ``DEAL`` rows; a table that fits a task stays as it is.

    A scan gives a row group to one task, and a file of short rows has few of them however much
    work each row makes later. Rows are counted from the table, without the columns; those that
    are not used further on are not shuffled.
    """
    tasks = min(-(-df.count() // DEAL), TASKS)
    return df.repartition(tasks) if tasks > 1 else df


def write_table(
    df: DataFrame,
    folder: str,
    partition_by: str | None = None,
    rebalance: bool = False,
    max_records: int = 0,
) -> None:
    """Overwrite a Parquet table in one job.

    ``rebalance`` lets adaptive execution even out the written files. It splits a large part
    over several tasks, unlike ``repartition(part)``, which sends each part to one task.
    """
    if rebalance:
        df = df.hint("rebalance", *([partition_by] if partition_by else []))
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(folder)


def write_parts(df: DataFrame, folder: str, part: Column, rebalance: bool = False) -> None:
    """Overwrite a table as ``part=<i>`` folders, all parts in one job.

    One overwrite of the whole table also removes parts that a shorter run no longer has.
    Rows that come from the same source file already sit together, so by default nothing is
    shuffled; set ``rebalance`` where ``part`` is scattered over the input.
    """
    write_table(df.withColumn("part", part.cast("int")), folder, "part", rebalance)


def replace_parts(df: DataFrame, folder: str, part: Column) -> None:
    """Write the parts that ``df`` holds in place of those parts of a table; the others stay.

    The new parts are written beside the table and take their places when all of them are
    complete: a job that breaks off leaves the table as it was.
    """
    whole = df.withColumn("part", part.cast("int")).hint("rebalance", "part")
    writer = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("part").parquet(folder)


def drop_lost_parts(spark: SparkSession, folder: str, parts: DataFrame) -> list[int]:
    """Remove the parts of a table that ``parts``, a manifest with a ``part`` column, does not have.

    Returns their numbers: one for each folder, which is all that the driver sees.
    """
    held = read_table(spark, folder).select("part").distinct()
    lost = sorted(r["part"] for r in held.join(parts, "part", "left_anti").collect())
    for number in lost:
        remove_folder(spark, f"{folder}/part={number}")
    return lost


def part_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete ``folder`` in whatever store Spark finds it; nothing happens if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
