"""Intermediate tables and global positions, shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.sources.files import remove_folder
from terravane.sources.workspace import work_folder


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns ``c0``, ``c1``, ... and the new name of each: names that a step gives
    to columns of its own cannot clash with them."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed in the end, but for those stored with ``keep``: they go to
    the scope around this one, or stay for the caller who reads the result."""
    folders: list[str] = []
    token = _scopes.set((*_scopes.get(), folders))
    try:
        yield
    finally:
        _scopes.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it outlives lost executors, its size is
    known to the planner, and joins on it start from plain scans that Spark may split.

    It is removed at the end of the :func:`scope` it is stored in (with ``keep``: of the next one).
    """
    spark = df.sparkSession
    folder = work_folder(spark, label)
    scopes = _scopes.get()
    if len(scopes) > keep:
        scopes[-1 - keep].append(folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """Stored rows dealt out by range and sorted, with their partition and place in it.

    ``order`` should end in columns that tell rows apart, so that no value, however frequent,
    fixes the size of a partition.
    """
    place = F.monotonically_increasing_id()
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", place.alias("_place"))
        .withColumn("_part", F.shiftright("_place", 33))
    )


def running(ordered: DataFrame, column: str) -> DataFrame:
    """Rows of :func:`in_order` with ``_within``: the sum of ``column`` over the rows before each
    in its partition. Batches stream by; a task keeps one number."""
    schema = T.StructType([*ordered.schema.fields]).add("_within", "long")
    at = ordered.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sums = np.cumsum(batch.column(at).to_numpy(zero_copy_only=False), dtype=np.int64)
            before = np.concatenate(([0], sums[:-1])) + total if len(sums) else sums
            total += int(sums[-1]) if len(sums) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=schema.names)

    return ordered.mapInArrow(run, schema)


def offsets(placed: DataFrame, total: Column) -> DataFrame:
    """Per partition of an ordered table, the sum of ``total`` over the partitions before it.

    The window runs over one row for each partition of the table, not over its rows.
    """
    sums = placed.groupBy("_part").agg(total.alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))


def in_blocks(df: DataFrame, size: str, limit: int, *order: Column | str) -> DataFrame:
    """``df`` with ``block``: consecutive rows of the order whose ``size`` adds up to ``limit``, about.

    A block holds less than ``limit`` before its last row.
    """
    placed = stored(running(in_order(df, *order), size), "placed")
    before = placed.join(stored(offsets(placed, F.sum(size)), "starts"), "_part")
    block = F.floor((F.col("_before") + F.col("_within")) / F.lit(limit))
    return before.withColumn("block", block).drop("_part", "_place", "_before", "_within")


def positions(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` with ``_position``: the place of each row, from 0, in the whole order."""
    placed = stored(in_order(df, *order), "ordered")
    starts = stored(offsets(placed, F.count(F.lit(1))), "starts")
    within = F.col("_place").bitwiseAND((1 << 33) - 1)
    joined = placed.join(F.broadcast(starts), "_part")
    return joined.withColumn("_position", F.col("_before") + within).drop(
        "_part", "_place", "_before"
    )
