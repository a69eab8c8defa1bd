"""Projections, schema checks made while the plan is built, and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.functions.bind import quoted


def type_at(schema: T.DataType, *names: str) -> T.DataType | None:
    """Type of a nested field, None where the path does not exist."""
    for name in names:
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return None
        schema = schema[name].dataType
    return schema


def has_path(schema: T.DataType, *names: str) -> bool:
    return type_at(schema, *names) is not None


def path_or_null(df: DataFrame, *names: str) -> Column:
    """The nested field at a path, or a null text where the schema of ``df`` lacks it: chosen while
    the plan is built, so that a missing field costs nothing."""
    if not has_path(df.schema, *names):
        return F.lit(None).cast("string")
    return F.col(".".join(quoted(name) for name in names))


def expand_struct(df: DataFrame, name: str) -> DataFrame:
    """Replace everything by the fields of one struct column."""
    return df.select(f"{name}.*")


def record_ids(df: DataFrame, *keep: str | Column) -> DataFrame:
    """``identificatie`` and ``historieIdentificatie`` as bigint, then the kept columns."""
    history = ".".join(quoted(name) for name in (K.HISTORY_FIELD, *K.HISTORY_PATH))
    return df.select(
        F.expr(f"try_cast({quoted(K.ID_FIELD)}._VALUE AS bigint)").alias("identificatie"),
        F.expr(f"try_cast({history} AS bigint)").alias("historieIdentificatie"),
        *keep,
    )


def align_columns(df: DataFrame, template: T.StructType | Sequence[str]) -> DataFrame:
    """Add each template column ``df`` lacks as a null text column; order: own, then added."""
    names = template.names if isinstance(template, T.StructType) else list(template)
    have = set(df.columns)
    return df.select(
        "*", *[F.lit(None).cast("string").alias(n) for n in names if n not in have]
    )


def union_all(spark: SparkSession, frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """Rows of all frames, by name and under ``schema``; no frames give an empty table."""
    if not frames:
        return spark.createDataFrame([], schema)
    casts = [f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema]
    return reduce(DataFrame.union, [df.selectExpr(*casts) for df in frames])


def drop_null(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names))
