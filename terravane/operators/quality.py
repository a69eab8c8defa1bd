"""Rules of the relational model as jobs that return what breaks them.

Every rule reduces to keys and counts before it shuffles, so a value that a third of all
rows share costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, n_rows, n_null`` for every column, in one pass."""
    return _count_per_column(
        df, {c: F.col(c).isNull() for c in columns or df.columns}, "n_null"
    )


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """``column_name, n_rows, n_too_long`` for texts longer than their limit, in one pass."""
    return _count_per_column(
        df, {c: F.length(F.col(c)) > n for c, n in limits.items()}, "n_too_long"
    )


def _count_per_column(df: DataFrame, tests: Mapping[str, Column], name: str) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(test).alias(f"_{i}") for i, test in enumerate(tests.values())],
    )
    cells = [
        F.struct(F.lit(c).alias("column_name"), "n_rows", F.col(f"_{i}").alias(name))
        for i, c in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*cells)))


def too_long_rows(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Rows whose text exceeds the limit."""
    return df.where(F.length(F.col(column)) > limit)


def check_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the enumeration with their row counts; null passes."""
    return (
        df.where(~F.col(column).isin(*allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row counts; a null in the key passes."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def broken_rules(rules: Sequence[tuple[str, str, str]]) -> Column:
    """``array<struct<rule, column_name>>`` of the rules a row breaks, from (rule, column, SQL
    condition of a breaking row): one expression, whatever their number."""
    cells = ", ".join(
        f"if({condition}, named_struct('rule', '{rule}', 'column_name', '{column}'), NULL)"
        for rule, column, condition in rules
    )
    empty = "CAST(array() AS array<struct<rule: string, column_name: string>>)"
    return F.expr(f"array_compact(array({cells}))" if rules else empty)


def mark_repeated(df: DataFrame, key: str, rules: str) -> DataFrame:
    """``df`` with ``unique`` added to its column ``rules`` where another row has the same ``key``.

    Only the key is read and counted to find the repeated ones; a null passes.
    """
    repeated = check_unique(df.select(key), [key]).select(F.col(key).alias("_repeated"))
    found = F.array(F.struct(F.lit("unique").alias("rule"), F.lit(key).alias("column_name")))
    marked = df.join(repeated, F.col(key) == F.col("_repeated"), "left")
    more = F.when(F.col("_repeated").isNotNull(), F.concat(rules, found)).otherwise(F.col(rules))
    return marked.withColumn(rules, more).drop("_repeated")


def check_foreign_key(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Foreign-key values with no parent, with their row counts; null passes.

    The child is counted per value first, so the join sees each value once.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
    known = parent.select(F.col(parent_column).alias("_known"))
    orphans = used.join(known, F.col("value") == F.col("_known"), "left_anti")
    return orphans.withColumnRenamed("count", "n_rows")


def orphan_rows(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Whole child rows whose foreign key has no parent."""
    known = parent.select(F.col(parent_column).alias("_known"))
    return child.where(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("_known"), "left_anti"
    )


def bridge_table(
    df: DataFrame, key: str, values: str, names: tuple[str, str]
) -> DataFrame:
    """Distinct (key, value) pairs of a many-to-many column, an array or a list with commas."""
    value = F.explode(listed(df, values))
    return df.select(F.col(key).alias(names[0]), value.alias(names[1])).distinct()


def listed(df: DataFrame, values: str) -> Column:
    """Values of a many-to-many column, trimmed, without blanks; they may hold several words."""
    column = F.col(values)
    if not isinstance(df.schema[values].dataType, T.ArrayType):
        column = F.split(column, ",")
    trimmed = F.transform(column, lambda v: F.trim(v.cast("string")))
    return F.filter(trimmed, lambda v: v != "")
