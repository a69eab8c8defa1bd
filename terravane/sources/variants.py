"""Records read without a schema, each one a VARIANT, and fields taken out of them by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.sources.xml import Paths, good, parsed, record_texts

FIELDS = "fields"
WHOLE = T.StructType([T.StructField(FIELDS, T.VariantType())])


def parsed_variants(spark: SparkSession, paths: Paths, split: bool = True) -> DataFrame:
    """``fields`` (a VARIANT of the whole record), ``_corrupt_record``, ``text`` and ``file`` of every record.

    One pass and no inference: the fields of a record are whatever it holds.
    """
    texts = record_texts(spark, paths, "file", split).withColumn("text", F.col("record"))
    return parsed(texts, "record", WHOLE, singleVariantColumn=FIELDS)


def read_variants(spark: SparkSession, paths: Paths, object_type: str, split: bool = True) -> DataFrame:
    """``fields``, ``record`` (the text) and ``file`` of the well-formed records of one object type.

    A VARIANT holds a value that reads as a number as that number, without leading zeros; where
    they matter, as in :func:`identifier`, the text has them. An element that occurs once is an
    object and one that repeats an array: :func:`listed` gives both as arrays.
    """
    own = F.try_variant_get(FIELDS, _path(f"{K.XML_TYPE_PREFIX}{object_type}"), "variant")
    rows = good(parsed_variants(spark, paths, split))
    return rows.select(own.alias(FIELDS), F.col("text").alias("record"), "file").where(F.col(FIELDS).isNotNull())


def _path(*names: str) -> str:
    return "$" + "".join(f'["{name}"]' for name in names)


def field(record: Column | str, *names: str, kind: str = "string") -> Column:
    """The value at a path as ``kind``; null if it is missing or of another kind."""
    return F.try_variant_get(record, _path(*names), kind)


def text(record: Column | str, *names: str) -> Column:
    """The text of an element, whether it has attributes or not."""
    inner = field(record, *names, "_VALUE")
    return F.coalesce(inner, field(record, *names))


def listed(record: Column | str, *names: str) -> Column:
    """The elements at a path as an array of VARIANT: several, one, or none."""
    one = field(record, *names, kind="variant")
    return F.coalesce(
        field(record, *names, kind="array<variant>"), F.when(one.isNotNull(), F.array(one)), F.array().cast("array<variant>")
    )


def identifier(record: Column | str) -> Column:
    """Identifier of a record as it stands in its text, with its leading zeros."""
    value = F.regexp_extract(record, f"<{K.ID_FIELD}(?:\\s[^>]*)?>\\s*([^<]*?)\\s*<", 1)
    return F.when(value != "", value)
