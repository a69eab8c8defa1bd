"""Register extracts in XML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import constants as K
from terravane.sources.schemas import record_schema

Paths = str | Sequence[str]
CLOSING = f"</{K.XML_ROW}>"


def _reader(spark: SparkSession, **options: str):
    reader = spark.read.format("xml").option("rowTag", K.XML_ROW)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader


def _list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def record_texts(
    spark: SparkSession, paths: Paths, file_column: str | None = None, split: bool = True
) -> DataFrame:
    """Every record as one text, ``record``, from its opening tag to its closing one.

    The xml source gives a file to one task, however large. Read as text whose line end is the
    closing tag, a file is split like any other, and a piece holds one record behind whatever
    came before it; where it holds several, all but the last lack that closing tag. A record that
    does not end is a text of its own, up to the next one, so that it takes none of its
    neighbours along. Another spelling of the closing tag is an error, or accepted
    (``split=False``): a file that has no other is then one piece, for one task.
    """
    text = spark.read.option("lineSep", CLOSING).text(_list(paths))
    files = [] if file_column is None else [F.col("_metadata.file_path").alias(file_column)]
    return cut_records(text.select("value", *files), split)


def cut_records(text: DataFrame, split: bool = True) -> DataFrame:
    """``record`` in place of the text column ``value``, which holds pieces of files, each up to a
    closing tag that is left out; see :func:`record_texts`."""
    opening = f"<{K.XML_ROW}"
    last = f"substring_index(value, '{opening}', -1)"
    single = f"octet_length(substring_index(value, '{opening}', 1)) + {len(opening)} + octet_length({last})"
    # Several openings: records that lack the usual closing tag stand before the last one.
    pieces = f"slice(split(concat(value, '{CLOSING}'), '{opening}'), 2, octet_length(value))"
    ended = f"regexp_extract(p, '(?s)^.*?</{K.XML_ROW}\\\\s*>', 0)"
    records = f"transform({pieces}, p -> concat('{opening}', coalesce(nullif({ended}, ''), p)))"
    if split:
        other = f"raise_error('a record does not end in {CLOSING}: read with split=False')"
        records = f"transform({records}, r -> if(r LIKE '%</{K.XML_ROW}%' AND NOT endswith(r, '{CLOSING}'), {other}, r))"
    records = f"""CASE WHEN {single} = octet_length(value) THEN array(concat('{opening}', {last}, '{CLOSING}'))
        ELSE {records} END"""
    others = [c for c in text.columns if c != "value"]
    return text.where(F.contains("value", F.lit(opening))).select(F.explode(F.expr(records)).alias("record"), *others)


def infer_schema(spark: SparkSession, paths: Paths, object_type: str) -> T.StructType:
    """Schema of all records under ``paths``, completed with the core fields.

    Costs a pass over the records, so that a field no matter how rare is found; save it and
    read later extracts with it. The JVM reader infers from the texts, none reaches Python.
    """
    encoders = spark._jvm.org.apache.spark.sql.Encoders
    texts = getattr(record_texts(spark, paths)._jdf, "as")(encoders.STRING())
    found = DataFrame(_reader(spark)._jreader.xml(texts), spark).schema
    sound = T.StructType([f for f in found.fields if f.name != CORRUPT])
    return record_schema(sound, object_type)


def read_inferred(spark: SparkSession, paths: Paths, object_type: str) -> DataFrame:
    """Records of one object type under whatever schema this set of files gives."""
    return unwrap(_reader(spark).load(_list(paths)), object_type)


def read_records(
    spark: SparkSession,
    paths: Paths,
    object_type: str,
    schema: T.StructType,
    file_column: str | None = None,
    split: bool = True,
) -> DataFrame:
    """Records of one object type under a fixed schema: no inference pass, stable types.

    ``split=False`` accepts records whose closing tag is spelled otherwise, see
    :func:`record_texts`. Both ways go through one parser and give the same rows: a malformed
    record is left out, see :func:`bad_records`.
    """
    texts = record_texts(spark, paths, file_column, split)
    return parse_records(texts, "record", object_type, schema)


def unwrap(df: DataFrame, object_type: str, *others: str) -> DataFrame:
    """Fields of the ``Objecten:<type>`` wrapper as columns, then the other ones."""
    return df.select(f"{K.XML_TYPE_PREFIX}{object_type}.*", *others)


CORRUPT = "_corrupt_record"


def parsed(df: DataFrame, text: str, schema: T.StructType, **options: str) -> DataFrame:
    """The fields of ``schema`` for each record in the text column ``text``, then the column
    ``_corrupt_record``, which holds the text of a malformed record, and the other columns.

    The parser stands inside a generator: a filter on one of its fields is not pushed through
    it, which would parse every record once more.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = {"rowTag": K.XML_ROW, "columnNameOfCorruptRecord": CORRUPT, **options}
    others = [c for c in df.columns if c != text]
    return df.select(F.inline(F.array(F.from_xml(F.col(text), marked, read))), *others)


def good(rows: DataFrame) -> DataFrame:
    """The well-formed records of :func:`parsed`."""
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad(rows: DataFrame) -> DataFrame:
    """``record`` (as it stands in the file) and ``file`` of the malformed ones."""
    return rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"), "file")


def parse_records(df: DataFrame, text: str, object_type: str, schema: T.StructType) -> DataFrame:
    """Records held one per row in the text column ``text``, followed by the other columns.

    A malformed record gives no row; :func:`bad_records` returns them.
    """
    return unwrap(good(parsed(df, text, schema)), object_type, *[c for c in df.columns if c != text])


def bad_records(spark: SparkSession, paths: Paths, schema: T.StructType, split: bool = True) -> DataFrame:
    """``record`` and ``file`` of every malformed record under ``paths``, as it stands there."""
    return bad(parsed(record_texts(spark, paths, "file", split), "record", schema))


def write_records(df: DataFrame, path: str, object_type: str, record: Column) -> None:
    """Write one ``bagObject`` per row, ``record`` being the struct inside the wrapper.

    The register's element names carry a prefix, which the writer's own name check refuses.
    """
    (
        df.select(record.alias(f"{K.XML_TYPE_PREFIX}{object_type}"))
        .write.format("xml")
        .mode("overwrite")
        .option("rootTag", K.XML_ROOT)
        .option("rowTag", K.XML_ROW)
        .option("validateName", "false")
        .save(path)
    )
