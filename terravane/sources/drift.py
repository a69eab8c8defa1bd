"""What the records of an extract hold that a saved schema does not read."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.sources.variants import FIELDS, parsed_variants
from terravane.sources.xml import CORRUPT, Paths

#: What is wrong with a path: an element that the schema lacks, one that repeats where it takes a
#: single one, values that do not fit its type, an element with parts where it takes a value.
ADDED, REPEATED, RETYPED, NESTED = "added", "repeated", "retyped", "nested"
#: Types of a VARIANT's values that a column of a saved type reads without loss.
READS = {
    "bigint": {"BIGINT"},
    "double": {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp": {"DATE", "TIMESTAMP", "TIMESTAMP_NTZ"},
}
_TOKEN = re.compile(r"`((?:[^`]|``)*)`|([<>,:])|([^<>,:`\s]+)")

Shape = str | list | dict


def shape_of(text: str) -> Shape:
    """A VARIANT's shape from its text form: a type's name, ``[element]`` or ``{field: shape}``."""
    tokens = [(quoted.replace("``", "`") if quoted else mark or word, mark) for quoted, mark, word in _TOKEN.findall(text)]

    def read(at: int) -> tuple[Shape, int]:
        name = tokens[at][0]
        if at + 1 == len(tokens) or tokens[at + 1][1] != "<":
            return name, at + 1
        if name == "ARRAY":
            inner, at = read(at + 2)
            return [inner], at + 1
        fields, at = {}, at + 2
        while tokens[at][1] != ">":
            key = tokens[at][0]
            fields[key], at = read(at + 2)
            at += tokens[at][1] == ","
        return fields, at + 1

    return read(0)[0]


def differences(found: Shape, saved: T.DataType, path: str = "") -> Iterator[tuple[str, str]]:
    """``(path, kind)`` for every place where ``saved`` does not read a record of shape ``found``."""
    if isinstance(saved, T.ArrayType):
        yield from differences(found[0] if isinstance(found, list) else found, saved.elementType, path)
    elif isinstance(found, list):
        yield path, REPEATED
        yield from differences(found[0], saved, path)
    elif isinstance(found, dict) and isinstance(saved, T.StructType):
        known = {f.name: f.dataType for f in saved.fields}
        for name, inner in found.items():
            below = f"{path}/{name}".lstrip("/")
            if name in known:
                yield from differences(inner, known[name], below)
            else:
                yield below, ADDED
    elif isinstance(found, dict):
        inner = {k: v for k, v in found.items() if not k.startswith("_")}
        if inner:
            yield path, NESTED
        else:
            yield from ((f"{path}/{k}", ADDED) for k in found if k != "_VALUE")
            yield from differences(found.get("_VALUE", "VOID"), saved, path)
    elif isinstance(saved, T.StructType):
        if found != "VOID":
            value = [f.dataType for f in saved.fields if f.name == "_VALUE"]
            yield from differences(found, value[0], path) if value else [(path, RETYPED)]
    elif found != "VOID" and found not in READS.get(saved.simpleString(), {found}):
        yield path, RETYPED


def schema_drift(spark: SparkSession, paths: Paths, schema: T.StructType, split: bool = True) -> DataFrame:
    """``path``, ``kind`` and ``n_records`` of everything under ``paths`` that ``schema`` misses.

    A run under a saved schema leaves such values out without a word; this job names them, so
    that the schema can be inferred anew. Records are read without a schema and counted by their
    shape first, of which an extract has few; each shape is then held against the schema once.
    Malformed records are left to :func:`terravane.sources.xml.bad_records`; an empty extract has
    no rows.
    """
    rows = parsed_variants(spark, paths, split).where(F.col(CORRUPT).isNull())
    shape = F.regexp_replace(F.schema_of_variant(FIELDS), r"DECIMAL\([^)]*\)", "DECIMAL")
    shapes = rows.groupBy(shape.alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    saved = schema.json()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = T.StructType.fromJson(json.loads(saved))
        for batch in batches:
            found = [
                {"path": path, "kind": what, "n": n}
                for text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for path, what in sorted(set(differences(shape_of(text), kind)))
            ]
            names = pa.schema([("path", pa.string()), ("kind", pa.string()), ("n", pa.int64())])
            yield pa.RecordBatch.from_pylist(found, names)

    found = shapes.mapInArrow(compare, "path string, kind string, n long")
    return found.groupBy("path", "kind").agg(F.sum("n").alias("n_records"))
