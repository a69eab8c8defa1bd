from __future__ import annotations

import os

import pytest

# One thread for each worker: they already share the cores.
os.environ.setdefault("OMP_NUM_THREADS", "1")
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, a clashing column."""
    prose = "One line of words here.\nAnother line of words there.\nA third line closes it."
    rows = [
        (1, prose, "en", "a", 80),
        (1, prose, "en", "a", 80),
        (2, prose, "en", "b", 80),
        (None, prose, None, None, None),
        (None, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n ", "fr", "a", 4),
        (5, None, "fr", "c", None),
        (6, "mot " * 60_000, "fr", "c", 240_000),
        (6, "autre texte", "fr", "c", 11),
        (7, "12 34 !!", "en", None, 8),
        (8, "É", "fr", "b", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = "size shard component_id fingerprint lang_pred _position _row _hash".split()
    for name in clashing:
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
