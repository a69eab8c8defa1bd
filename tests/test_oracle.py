"""Every query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import difference

import __spark_entry__ as driver

QUERIES = driver.QUERIES
SQL = driver.SQL


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    assert difference(spark, QUERIES[name], SQL[name], sf_dir) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == [
        "objType", "identificatie", "historieIdentificatie", "vlakID", "puntID", "lat", "long", "refID",
    ]
    assert df.count() > 0
