"""Compare a Spark query with its SQL twin, row by row and type by type."""

from __future__ import annotations


from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _kind(value) -> str:
    return "null" if value is None else type(value).__name__


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, _kind(v), v) for v in row)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = (tuple(row[i] for i in order) for row in rows)
    return sorted(plain, key=_sortable)


def difference(spark, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, else the first difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = connect(sf_dir).execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not got:
        return "no rows"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b or [_kind(v) for v in a] != [_kind(v) for v in b]:
            return f"{sorted(names)}: {a} != {b}"
    return None



