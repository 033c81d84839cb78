"""Comparison of a Spark result with the DuckDB result of the same question."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder: str, files: str = "") -> duckdb.DuckDBPyConnection:
    """The given tables as views; `files` selects the files of a table that is a folder."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{Path(folder) / name}.parquet{files}')")
    return con


def plain(value):
    """A value in a form that does not depend on the engine. Doubles are compared to the last bit."""
    if isinstance(value, Decimal):
        return ("number", value.normalize())
    if isinstance(value, dt.datetime):
        return ("moment", value.isoformat())
    if isinstance(value, bool) or value is None or isinstance(value, (str, dt.date)):
        return (type(value).__name__, value)
    if isinstance(value, float):
        return ("double", value)
    return ("number", Decimal(value))


def as_counter(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def assert_same(df, con, sql: str) -> int:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected, got = as_counter(columns, result.fetchall()), as_counter(df.columns, df.collect())
    assert sum(got.values()) == sum(expected.values())
    assert got == expected, (list((got - expected).items())[:3], list((expected - got).items())[:3])
    return sum(got.values())
