"""Run a registered query and its oracle on the same files and compare them."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def kind(name: str) -> str:
    """Type names of both engines, mapped to one."""
    known = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    return known.get(name, name.upper())


def compare(df, connection, sql: str) -> None:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    oracle_types = {column[0]: str(column[1]) for column in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {name: kind(t) for name, t in df.dtypes} == oracle_types
    got, expected = rows_of(df.columns, df.collect()), rows_of(columns, result.fetchall())
    assert len(got) == len(expected)
    different = [(g, e) for g, e in zip(got, expected) if g != e]
    assert not different, f"{len(different)} rows differ, first: {different[:3]}"
