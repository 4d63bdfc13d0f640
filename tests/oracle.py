"""Compare a registered query with its SQL: names, types, row count and every value."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def text(value) -> str:
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def differences(df, connection, sql) -> list[str]:
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    actual = [tuple(row) for row in df.collect()]
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    if len(expected) != len(actual):
        problems.append(f"{len(actual)} rows instead of {len(expected)}")
    for ours, theirs in zip(sorted_rows(df.columns, actual), sorted_rows(names, expected)):
        if ours != theirs:
            problems.append(f"{ours} instead of {theirs}")
        if len(problems) > 3:
            break
    kinds = dict(zip(names, (str(d[1]) for d in connection.execute(f"DESCRIBE {sql}").fetchall())))
    spark_kinds = {
        "boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP",
    }
    for name, kind in df.dtypes:
        if spark_kinds.get(kind) != kinds[name]:
            problems.append(f"{name} is {kind}, expected {kinds[name]}")
    return problems
