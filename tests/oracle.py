"""Compare a workload query with its SQL on DuckDB, value by value."""

from __future__ import annotations

import decimal
import math

import duckdb

from maskloom.workload.rules import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


SPARK_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date"}


def difference(frame, connection, sql: str) -> str | None:
    """None when both sides agree, else a short account of the first difference."""
    result = connection.execute(sql)
    types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    spark_types = dict(frame.dtypes)
    wrong = {name: (spark_types.get(name), kind) for name, kind in types.items() if spark_types.get(name, kind) != kind}
    if wrong:
        return f"types {wrong}"
    names, expected = sorted_rows([d[0] for d in result.description], result.fetchall())
    got_names, got = sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    if names != got_names:
        return f"columns {got_names} instead of {names}"
    if len(expected) != len(got):
        return f"{len(got)} rows instead of {len(expected)}"
    for left, right in zip(got, expected):
        if left != right:
            return f"{left} instead of {right}"
    return None
