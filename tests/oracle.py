"""Side-by-side comparison of a query with its SQL on the same Parquet tables."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the DataFrame and the SQL result; empty when nothing does."""
    result = connection.execute(sql)
    expected_names = [column[0] for column in result.description]
    expected = result.fetchall()
    actual = df.collect()
    if sorted(df.columns) != sorted(expected_names):
        return [f"columns {sorted(set(df.columns) ^ set(expected_names))}"]
    left, right = _rows(df.columns, actual), _rows(expected_names, expected)
    if left == right:
        return []
    problems = [f"rows {len(actual)} / {len(expected)}"]
    problems += [f"only here  {row}"[:600] for row in list((left - right))[:3]]
    problems += [f"only there {row}"[:600] for row in list((right - left))[:3]]
    return problems
