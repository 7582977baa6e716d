"""Run a catalogue query and its SQL counterpart, and list what differs."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    return connection


_SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _cell(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _bag(rows) -> Counter:
    return Counter(tuple(_cell(value) for value in row) for row in rows)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    types = dict(connection.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    cursor = connection.execute(sql)
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)}, sql {sorted(names)}"]
    found = [
        f"type of {name}: spark {kind}, sql {types[name]}"
        for name, kind in df.dtypes
        if _SQL_TYPES.get(kind) != types[name]
    ]
    order = [names.index(name) for name in sorted(names)]
    expected = _bag(tuple(row[i] for i in order) for row in cursor.fetchall())
    actual = _bag(df.select(*(f"`{name}`" for name in sorted(df.columns))).collect())
    if sum(expected.values()) != sum(actual.values()):
        found.append(f"rows: spark {sum(actual.values())}, sql {sum(expected.values())}")
    for title, left, right in (("only in spark", actual, expected), ("only in sql", expected, actual)):
        rest = left - right
        if rest:
            found.append(f"{title}: {sum(rest.values())}, e.g. {list(rest)[:2]}")
    return found
