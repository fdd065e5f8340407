"""Compare a query with its SQL twin: names, types, rows."""

from __future__ import annotations

import collections
import datetime
import decimal
import math

import duckdb

from candlemill.registry.base import TABLES

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """What differs, empty when nothing does."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        expected = SAME_TYPE.get(field.dataType.simpleString())
        if expected != types[field.name].upper():
            found.append(f"{field.name} is {field.dataType.simpleString()} against {types[field.name]}")
    here, there = df.collect(), result.fetchall()
    if len(here) != len(there):
        found.append(f"{len(here)} rows against {len(there)}")
    if not there:
        found.append("no rows")
    ours, theirs = _bag(here, df.columns), _bag(there, names)
    if ours != theirs:
        found.append(f"only here {list((ours - theirs).items())[:2]}, only there {list((theirs - ours).items())[:2]}")
        found.append(f"{sum((ours - theirs).values())} rows differ")
    return found
