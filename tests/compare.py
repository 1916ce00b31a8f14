"""Compare a Spark result with an SQL result: columns, types and rows in any order."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

SAME_TYPE = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _rows(rows, order):
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def differences(df, connection, sql: str) -> list[str]:
    """Empty when both results agree."""
    relation = connection.sql(sql)
    names, kinds = relation.columns, [str(t) for t in relation.types]
    theirs = dict(zip(names, kinds))
    ours = dict(df.dtypes)
    if set(ours) != set(theirs):
        return [f"columns: {sorted(set(ours) ^ set(theirs))}"]
    found = [f"type of {c}: {ours[c]} / {theirs[c]}" for c in ours if SAME_TYPE.get(theirs[c]) != ours[c]]
    columns = sorted(ours)
    left = _rows(df.collect(), [df.columns.index(c) for c in columns])
    right = _rows(relation.fetchall(), [names.index(c) for c in columns])
    if len(left) != len(right):
        found.append(f"rows: {len(left)} / {len(right)}")
    if left != right:
        in_left, in_right = set(left), set(right)
        only_left = [r for r in left if r not in in_right][:2]
        only_right = [r for r in right if r not in in_left][:2]
        found.append(f"values: {columns}\n  spark {only_left}\n  sql   {only_right}")
    return found
