"""Comparison of a Spark result with the same query run by DuckDB."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def _key(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def differences(df, connection, sql: str) -> list[str]:
    """What differs in columns, types and rows; empty when the results are equal."""
    found = []
    relation = connection.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    ours = {c: TYPES.get(t, t) for c, t in df.dtypes}
    if theirs != ours:
        found.append(f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}")
    names = sorted(ours)
    if sorted(theirs) != names:
        return found
    left = Counter(tuple(_key(r[c]) for c in names) for r in df.collect())
    order = [relation.columns.index(c) for c in names]
    right = Counter(tuple(_key(r[i]) for i in order) for r in relation.fetchall())
    if left != right:
        only_left, only_right = left - right, right - left
        found.append(
            f"rows: {sum(left.values())} vs {sum(right.values())}, columns {names}, "
            f"only ours {list(only_left)[:2]}, only theirs {list(only_right)[:2]}"
        )
    return found
