"""Compares a Spark result with DuckDB's, as multisets of rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

FAMILIES = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "hugeint": "int",
    "integer": "int", "string": "text", "varchar": "text", "date": "date",
    "timestamp": "time", "timestamp_ntz": "time", "double": "float", "float": "float",
    "boolean": "bool",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty if nothing does."""
    found = []
    columns = sorted(result.columns)
    answer = con.execute(sql)
    kinds = {d[0]: str(d[1]).lower() for d in answer.description}
    if columns != sorted(kinds):
        return [f"columns: {sorted(set(columns) ^ set(kinds))}"]
    for name, kind in result.dtypes:
        if FAMILIES.get(kind, kind) != FAMILIES.get(kinds[name], kinds[name]):
            found.append(f"type of {name}: {kind} / {kinds[name]}")
        elif kind != {"integer": "int", "varchar": "string"}.get(kinds[name], kinds[name]):
            found.append(f"width of {name}: {kind} / {kinds[name]}")
    order = [d[0] for d in answer.description]
    places = [order.index(c) for c in columns]
    right = Counter(tuple(_plain(row[i]) for i in places) for row in answer.fetchall())
    left = Counter(tuple(_plain(v) for v in row) for row in result.select(*columns).collect())
    if left != right:
        found.append(f"rows: {sum(left.values())} / {sum(right.values())}")
        found.append(f"only Spark: {list((left - right).items())[:3]}")
        found.append(f"only SQL: {list((right - left).items())[:3]}")
        found.append(f"columns in order: {columns}")
    return found
