"""Compare a registered query with its SQL counterpart, as multisets of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from starmill.registry.oracle import ORACLE
from starmill.registry.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value: object) -> object:
    """Values equal in both engines compare equal; numbers keep their type class."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def multiset(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def both(spark: SparkSession, name: str, folder: str) -> tuple[tuple, tuple]:
    """(sorted columns, rows) from Spark and from SQL."""
    df = QUERIES[name](spark, folder)
    ours = sorted(df.columns), multiset(df.columns, [tuple(r) for r in df.collect()])
    result = duck(folder).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    return ours, (sorted(columns), multiset(columns, result.fetchall()))
