"""Compare a Spark result with the SQL oracle run by DuckDB: names, number of rows and every value, whatever the order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(directory: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimal in a result: cast it")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(part) for part in value)
    return value


def as_multiset(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple((type(plain(row[i])).__name__, plain(row[i])) for i in order) for row in rows)


def oracle_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return as_multiset(names, result.fetchall())


def spark_rows(df):
    return as_multiset(df.columns, [tuple(row) for row in df.collect()])
