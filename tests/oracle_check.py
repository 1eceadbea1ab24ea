"""Compare registered queries with their DuckDB statements."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            db.execute(f"create view {name} as select * from '{path}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, (dt.date, dt.datetime)):
        return f"{type(value).__name__} {value}"
    if isinstance(value, bool):
        return f"bool {value}"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_rows(df: DataFrame):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(db: duckdb.DuckDBPyConnection, sql: str):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _rows(names, result.fetchall())
