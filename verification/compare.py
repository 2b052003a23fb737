"""Compare a query with its SQL on DuckDB: column names, row count, values regardless of order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(file))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(repr(tuple(plain(r[k]) for k in order)) for r in rows)


def spark_rows(df) -> tuple[list[str], list[str]]:
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str]]:
    result = con.execute(sql)
    return normal([d[0] for d in result.description], result.fetchall())
