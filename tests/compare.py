"""Spark results against DuckDB results: columns by name, rows in any order, values exact."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    return str(value) if isinstance(value, datetime.date) else value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


FAMILY = {
    "bigint": "int", "int": "int", "integer": "int", "string": "text", "varchar": "text",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp", "double": "double", "date": "date", "boolean": "boolean",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    expected = _sorted_rows(columns, answer.fetchall())
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {row[0]: FAMILY.get(row[1].lower(), row[1]) for row in described}
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    ours = {name: FAMILY.get(kind, kind) for name, kind in df.dtypes}
    if ours != types:
        return f"types differ: {[(c, ours[c], types[c]) for c in ours if ours[c] != types[c]]}"
    got = _sorted_rows(df.columns, df.collect())
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
