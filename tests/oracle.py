"""Side-by-side run of a registered query and its checking SQL."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return ("decimal", value)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def _rows(names: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


_SAME_KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between both results: none when they agree in names, types and rows."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    rows = expected.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} but expected {sorted(names)}"]
    for name, kind in df.dtypes:
        want = kind.upper() if kind.startswith("decimal") else _SAME_KIND.get(kind, kind)
        if want.replace(" ", "") != kinds[name].replace(" ", ""):
            problems.append(f"{name}: {kind} but expected {kinds[name]}")
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(names, rows)
    if ours != theirs:
        a, b = set(ours), set(theirs)
        problems.append(
            f"{len(ours)} rows, expected {len(theirs)}; only ours {sorted(a - b)[:2]}, only expected {sorted(b - a)[:2]}"
        )
    return problems
