"""Runs a registered query and its SQL twin and compares the results value by value."""
from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """One textual form per value, whatever engine it came from."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.10g}"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else a description of the first difference."""
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} <> {sorted(columns)}"
    if len(mine) != len(theirs):
        extra = (set(mine) ^ set(theirs))
        return f"{len(mine)} rows <> {len(theirs)}; e.g. {sorted(extra)[:4]}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(columns)}: {a} <> {b}"
    return None
