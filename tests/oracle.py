"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    return repr(v)


def canonical(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, query, folder: str) -> str:
    """Empty if equal, else what differs."""
    df = query.run(spark, folder)
    got = canonical(df.columns, df.collect())
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    want = canonical(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if got == want:
        return ""
    a, b = set(got) - set(want), set(want) - set(got)
    return (f"{len(got)} against {len(want)} rows in SQL; only in Spark {sorted(a)[:3]}, "
            f"only in SQL {sorted(b)[:3]} (columns {sorted(names)})")
