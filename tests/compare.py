"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(path: str, files: str = "") -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        source = f"{path}/{table}.parquet" + (f"/{files}" if files else "")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want = canonical([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"row {a} != {b}"
    return None
