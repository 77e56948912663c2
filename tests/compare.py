"""Runs a query and its oracle and compares them as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


def differences(con, df, sql: str) -> str | None:
    found = con.execute(sql)
    names, expected = [d[0] for d in found.description], found.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    got, want = rows(df.columns, df.collect()), rows(names, expected)
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows instead of {sum(want.values())}; "
        f"extra {list((got - want).items())[:2]}, missing {list((want - got).items())[:2]}"
    )
