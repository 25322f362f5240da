"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import decimal
import glob
import os

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return str([_plain(x) for x in v])
    return v


def same_rows(spark, con, sf: str, run, sql: str) -> None:
    df = run(spark, sf)
    columns = sorted(df.columns)
    got = sorted(str([_plain(r[c]) for c in columns]) for r in df.collect())
    cursor = con.execute(sql)
    at = [d[0] for d in cursor.description]
    assert sorted(at) == columns
    want = sorted(str([_plain(r[at.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert got == want
