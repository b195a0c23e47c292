"""Holds a query's rows against those of its SQL in DuckDB."""

import datetime
import decimal
import os

import duckdb
import numpy as np

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


def connection(folder=DATA):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, (list, tuple, np.ndarray)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return repr(v)


def assert_same(df, sql, con):
    rows, names = df.collect(), sorted(df.columns)
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    order = [columns.index(c) for c in names]
    ours = sorted(tuple(plain(r[c]) for c in names) for r in rows)
    theirs = sorted(tuple(plain(r[i]) for i in order) for r in found.fetchall())
    assert ours == theirs
