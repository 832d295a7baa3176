"""Holds Spark rows against DuckDB's for a query, order aside."""

import datetime
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        con.sql(f"create view {name} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(([_plain(r[k]) for k in order] for r in rows), key=repr)


def same(df, con, sql):
    names = df.columns
    got = rows_of(names, [tuple(r) for r in df.collect()])
    found = con.sql(sql)
    want = rows_of(found.columns, found.fetchall())
    assert sorted(names) == sorted(found.columns)
    assert len(got) == len(want), (len(got), len(want))
    for a, b in zip(got, want, strict=True):
        assert a == b, (a, b)
