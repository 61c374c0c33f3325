"""Compares a query with its SQL on the same tables."""

import math
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(path: str = DATA):
    d = duckdb.connect()
    for f in os.listdir(path):
        if f.endswith(".parquet"):
            d.sql(f"create view {f[:-8]} as select * from '{path}/{f}'")
    return d


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def rows(columns, values):
    order = sorted(columns)
    return order, sorted(tuple(norm(r[columns.index(k)]) for k in order) for r in values)


def same(spark, db, run, sql):
    df = run(spark, DATA)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    c = db.sql(sql)
    theirs = rows([x[0] for x in c.description], c.fetchall())
    assert mine == theirs
