"""Compare a query with its SQL in DuckDB."""

import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"create view {name.split('.')[0]} as select * from '{folder}/{name}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return "null" if v is None else str(v)


def same(spark, folder, query, sql):
    df = query(spark, folder)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = connect(folder).sql(sql)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
