"""Holds a Spark query against its DuckDB SQL: same columns, same rows in any order."""

import math
import os

import duckdb


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return "0" if abs(v) < 1e-9 else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return str(v)


def connect(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return con


def assert_same(df, relation):
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    place = [relation.columns.index(c) for c in columns]
    got = sorted(tuple(map(norm, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    want = sorted(tuple(norm(r[i]) for i in place) for r in relation.fetchall())
    assert got == want
