"""Comparison of a DataFrame with SQL over the same rows."""

import math

import duckdb


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(float(v)) if isinstance(v, (int, float)) else str(v)


def compared(df, query, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t.toArrow())
    found = con.execute(query)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    mine = sorted(tuple(cell(r[n]) for n in sorted(names)) for r in df.collect())
    theirs = sorted(tuple(cell(v) for _, v in sorted(zip(names, row), key=lambda x: x[0])) for row in found.fetchall())
    assert mine == theirs
