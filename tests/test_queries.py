"""Every registered query against its SQL twin, and the entry points."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from riskrules.plans.catalog import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    return repr(float(v)) if isinstance(v, (int, float)) else str(v)


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.oracle))
def test_same_as_sql(spark, duck, folder, name):
    found = REGISTRY[name](spark, folder)
    twin = duck.execute(REGISTRY[name].oracle)
    names = [d[0] for d in twin.description]
    assert sorted(found.columns) == sorted(names)
    mine, theirs = rows_of(found.collect(), found.columns), rows_of(twin.fetchall(), names)
    assert theirs, "the twin has no rows"
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if not q.oracle))
def test_runs(spark, folder, name):
    assert REGISTRY[name](spark, folder).count() > 0


def test_entry_points(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_every_operator_is_covered():
    covered = {i for q in REGISTRY.values() for i in q.covers}
    sizes = {"A": 9, "B": 14, "C": 12, "D": 30, "E": 20, "F": 4, "G": 4, "H": 35, "I": 8, "J": 15, "K": 9, "L": 24}
    wanted = {f"{s}{i}" for s, n in sizes.items() for i in range(1, n + 1)}
    assert wanted - covered == set()


def test_no_network_or_data_in_repo():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for base, _, files in os.walk(root):
        if ".git" not in base:
            assert not [f for f in files if f.endswith((".parquet", ".csv"))]
