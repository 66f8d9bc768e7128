"""Nodes too large for one task: two passes a level over rows that are written once."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from riskrules import session
from riskrules.operators import large_nodes, trees
from riskrules.operators.trees import _own_edges
from riskrules.plans.catalog import REGISTRY

SCHEMA = "g string, x double, y double, z double, label int"


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers that nearly all differ, few different ones, a value in half the rows with others close to it, and a
    negative zero; a small segment beside two large ones."""
    rng = np.random.default_rng(4)
    out = []
    for g, n in (("a", 6000), ("b", 2500), ("c", 40)):
        x, y = rng.lognormal(size=n), rng.integers(-2, 4, n) * 1.0
        z = np.where(rng.random(n) < 0.5, 0.3, np.nextafter(0.3, 1) + rng.integers(0, 3, n) * 1e-16)
        hit = rng.random(n) < 0.1 + 0.3 * (x > 1.3) + 0.4 * (y > 2)
        out += [(g, float(a), None if b == -2 else -0.0 if b == -1 else float(b), float(c), int(h)) for a, b, c, h in zip(x, y, z, hit)]
    return spark.createDataFrame([*out, ("a", 1.0, 1.0, 1.0, None), (None, 1.0, 1.0, 1.0, 1)], SCHEMA).repartition(5)


def told(df):
    return sorted((r.g, r.node_id, tuple(map(tuple, r.conditions)), r.is_leaf, r.n, r.positives) for r in df.collect())


GROWN = dict(depth=4, leaf_size=25, bins=16)


def test_large_nodes_are_written_once(rows, monkeypatch):
    """Sizes, segments, blocks and result are written; no level writes rows or tables of its own."""
    written, cut = [], trees.cut
    monkeypatch.setattr(trees, "cut", lambda *a: written.append(a) or cut(*a))
    here = told(trees.by_segment(rows, ["x", "y", "z"], "label", ["g"], **GROWN))
    written.clear()
    assert told(trees.by_segment(rows, ["x", "y", "z"], "label", ["g"], local_rows=300, **GROWN)) == here and len(here) > 30
    assert len(written) == 4


@pytest.mark.parametrize("bounds", [dict(CUTS=20, SAMPLE_ROWS=200, PART_ROWS=50), dict(CUTS=7, SAMPLE_ROWS=0), dict(BLOCK_ROWS=100, FILE_BLOCKS=3, STATE_NUMBERS=1, PART_ROWS=300)])
def test_bounds_change_nothing(rows, monkeypatch, bounds):
    """Few cuts, no sample, small parts and blocks, one node at a time."""
    here = told(trees.by_segment(rows, ["x", "y", "z"], "label", ["g"], **GROWN))
    for name, value in bounds.items():
        monkeypatch.setattr(large_nodes, name, value)
    assert told(trees.by_segment(rows, ["x", "y", "z"], "label", ["g"], local_rows=700, **GROWN)) == here


def test_edges_and_counts_are_exact(rows, monkeypatch):
    """Of a whole segment, against its sorted values."""
    monkeypatch.setattr(large_nodes, "CUTS", 30)
    features = ["x", "y", "z"]
    mine = rows.filter("g = 'a'").na.fill(0.0, features).selectExpr("0 AS _s", *features, "coalesce(label, 0) AS _y")
    blocks = trees.cut(large_nodes.packed(mine, features, {0: 0.05}))
    table = mine.toPandas()
    nodes = large_nodes.Nodes()
    nodes.add(0, 1, (), len(table), int(table["_y"].sum()))
    ((node, found),) = large_nodes.edge_counts(blocks, nodes, [0], large_nodes.sample(blocks, 3), 3, 16)
    assert node == 0
    for f, (edges, n, p) in zip(features, found):
        assert edges.tolist() == _own_edges(np.sort(table[f].to_numpy() + 0.0), 16).tolist() and len(edges) >= 3
        below = [table[table[f] <= e] for e in edges]
        assert n.tolist() == [len(b) for b in below] and p.tolist() == [b["_y"].sum() for b in below]


def test_batches_are_small_only_within(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), large_nodes.small_batches(spark):
        assert int(spark.conf.get(key).rstrip("b")) == large_nodes.BATCH_BYTES
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_the_query_by_segment_writes_its_rows_once(spark, tmp_path):
    """Segments beyond the query's 20,000 rows: four tables are written, and the leaves hold every row once."""
    rng = np.random.default_rng(6)
    n = 50_000
    made = dict(l_orderkey=np.arange(n), l_quantity=rng.integers(1, 51, n) * 1.0, l_discount=rng.integers(0, 11, n) / 100, l_tax=rng.integers(0, 9, n) / 100, l_extendedprice=rng.uniform(900, 100_000, n), l_returnflag=rng.choice(["R", "A", "N"], n), l_linestatus=np.where(np.arange(n) < 26_000, "F", "O"))
    pq.write_table(pa.table(made), tmp_path / "lineitem.parquet")
    before = len(session._WRITTEN)
    found = REGISTRY["tree_rules_by_segment"](spark, str(tmp_path))
    assert len(session._WRITTEN) - before == 4
    leaves = {}
    for r in found.collect():
        leaves.setdefault(r.l_linestatus, []).append((r.n, r.positives))
    hit = (made["l_returnflag"] == "R") & (made["l_quantity"] * made["l_discount"] > 1.5)
    for status, told_leaves in leaves.items():
        mine = made["l_linestatus"] == status
        assert 2 <= len(told_leaves) <= 4 and [sum(c) for c in zip(*told_leaves)] == [mine.sum(), hit[mine].sum()]
    assert set(leaves) == {"F", "O"}
