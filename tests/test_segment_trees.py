"""Trees of segments with thresholds of their own."""

import numpy as np
import pytest

from riskrules.operators import trees

SCHEMA = "g string, x double, y double, label int"


@pytest.fixture(scope="module")
def rows(spark):
    """Segment a fills x from 0 to 1000; in the small segment b labels turn at 500.25, between two edges of the whole."""
    rng = np.random.default_rng(8)
    out = [("a", float(x), float(y), int(rng.random() < 0.3)) for x, y in zip(rng.uniform(0, 1000, 4000), rng.integers(0, 5, 4000))]
    out += [("b", float(x), float(y), int(x > 500.25)) for x, y in zip(rng.uniform(500, 500.5, 300), rng.integers(0, 5, 300))]
    out += [("c", None, float("nan"), i % 2) for i in range(50)] + [("d", 1.0, 1.0, 1)] * 30 + [(None, 1.0, 1.0, 1)]
    return spark.createDataFrame(out, SCHEMA).repartition(4)


def told(df):
    return sorted((r.g, r.node_id, tuple(map(tuple, r.conditions)), r.is_leaf, r.n, r.positives) for r in df.collect())


def test_a_segment_finds_its_own_threshold(rows):
    found = trees.by_segment(rows, ["x", "y"], "label", ["g"], depth=3, leaf_size=20, bins=16)
    b = {r.node_id: r for r in found.filter("g = 'b'").collect()}
    feature, _, limit = b[2].conditions[0]
    assert feature == "x" and 500.2 < limit < 500.3  # whole-table edges lie about 60 apart
    deep = [r for r in b.values() if r.is_leaf]
    assert sum(r.n for r in deep) == 300 and max(min(r.positives, r.n - r.positives) for r in deep) <= 10
    at = {(r.g, r.node_id): r for r in found.collect()}
    for (g, i), r in at.items():
        if not r.is_leaf:
            low, high = at[g, 2 * i], at[g, 2 * i + 1]
            assert r.n == low.n + high.n and r.positives == low.positives + high.positives and min(low.n, high.n) >= 20
            assert low.conditions[:-1] == r.conditions == high.conditions[:-1]
    assert at["c", 1].is_leaf and at["d", 1].is_leaf and at["c", 1].n == 50 and (None, 1) not in at


@pytest.mark.parametrize("criterion", ["gini", "log_loss"])
def test_where_nodes_are_grown_changes_nothing(rows, criterion):
    grown = dict(criterion=criterion, depth=4, leaf_size=25, bins=8)
    here = told(trees.by_segment(rows, ["x", "y"], "label", ["g"], **grown))
    assert told(trees.by_segment(rows.repartition(3, "y"), ["x", "y"], "label", ["g"], local_rows=200, **grown)) == here and len(here) > 20


def test_nodes_at_the_last_level_stay_out_of_single_tasks(rows, monkeypatch):
    """Leaves of 300 and more rows are counted, not gathered."""
    grown = dict(depth=2, leaf_size=20, bins=8)
    whole = told(trees.by_segment(rows, ["x", "y"], "label", ["g"], **grown))

    def gathered(*_, **__):
        raise AssertionError("a node of the last level was gathered")

    monkeypatch.setattr(trees, "_grown_here", gathered)
    assert told(trees.by_segment(rows.filter("g = 'a'"), ["x", "y"], "label", ["g"], local_rows=10, **grown)) == [x for x in whole if x[0] == "a"]


def test_nothing(rows):
    assert trees.by_segment(rows.limit(0), ["x"], "label", ["g"]).count() == 0
    (stump,) = trees.by_segment(rows.filter("g = 'd'"), ["x"], "label", ["g"], local_rows=3).collect()
    assert stump.is_leaf and stump.n == stump.positives == 30
