"""Trees and forests over blocks: against a plain recursion, wherever the growing is done."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskrules.operators import evaluation, forests

BINS = 16


def impurity(criterion, n, p):
    if criterion == "gini":
        return 2 * p * (n - p) / n if n else 0.0
    return sum(-k * np.log(k / n) for k in (p, n - p) if k > 0)


def plain(b, y, w, growth, depth):
    """Scores of all rows by trying every split of every node."""
    out = np.zeros(len(y))

    def down(rows, level):
        n, p = w[rows].sum(), (w * y)[rows].sum()
        best = None
        for f in range(b.shape[1]) if level < depth else ():
            for bound in range(BINS + 1):
                left = rows[b[rows, f] <= bound]
                ln, lp = w[left].sum(), (w * y)[left].sum()
                if min(ln, n - ln) >= growth.leaf_size:
                    gain = round(impurity(growth.criterion, n, p) - impurity(growth.criterion, ln, lp) - impurity(growth.criterion, n - ln, p - lp), 9)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = gain, f, bound
        if best is None:
            out[rows] = p / n if n else 0.0
            return
        _, f, bound = best
        down(rows[b[rows, f] <= bound], level + 1)
        down(rows[b[rows, f] > bound], level + 1)

    down(np.arange(len(y)), 0)
    return out


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    out = []
    for i in range(1500):
        x, y, z = rng.integers(0, 30), rng.random(), rng.integers(0, 3)
        out.append((i, int(rng.integers(0, 3)) if i % 20 else None, int(rng.random() < 0.1 + 0.6 * (x > 12) * (y > 0.6)), float(x), float(y) if i % 9 else None, float(z)))
    return spark.createDataFrame(out, "id long, block int, label int, x double, y double, z double").repartition(4)


@pytest.fixture(scope="module")
def table(rows):
    return forests.binned(rows, ["x", "y", "z"], "id", "label", "block", BINS)


GROWTHS = [forests.Growth("gini", 20, (0, 2, 5)), forests.Growth("entropy", 45, (3,))]


@pytest.mark.parametrize("local_rows", [10**6, 150])
def test_trees_as_by_plain_recursion(table, local_rows):
    data = table.orderBy("row_id").collect()
    b = np.array([list(r.b) for r in data])
    y, block = np.array([r.label for r in data]), np.array([-1 if r.block is None else r.block for r in data])
    found = {(r.model, r.row_id): r.score for r in forests.out_of_block(table, GROWTHS, local_rows=local_rows).collect()}
    assert len(found) == 4 * len(data)
    for out in (-1, 0, 1, 2):
        w = ((block != out) & (block != -1)).astype(float)
        for growth in GROWTHS:
            for name, depth in zip(growth.names, growth.depths):
                scores = plain(b, y, w, growth, depth)
                for r, s in zip(data, scores):
                    if (-1 if r.block is None else r.block) == out:
                        assert found[name, r.row_id] == pytest.approx(s, abs=1e-9)


def as_dict(df):
    return {(r.model, r.row_id): r.score for r in df.collect()}


def test_forest_is_the_same_however_rows_lie(rows, table, monkeypatch):
    grown = dict(trees=7, take=2)
    growths = [forests.Growth("gini", 5, (3, 8))]
    first = as_dict(forests.out_of_block(table, growths, **grown))
    again = forests.binned(rows.repartition(7, "z"), ["x", "y", "z"], "id", "label", "block", BINS)
    assert as_dict(forests.out_of_block(again, growths, **grown)) == first
    assert as_dict(forests.out_of_block(table, growths, local_rows=200, **grown)) == first
    monkeypatch.setattr(forests, "SCORED_ROWS", 100)
    assert as_dict(forests.out_of_block(table, growths, **grown)) == first
    assert len(set(first.values())) > 50 and as_dict(forests.out_of_block(table, growths, seed=1, **grown)) != first


def test_forest_finds_the_planted_rule(table):
    scored = forests.out_of_block(table, [forests.Growth("gini", 5, (6,))], trees=20, take=2)
    assert evaluation.auc(scored).first()["auc"] > 0.75


def test_weights_are_poisson(spark):
    drawn = spark.range(20_000).select(forests.poisson(F.col("id"), F.lit(3), 42).alias("w"))
    mean, variance, none = drawn.select(F.avg("w"), F.variance("w"), F.avg((F.col("w") == 0).cast("double"))).first()
    assert abs(mean - 1) < 0.03 and abs(variance - 1) < 0.05 and abs(none - np.exp(-1)) < 0.02


def test_bags_are_the_poisson_counts_of_the_table(spark):
    rows = [-(2**63), -5, 0, 7, 2**62 + 3, *range(1_000, 1_400)]
    drawn = spark.createDataFrame([(r, t) for r in rows for t in range(6)], "id long, tree int").withColumn("w", forests.poisson(F.col("id"), F.col("tree"), 42))
    assert {(r.id, r.tree): r.w for r in drawn.collect()} == {(r, t): w for r, ws in zip(rows, forests.bags(np.array(rows), 6, 42)) for t, w in enumerate(ws)}


def test_no_row_is_repeated_for_a_tree(spark, monkeypatch):
    """Equal rows of bins are one cell: 4,000 rows of six kinds, 40 trees, and no table of rows and trees."""
    rows = spark.range(4_000).selectExpr("id", "cast(id % 3 as int) AS block", "cast(id % 7 = 0 as int) AS label", "cast(id % 2 as double) AS x", "cast(id % 3 as double) AS y")
    table = forests.binned(rows, ["x", "y"], "id", "label", "block", BINS)
    seen = []
    one = forests.cut
    monkeypatch.setattr(forests, "cut", lambda df: (out := one(df), seen.append(out.count()))[0])
    scored = forests.out_of_block(table, [forests.Growth("gini", 5, (6,))], trees=40, take=1)
    assert scored.count() == 4_000 and max(seen) <= 18


def test_little(spark):
    schema = "id long, block int, label int, x double"
    empty = forests.binned(spark.createDataFrame([], schema), ["x"], "id", "label", "block", 8)
    assert forests.out_of_block(empty, GROWTHS).count() == 0
    alone = forests.binned(spark.createDataFrame([(1, 0, 1, 2.0), (2, 0, 0, None)], schema), ["x"], "id", "label", "block", 8)
    assert {r.score for r in forests.out_of_block(alone, GROWTHS).collect()} == {0.0}
    with pytest.raises(ValueError):
        forests.binned(spark.createDataFrame([], schema), ["x"], "id", "label", "block", 300)
