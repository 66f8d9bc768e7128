"""Centroid clustering against SQL and a plain version; bounds never above distances."""

import hashlib
import math

import numpy as np
import pytest
from conftest_rows import compared

from riskrules.llm import centroids
from riskrules.llm.common import prepared

SCHEMA = "vec_id long, embedding array<float>, label int, v int, cached string, distance int"


def rows_of(n, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, 64)) * 3
    rows = [(i, [float(x) for x in (middles[i % 12] + rng.normal(size=64) * 0.05).astype("f4")]) for i in range(n)]
    rows += [(n + i, rows[i % 3][1]) for i in range(n // 3)]  # copies
    odd = [None, [], [0.5] * 63, [0.5] * 65, [0.5] * 63 + [None], [0.5] * 63 + [math.nan], [math.inf] + [0.0] * 63]
    rows += [(900_000 + i, v) for i, v in enumerate(odd)]
    rows += [(5, rows[7][1]), (5, rows[7][1]), (None, rows[8][1]), (800_000, [0.0] * 64), (800_001, [-0.001] * 64), (800_002, [300.0] * 64)]
    return rows


@pytest.fixture
def vectors(spark):
    prepared(spark)
    return lambda rows: spark.createDataFrame([(*r, 0, 0, "", 0) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("n", [0, 10, 400])
def test_same_as_sql(vectors, n):
    table = vectors(rows_of(n) if n else rows_of(9)[-6:])
    compared(centroids.clustered(table).drop("measured"), centroids.oracle(), embeddings=table.select("vec_id", "embedding"))


def test_empty(vectors):
    assert centroids.clustered(vectors([(1, [1.0])])).count() == 0
    assert centroids.clustered(vectors([(1, [1.0])]).limit(0)).count() == 0


def test_bounds_spare_most_centroids(vectors):
    """Where vectors do lie around centroids, few are measured."""
    found = centroids.clustered(vectors([r for r in rows_of(600) if r[0] is not None and r[0] < 600]))
    assert found.selectExpr("avg(measured)").first()[0] < 12


def test_bounds_are_lower_bounds():
    rng = np.random.default_rng(1)
    for scale in (3, 1_000, 1 << 24):
        v, c = rng.integers(-scale, scale, (300, 64)), rng.integers(-scale, scale, (40, 64))
        v[:40] = c  # distance 0
        c[5] = c[6]
        fixed = centroids.pivots(c)
        bounds = centroids.Bounds(c, fixed)
        cached = centroids._roots(v, fixed)
        true = np.stack([((v - x) ** 2).sum(1) for x in c], 1)
        assert (bounds.of(cached) <= np.sqrt(true.astype(float))).all()
        number, square, measured = bounds.nearest(v, cached)
        assert (number == true.argmin(1)).all() and (square == true.min(1)).all() and (measured >= 1).all()


def test_wide_components(vectors):
    """Beyond 64 bits: exact in Python's integers, given as the largest long."""
    rows = [(0, [1e9] + [0.0] * 63), (1, [1e9 + 1e6] + [0.0] * 63), (2, [3e38] * 64), (3, [-3e38] * 64), (4, [0.0] * 64)]
    found = {r.vec_id: r for r in centroids.clustered(vectors(rows), count=2).collect()}
    order = sorted(range(5), key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())
    limit = 1 << 62
    whole = [[max(-limit, min(limit, math.floor(256 * float(np.float32(x))))) for x in v] for _, v in rows]
    middle = [whole[i] for i in order[:2]]
    for step in range(6):
        away = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in middle] for v in whole]
        best = [min(range(2), key=lambda k: (d[k], k)) for d in away]
        if step < 5:
            for k in range(2):
                own = [whole[i] for i in range(5) if best[i] == k]
                if own:
                    middle[k] = [sum(x) // len(own) for x in zip(*own)]
    assert [found[i].cluster for i in range(5)] == best
    assert [found[i].distance for i in range(5)] == [min(away[i][best[i]], (1 << 63) - 1) for i in range(5)]
    assert found[4].inertia <= (1 << 63) - 1
