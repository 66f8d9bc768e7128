"""Nearest neighbours against all pairs."""

import numpy as np
from pyspark.sql import functions as F

from riskrules.llm import neighbours
from riskrules.llm.common import prepared, table


def brute(rows, asked, count=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(asked(ids)):
        score = np.round(x @ x[i], 12)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]]
        out[ids[i]] = [(int(ids[j]), score[j]) for j in order[:count]]
    return out


def found_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_given_vectors(spark, folder):
    data = table(spark, folder, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in data.collect()]
    found = found_of(neighbours.nearest(data, F.col("vec_id") % 10 == 0))
    wanted = brute(rows, lambda ids: ids % 10 == 0)
    assert found.keys() == wanted.keys()
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in w}) for q, w in wanted.items())
    assert hits / sum(map(len, wanted.values())) >= 0.9
    x = dict(rows)
    for q, near in found.items():
        a = np.array(x[q], np.float64)
        for v, s in near:
            b = np.array(x[v], np.float64)
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_copies_ties_and_bad_vectors(spark, monkeypatch):
    """A third of the rows share one vector; blocks of a few rows; vectors that take no part."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    prepared(spark)
    rng = np.random.default_rng(8)
    rows = [(i, [1.0, 2.0, 0.0, -1.0, 0.5]) for i in range(0, 300, 3)]
    rows += [(i, rng.standard_normal(5).tolist()) for i in range(300) if i % 3]
    rows += [(1000, [1e-200, 2e-200, 0.0, -1e-200, 5e-201]), (1001, [1e200, 2e200, 0.0, -1e200, 5e199])]
    bad = [(2000, None), (2010, []), (2020, [0.0] * 5), (2030, [1.0, None, 0.0, 0.0, 0.0]), (2040, [float("nan")] * 5), (2050, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 5)]
    data = spark.createDataFrame([(*r, 0, 0) for r in rows + bad + rows[:5]], "vec_id long, embedding array<double>, rank int, query_id int").repartition(4)
    found = found_of(neighbours.nearest(data, F.col("vec_id") % 10 == 0))
    # Plain products over- and underflow for the two scaled copies, so they are compared as the copy they are.
    flat = [(i, v if i < 1000 else rows[0][1]) for i, v in rows]
    wanted = brute(flat, lambda ids: ids % 10 == 0)
    assert found.keys() == wanted.keys()
    for q, w in wanted.items():
        assert np.allclose([s for _, s in found[q]], [s for _, s in w], atol=1e-9) or q % 3
        if q % 3 == 0 and q < 1000:
            assert [v for v, _ in found[q]] == [v for v, _ in w]


def test_few_rows(spark):
    prepared(spark)
    data = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [1.0, 1.0]), (100, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>")
    found = found_of(neighbours.nearest(data, F.col("vec_id") % 50 == 0))
    assert {q: [v for v, _ in n] for q, n in found.items()} == {0: [7, 50], 50: [7, 0]}
    assert neighbours.nearest(data.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_cells_of_several_parts():
    x = np.random.default_rng(1).standard_normal((40, 16))
    one, many = neighbours.cells(x, 0, 2, 1), neighbours.cells(x, 0, 2, 12)
    assert (one[:, 0] == many[:, 0]).all() and all(len(set(r)) == 12 for r in many)
    y = neighbours.rotated(x, 3, 1)
    assert np.allclose(y @ y.T, x @ x.T)


def test_recall_with_several_hashes_a_key(spark, folder, monkeypatch):
    """As many cells as two full hashes a key give; the share of neighbours met must not fall."""
    data = table(spark, folder.replace("sf0.01", "sf0.1"), "embeddings")
    rows = [(r.vec_id, r.embedding) for r in data.collect()]
    monkeypatch.setattr(neighbours, "CELL_ROWS", len(rows) / 128**2)
    found = found_of(neighbours.nearest(data, F.col("vec_id") % 10 == 0))
    wanted = brute(rows, lambda ids: ids % 10 == 0)
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in w}) for q, w in wanted.items())
    recall = hits / sum(map(len, wanted.values()))
    print("recall", recall, "of", sum(map(len, wanted.values())))
    assert recall >= 0.9


def test_layout_grows_without_a_jump():
    """Twice the rows are at most twice the cells, at every size."""
    for axes in (2, 16, 128):
        count = lambda n: axes if (at := neighbours.layout(n, axes))[0] == 1 else axes ** (at[0] - 1) * at[1]  # noqa: B023, E731
        sizes = [1000 * 2**i for i in range(20)]
        assert all(count(n) <= count(2 * n) <= 2 * count(n) for n in sizes)
        assert all(count(n) <= max(axes, n / neighbours.CELL_ROWS) for n in sizes)


def test_probes_until_a_row_is_met():
    rng = np.random.default_rng(2)
    q = rng.standard_normal((30, 16))
    x = q + rng.standard_normal((30, 16))
    for parts, last in ((1, 32), (2, 8), (3, 2)):
        needed, own = neighbours.probes_to(q, x, 1, parts, last), neighbours.cells(x, 1, parts, 1, last)
        order = neighbours.cells(q, 1, parts, 32**parts, last)
        assert (needed == [list(o).index(c) + 1 for o, c in zip(order, own[:, 0])]).all()
