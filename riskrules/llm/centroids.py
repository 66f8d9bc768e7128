"""Centroid clustering on integer vectors, with Ptolemy's inequality in front of exact distances.

A few of the first centroids are fixed pivots. The distances of every vector to them are computed once
and kept beside it. For a centroid c and a pair of pivots s, t Ptolemy's inequality gives

    d(v, c) * d(s, t) >= |d(v, s) * d(c, t) - d(v, t) * d(c, s)|

so each pair bounds d(v, c) from below by cached numbers alone. The centroid of the least bound is measured
first; only centroids whose bound, lowered for rounding, does not lie above that distance are measured too.
All measured distances, sums and means are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.session import cut

WIDTH, SCALE = 64, 256
CENTROIDS, ROUNDS, SEED = 40, 5, 2
PIVOTS = 12
LOWERED = 1e-9  # relative to the bound and to the products it is made of
LIMIT = 1 << 62  # larger components count as this
SAFE = 1 << 26  # up to this size of components all distances and the sums of a block fit 64 bits
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, measured int"
MOST = (1 << 63) - 1  # a larger distance or sum of distances is given as this
ROWS = 2_048  # vectors whose bounds are in memory at once


def whole_numbers(vectors: DataFrame, key: str, vector: str, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors with exactly ``width`` finite components, as floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    fit = (F.size(x) == width) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter(F.coalesce(fit, F.lit(False)))
    near = F.transform(x, lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))), F.lit(LIMIT)), F.lit(-LIMIT)))
    return kept.select(F.col(key).cast("long").alias("vec_id"), near.cast("array<long>").alias("v"))


def first_centroids(numbers: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors of smallest SHA-256 of ``seed:vec_id`` (a null id as empty text), at most ``count`` rows;
    rows of one id follow one another by components."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = numbers.select(named.alias("h"), "v").orderBy("h", "v").limit(count).collect()
    return np.array([r.v for r in chosen], np.int64)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact: as Python's integers where 64 bits might not hold them."""
    if not len(a):
        return np.zeros(0, np.int64)
    if max(abs(int(x)) for m in (a, b) for x in (m.max(), m.min())) <= SAFE:
        d = a - b
        return np.einsum("ij,ij->i", d, d)
    d = a.astype(object) - b.astype(object)
    return (d * d).sum(axis=1)


def _roots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all of ``b``, rounded."""
    return np.stack([np.sqrt(_exact(a, np.broadcast_to(r, a.shape)).astype(np.float64)) for r in b], axis=1) if len(b) else np.zeros((len(a), 0))


def pivots(centroids: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Different centroids far from each other: the first, then always the one farthest from those chosen."""
    chosen, away = [0], _roots(centroids, centroids[:1])[:, 0]
    while len(chosen) < min(count, len(centroids)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _roots(centroids, centroids[chosen[-1:]])[:, 0])
    return centroids[chosen]


class Bounds:
    """Lower bounds of the distances to all centroids, from distances to pivots."""

    def __init__(self, centroids: np.ndarray, fixed: np.ndarray):
        self.centroids = centroids
        self.s, self.t = np.triu_indices(len(fixed), 1)
        apart = _roots(fixed, fixed)[self.s, self.t]
        own = _roots(centroids, fixed)
        self.to_s, self.to_t = (own[:, x].T / apart[:, None] for x in (self.s, self.t))  # pairs x centroids

    def of(self, cached: np.ndarray) -> np.ndarray:
        """One row per vector; never above the distance, whatever the rounding."""
        best = np.zeros((len(cached), len(self.centroids)))
        for i, (s, t) in enumerate(zip(self.s, self.t)):
            a, b = np.outer(cached[:, s], self.to_t[i]), np.outer(cached[:, t], self.to_s[i])
            np.maximum(best, np.abs(a - b) * (1 - LOWERED) - (a + b) * LOWERED, out=best)
        return best

    def nearest(self, vectors: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, squared distance, centroids measured) of the nearest centroid, ties to the smaller number."""
        bound = self.of(cached)
        guess = bound.argmin(axis=1)
        reach = np.sqrt(_exact(vectors, self.centroids[guess]).astype(np.float64)) * (1 + LOWERED)
        rows, numbers = np.nonzero(bound <= reach[:, None])  # a row's numbers ascend; the guess is among them
        measured = _exact(vectors[rows], self.centroids[numbers])
        begin = np.searchsorted(rows, np.arange(len(vectors)))
        least = np.minimum.reduceat(measured, begin)
        hits = np.flatnonzero(measured == least[rows])
        first = hits[np.searchsorted(rows[hits], np.arange(len(vectors)))]
        return numbers[first], least, np.diff(np.append(begin, len(rows)))


def _blocks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    """Blocks of at most ROWS rows; list columns as matrices."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            b = batch.slice(at, ROWS)
            yield (b.column(0), *(np.asarray(b.column(i).flatten()).reshape(len(b), -1) for i in range(1, columns)))


def _assigned(table: DataFrame, centroids: np.ndarray, fixed: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, measured) of every vector."""

    def run(batches):
        bounds = Bounds(centroids, fixed)
        for ids, v, cached in _blocks(batches, 3):
            number, square, measured = bounds.nearest(v, cached)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number, pa.int32()), pa.array([min(int(x), MOST) for x in square], pa.int64()), pa.array(measured, pa.int32())],
                names=["vec_id", "cluster", "distance", "measured"],
            )

    return table.select("vec_id", "v", "cached").mapInArrow(run, "vec_id long, cluster int, distance long, measured int")


def _moved(table: DataFrame, centroids: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """The centroids after one round. A task gives a count and a sum per centroid and component; the driver
    gets as many rows as there are centroid components."""

    def run(batches):
        bounds = Bounds(centroids, fixed)
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, object)
        for _, v, cached in _blocks(batches, 3):
            number, _, _ = bounds.nearest(v, cached)
            wide = v if max(abs(int(v.max())), abs(int(v.min()))) <= SAFE else v.astype(object)
            for c in np.unique(number):
                own = wide[number == c]
                count[c] += len(own)
                total[c] += own.sum(axis=0)
        met = np.flatnonzero(count)
        width = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(met, width), pa.int32()),
                pa.array(np.tile(np.arange(width), len(met)), pa.int32()),
                pa.array(np.repeat(count[met], width), pa.int64()),
                pa.array([Decimal(int(x)) for x in total[met].ravel()], pa.decimal128(38, 0)),
            ],
            names=["cluster", "place", "n", "total"],
        )

    sums = table.select("vec_id", "v", "cached").mapInArrow(run, "cluster int, place int, n long, total decimal(38,0)")
    out = centroids.copy()
    for r in sums.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.cluster, r.place] = int(r.total) // r.n
    return out


def clustered(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, measured) of every vector that takes part.

    Vectors that are null, of another width or hold null or non-finite components take no part; without
    any there are no rows. Repeated ids and vectors are vectors of their own, also as first centroids; with
    fewer vectors than ``count`` each is one. ``distance`` is squared, ``measured`` the number of
    centroids measured exactly. Scaled components beyond 2^62 count as 2^62, distances and sums beyond 63
    bits are given as the largest long. The driver holds the centroids; vectors are written once with their
    pivot distances and read once per round, never shuffled.
    """
    numbers = whole_numbers(vectors, key, vector, width, scale)
    centroids = first_centroids(numbers, count, seed)
    if not len(centroids):
        return numbers.sparkSession.createDataFrame([], RESULT)
    fixed = pivots(centroids)

    def measure(batches):
        for ids, v in _blocks(batches, 2):
            cached = _roots(v, fixed)
            lists = [pa.ListArray.from_arrays(np.arange(0, m.size + 1, max(m.shape[1], 1), dtype=np.int32), pa.array(m.ravel())) for m in (v, cached)]
            yield pa.RecordBatch.from_arrays([ids, *lists], names=["vec_id", "v", "cached"])

    table = cut(numbers.mapInArrow(measure, "vec_id long, v array<long>, cached array<double>"))
    for _ in range(rounds):
        centroids = _moved(table, centroids, fixed)
    found = cut(_assigned(table, centroids, fixed))
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # a row per centroid
    named = [(c, min(t, MOST), min(sum(sums.values()), MOST), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, t in sums.items()]
    rest = found.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(rest), "cluster").select(*[f.split()[0] for f in RESULT.split(", ")])


def oracle(count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The query's columns in SQL over ``embeddings``."""
    square = "list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT n, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT q.n, c.k, CAST({square} AS HUGEINT) AS d FROM q, c{i} c) GROUP BY n)"
        )
        if i < rounds:
            steps.append(
                f"s{i} AS (SELECT a.k, x.p, sum(CAST(x.x AS HUGEINT)) AS s, count(*) AS m FROM a{i} a JOIN x ON x.n = a.n GROUP BY 1, 2), "
                f"m{i} AS (SELECT k, list(CAST(CASE WHEN s % m < 0 THEN s // m - 1 ELSE s // m END AS BIGINT) ORDER BY p) AS v FROM s{i} GROUP BY k), "
                f"c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON c.k = m.k)"
            )
    return f"""
WITH q AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
x AS MATERIALIZED (SELECT n, unnest(v) AS x, unnest(range(1, {WIDTH + 1})) AS p FROM q),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM q ORDER BY h, v LIMIT {count})),
{", ".join(steps)},
i AS (SELECT k, sum(d) AS t FROM a{rounds} GROUP BY k)
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(i.t AS BIGINT) AS cluster_inertia, CAST((SELECT sum(t) FROM i) AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN q USING (n) JOIN i USING (k) JOIN c{rounds} c USING (k)"""
