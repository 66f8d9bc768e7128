"""Nearest neighbours by cosine: cross-polytope hashing, multiprobe tables and exact reranking.

In each table a vector goes through pseudo-rotations, three rounds of random signs and a fast Hadamard
transform, and is hashed to the nearest signed axis. With many rows a table key joins several such
hashes, the last over as many axes as leave ``CELL_ROWS`` to twice as many rows in a cell. A query also
looks into the cells of its next nearest axes. How many is measured: the nearest rows of some queries
are found by comparison with all rows, and the cells probed are as many as meet ``RECALL`` of them, at
least ``PROBES``. Rows and queries of a cell meet in blocks of bounded size, where exact cosines are
computed and only each query's best are given out.

Equal vectors are one row with the smallest ids, as many as a result can need. A query that found too
few rows is compared with all, in the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskrules.session import cut

TABLES = 10
PROBES = 16
CELL_ROWS = 512
RECALL = 0.98  # share of the measured queries' nearest rows that the probed cells must hold
MEASURED = 128  # queries compared with all rows to learn how many cells to probe
HASHED = 1 << 20  # values that one step of probing holds
BLOCK_ROWS = 8_192
SEED = 17


@lru_cache(maxsize=64)
def _signs(width: int, table: int, part: int) -> np.ndarray:
    return np.random.default_rng([SEED, width, table, part]).choice([-1.0, 1.0], (3, width))


def rotated(x: np.ndarray, table: int, part: int) -> np.ndarray:
    """Rows of unit vectors after three rounds of signs and Hadamard transform (width a power of two)."""
    n, d = x.shape
    width = 1 << max(0, d - 1).bit_length()
    y = np.zeros((n, width))
    y[:, :d] = x
    for signs in _signs(width, table, part):
        y *= signs
        h = 1
        while h < width:
            y = y.reshape(n, width // (2 * h), 2, h)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2)
            h *= 2
        y = y.reshape(n, width) / np.sqrt(width)
    return y


def layout(n: int, axes: int) -> tuple[int, int]:
    """(hashes per table key, axes of the last one) for n rows; cells double when rows do."""
    parts, last, rest = 1, axes, n / CELL_ROWS / axes
    while axes > 1 and rest >= 2:
        parts, last, rest = parts + 1, min(axes, 1 << int(np.log2(rest))), rest / axes
    return parts, last


def _axes(x: np.ndarray, table: int, part: int, parts: int, last: int | None) -> np.ndarray:
    """Projections on the signed axes of one hash; the last of several may use fewer axes."""
    y = rotated(x, table, part)
    if last and parts > 1 and part == parts - 1:
        y = y[:, : max(1, last // 2)]
    return np.concatenate([y, -y], axis=1)


def cells(x: np.ndarray, table: int, parts: int, probes: int, last: int | None = None) -> np.ndarray:
    """(rows, at most probes) keys of the nearest cells; a cell is one signed axis per part.

    Cells are ordered by how much shorter the projections on their axes are than on the nearest ones.
    """
    keys = loss = None
    for part in range(parts):
        both = _axes(x, table, part, parts, last)
        top = np.argsort(-both, axis=1, kind="stable")[:, :probes]
        value = np.take_along_axis(both, top, axis=1)
        more = (value[:, :1] - value) ** 2
        if keys is None:
            keys, loss = top, more
            continue
        # The nearest cells extend the nearest of the parts so far, so these suffice.
        total = (loss[:, :, None] + more[:, None]).reshape(len(x), -1)
        joined = (keys[:, :, None] * both.shape[1] + top[:, None]).reshape(len(x), -1)
        order = np.argsort(total, axis=1, kind="stable")[:, :probes]
        keys, loss = np.take_along_axis(joined, order, axis=1), np.take_along_axis(total, order, axis=1)
    return keys


def probes_to(q: np.ndarray, x: np.ndarray, table: int, parts: int, last: int | None = None) -> np.ndarray:
    """For every pair of rows of q and x the cells that q probes until it meets x."""
    line, lost = [], np.zeros(len(q))
    for part in range(parts):
        both = _axes(q, table, part, parts, last)
        more = (both.max(axis=1, keepdims=True) - both) ** 2
        at = _axes(x, table, part, parts, last).argmax(axis=1)
        lost += more[np.arange(len(q)), at]
        line.append(np.sort(more, axis=1))
    out = np.empty(len(q), np.int64)
    for r in range(len(q)):
        sums = np.zeros(1)
        for more in line[:-1]:
            sums = (sums[:, None] + more[r]).ravel()
        sums.sort()
        out[r] = np.searchsorted(sums, lost[r] + 1e-12 - line[-1][r], side="right").sum()
    return out


def _unit(column) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in column])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(vectors: DataFrame, parts: int, probes: int, last: int) -> DataFrame:
    """One row per vector, table and probe: (row, width, table, cell)."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, same in frame.groupby("width"):
                x, ids = _unit(same.vector), same.row.to_numpy()
                axes = 2 << max(0, width - 1).bit_length()
                step = max(1, HASHED // (min(probes, axes ** max(1, parts - 1)) * min(probes, axes)))
                for table in range(TABLES):
                    for i in range(0, len(x), step):
                        keys = cells(x[i : i + step], table, parts, probes, last)
                        rows = pd.DataFrame({"row": np.repeat(ids[i : i + step], keys.shape[1]), "width": width, "table": table, "cell": keys.ravel()})
                        yield rows.drop_duplicates()

    return vectors.select("row", "width", "vector").mapInPandas(work, "row long, width int, table int, cell long")


def _cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact cosines of one vector with rows; the same for a pair in whatever block it is computed."""
    q, x = q / np.abs(q).max(), x / np.abs(x).max(axis=1, keepdims=True)
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


def _best(keep: int):
    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The ``keep`` nearest ids of each query of a block; left are queries, right are rows."""
        out: list[tuple[int, int, float]] = []
        if len(left) and len(right):
            x = np.stack([np.asarray(v, np.float64) for v in right.vector])
            unit, ids = _unit(right.vector), right.ids.to_numpy()
            queries, rows = _unit(left.vector), left.row.to_numpy()
            for i in range(0, len(rows), 256):
                near = queries[i : i + 256] @ unit.T
                floor = np.sort(near, axis=1)[:, -min(keep, near.shape[1])] - 1e-9
                for row, v, line, least in zip(rows[i : i + 256], left.vector.to_numpy()[i : i + 256], near, floor):
                    at = np.flatnonzero(line >= least)
                    scores = _cosines(np.asarray(v, np.float64), x[at])
                    pairs = sorted((-s, int(k)) for s, a in zip(scores, at) for k in ids[a])[:keep]
                    out += [(int(row), k, -s) for s, k in pairs]
        return pd.DataFrame(out, columns=["query", "vec_id", "score"]).astype({"query": "int64", "vec_id": "int64", "score": "float64"})

    return work


def _meet(queries: DataFrame, rows: DataFrame, keep: int) -> DataFrame:
    """(query, vec_id, score): both sides have (row, width, table, cell), rows also ids, both vector.

    Either side of a cell is dealt to blocks of bounded size and every pair of blocks is one group.
    """
    cell = ["width", "table", "cell"]
    blocks = lambda df, n: df.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(n))
    grid = blocks(queries, "nq").join(blocks(rows, "nr"), cell)
    deal = lambda df, own, other: df.join(grid, cell).withColumn(own[1], F.pmod(F.xxhash64("row"), F.col(own[0])).cast("int")).withColumn(
        other[1], F.explode(F.sequence(F.lit(0), F.col(other[0]) - 1))
    )
    q, r = ("nq", "bq"), ("nr", "br")
    key = cell + ["bq", "br"]
    left = deal(queries, q, r).select(*key, "row", "vector").groupBy(*key)
    right = deal(rows, r, q).select(*key, "ids", "vector").groupBy(*key)
    return left.cogroup(right).applyInPandas(_best(keep), "query long, vec_id long, score double")


def _first(df: DataFrame, group: str, n: int) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _probes(points: DataFrame, rows: DataFrame, parts: int, last: int, count: int) -> int:
    """Cells to probe in every table, so that ``RECALL`` of the nearest rows of some queries are met.

    The queries, a bounded number chosen by hash, are compared with all rows; a task keeps their nearest
    and gives them out once. Their cells are then looked up in the order of probing.
    """
    some = points.orderBy(F.xxhash64("row"), "row").limit(MEASURED).toPandas()
    own = {w: (same.row.to_numpy(), _unit(same.vector)) for w, same in some.groupby("width")}

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list[tuple[float, int, list[float]]]] = {}
        for frame in frames:
            for width, same in frame.groupby("width"):
                if width not in own:
                    continue
                ids, vectors = same.row.to_numpy(), same.vector.to_numpy()
                for query, line in zip(own[width][0], own[width][1] @ _unit(same.vector).T):
                    line[ids == query] = -np.inf
                    at = np.argsort(-line, kind="stable")[:count]
                    mine = best.get(int(query), []) + [(float(line[j]), int(ids[j]), vectors[j]) for j in at if line[j] > -np.inf]
                    best[int(query)] = sorted(mine, key=lambda m: (-m[0], m[1]))[:count]
        found = [(q, i, s, v) for q, mine in best.items() for s, i, v in mine]
        yield pd.DataFrame(found, columns=["query", "vec_id", "score", "vector"]).astype({"query": "int64", "vec_id": "int64", "score": "float64"})

    near = rows.select("row", "width", "vector").mapInPandas(work, "query long, vec_id long, score double, vector array<double>")
    near = _first(near, "query", count).toPandas()  # count rows for each of the queries
    needed = []
    for ids, x in own.values():
        place = {int(q): n for n, q in enumerate(ids)}
        same = near[near["query"].isin(place.keys())]
        if len(same):
            q, y = x[[place[i] for i in same["query"]]], _unit(same.vector)
            needed.append(np.min([probes_to(q, y, t, parts, last) for t in range(TABLES)], axis=0))
    if not needed:
        return PROBES
    needed = np.sort(np.concatenate(needed))
    return max(PROBES, int(needed[int(np.ceil(RECALL * len(needed))) - 1]))


def nearest(vectors: DataFrame, queries, key: str = "vec_id", vector: str = "embedding", count: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``count`` rows of largest cosine found for each query row.

    ``queries`` is a condition on the column ``vec_id``; a query's own id is left out, ties go to the
    smaller id. Rows with a null id, and vectors that are null, empty, zero or hold a null or non-finite
    component, take no part. Vectors are compared with those of their own length. Repeated rows of one
    id and vector count once.
    """
    keep = count + 1
    data = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    data = data.filter("vec_id IS NOT NULL AND vector IS NOT NULL").filter(F.forall("vector", fine) & F.exists("vector", lambda x: x != 0))
    data = data.distinct()
    asked = cut(data.filter(queries).select(F.col("vec_id").alias("query_id"), "vector"))
    # The limit per vector is applied before the shuffle as well, so a vector of many rows is no hot key.
    few = data.withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).filter(F.col("n") <= keep)
    distinct = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = cut(distinct.select(F.col("ids")[0].alias("row"), "ids", F.size("vector").alias("width"), "vector"))
    wanted = asked.select("vector").distinct()
    points = cut(distinct.join(wanted, "vector", "left_semi").select("row", "width", "vector"))
    n, width = distinct.agg(F.count("*"), F.max("width")).first()
    axes = 2 << max(0, (width or 1) - 1).bit_length()
    parts, last = layout(n, axes)
    probes = _probes(points, distinct, parts, last, count)
    own = distinct.select("row", "ids", "vector")
    rows = cut(_hashed(distinct, parts, 1, last)).join(own, "row")
    looked = cut(_hashed(points, parts, probes, last)).join(points.select("row", "vector"), "row")
    found = cut(_meet(looked, rows, keep)).distinct()
    enough = found.groupBy("query").count().filter(F.col("count") >= keep).select(F.col("query").alias("row"))
    short = cut(points.join(enough, "row", "left_anti"))
    if short.limit(1).count():
        one = lambda df: df.withColumn("table", F.lit(0)).withColumn("cell", F.lit(0).cast("long"))
        found = found.join(short.select(F.col("row").alias("query")), "query", "left_anti").union(_meet(one(short), one(distinct), keep))
    best = cut(_first(found.distinct(), "query", keep).select(F.col("query").alias("row"), "vec_id", "score"))
    of = asked.join(points.select("row", "vector"), "vector").select("query_id", "row")
    out = _first(of.join(best, "row").filter("vec_id != query_id"), "query_id", count)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
