"""Trees and forests over blocks: every row scored by trees that were grown without its block.

All trees of all left-out blocks grow together. A row enters each of them with a weight: 1 for single
trees, a Poisson count seeded by row and tree for the bags of a forest, 0 where its block is left out. Trees
see bin numbers only, so equal rows of bins are one cell: per cell, block and tree the weights of rows and of
positives are summed once, in ranges of the bins, and a tree without a block is grown from all cells less that
block's sums. The scores of a cell are summed over the trees and joined back to its rows.

Cells travel packed, many in one value, and no row is repeated for a tree. One task grows a tree whose cells
are at most ``LOCAL_ROWS``. Beyond that, growth is level by level from grouped counts over all cells until
a node has at most as many; the rest of its subtree is grown by one task, by the same rules. Where the border
lies changes no result. No tree is collected, broadcast or applied afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskrules.functions.measures import fill_gaps
from riskrules.operators.binning import edge_counts, quantile_edges
from riskrules.operators.trees import CRITERIA
from riskrules.session import cut, small

LOCAL_ROWS = 1 << 20  # cells of a node that one task grows by itself
SCORED_ROWS = 10_000  # cells that travel together
RANGE_ROWS = 200_000  # rows whose weights one task sums
UNIT = 10**12  # scores are summed as whole numbers of this share, so that their order does not matter
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # splitmix64

_STATE = "unit int, tree int, g int, node long, b binary, n long, p long, snap array<long>"
_DONE = "block_at int, b binary, g int, snap array<long>"


@dataclass(frozen=True)
class Growth:
    """Trees of one criterion and leaf size, read at several depths: a shallower tree is the beginning of a deeper one."""

    criterion: str
    leaf_size: int
    depths: tuple[int, ...]

    @property
    def names(self) -> list[str]:
        return [f"{self.criterion} - {d} - {self.leaf_size}" for d in self.depths]


def binned(df: DataFrame, features: Sequence[str], row_id: str, label: str, block: str, bins: int, draw: Column | None = None) -> DataFrame:
    """A written table (row_id, draw, block, label, b): one byte per feature, the number of quantile edges below
    its value. Unknown values count as 0. Rows are told apart by ``row_id``; bags are drawn by ``draw`` (the
    row id, if none is given), so a hash of a row's content keeps them the same however rows are numbered."""
    if not 2 <= bins <= 255:
        raise ValueError("a bin number is one byte")
    own = (F.col(row_id) if draw is None else draw).cast("long").alias("draw")
    known = fill_gaps(df.select(F.col(row_id).alias("row_id"), own, F.col(block).cast("int").alias("block"), F.col(label).cast("int").alias("label"), *features), list(features))
    edges = {f: e[:-1] for f, e in quantile_edges(known, list(features), bins).items()}
    numbers = F.concat(*[F.lpad(F.hex(f"{f}_above"), 2, "0") for f in features])
    return cut(edge_counts(known, edges).select("row_id", "draw", "block", "label", F.unhex(numbers).alias("b")))


def poisson(row: Column, tree: Column, seed: int) -> Column:
    """A Poisson count of mean 1 that depends on row, tree and seed only."""
    draw = F.shiftrightunsigned(F.xxhash64(row, tree, F.lit(seed)), 11) / float(1 << 53)
    total, term, counts = 0.0, np.exp(-1.0), []
    for k in range(1, 16):
        total += term
        counts.append((draw >= total).cast("int"))
        term /= k
    return sum(counts[1:], counts[0])


_XX = tuple(np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def bags(row: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """(row, tree): the counts of ``poisson`` for all trees, by the same 64-bit hash (xxHash) of row, tree and seed."""

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ x >> np.uint64(33)) * _XX[1]
        x = (x ^ x >> np.uint64(29)) * _XX[2]
        return x ^ x >> np.uint64(32)

    def with_int(start: np.ndarray, number: int) -> np.ndarray:
        value = np.array([number & 0xFFFFFFFF], np.uint64)
        return mixed(turned((start + _XX[4] + np.uint64(4)) ^ value * _XX[0], 23) * _XX[1] + _XX[2])

    bounds, term = [], np.exp(-1.0)
    for k in range(1, 16):
        bounds.append((bounds[-1] if bounds else 0.0) + term)
        term /= k
    start = turned(row.astype(np.int64).view(np.uint64) * _XX[1], 31) * _XX[0] ^ (_XX[4] + np.uint64(42 + 8))
    start = mixed(turned(start, 27) * _XX[0] + _XX[3])
    out = np.empty((len(row), trees), np.int8)
    for t in range(trees):
        draw = (with_int(with_int(start, t), seed) >> np.uint64(11)) / float(1 << 53)
        out[:, t] = np.searchsorted(bounds, draw, side="right")
    return out


def chosen(tree: np.ndarray, node: np.ndarray, features: int, take: int) -> np.ndarray:
    """Which features a node may split on: ``take`` of them, by a hash of tree, node and feature."""
    with np.errstate(over="ignore"):
        x = tree.astype("u8")[:, None] * np.uint64(_MIX[0]) ^ node.astype("u8")[:, None] * np.uint64(_MIX[1]) ^ np.arange(1, features + 1, dtype="u8") * np.uint64(_MIX[2])
        for shift, factor in ((30, _MIX[1]), (27, _MIX[2])):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return x.argsort(axis=1, kind="stable").argsort(axis=1) < take


def _gain(criterion: str, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Rows times impurity."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if criterion == "gini":
            return np.where(n > 0, 2 * p * (n - p) / n, 0.0)
        return sum(np.where(k > 0, -k * np.log(k / n), 0.0) for k in (p, n - p))


def grown(b: np.ndarray, weight: np.ndarray, positive: np.ndarray, growth: Growth, root: int, tree: int, take: int) -> np.ndarray:
    """Scores at the growth's depths (those from the root's level on) of all cells, in whole ``UNIT`` shares.

    ``root`` is the heap number of the node all cells lie in. Levels are grown whole: per feature one
    histogram over (node, bin), running sums along the filled bins, the best split per node.
    """
    cells, features = b.shape
    bins = int(b.max(initial=0)) + 1
    level, now = root.bit_length() - 1, np.zeros(cells, np.int64)  # a cell's place among the open nodes, -1 beyond a leaf
    heap = np.array([root], np.int64)
    score, out = np.zeros(cells, np.int64), []
    while True:
        open_rows = np.flatnonzero(now >= 0)
        k = len(heap)
        at = now[open_rows]
        n = np.bincount(at, weight[open_rows], k)
        p = np.bincount(at, positive[open_rows], k)
        share = np.rint(np.divide(p, n, out=np.zeros(k), where=n > 0) * UNIT).astype(np.int64)
        score[open_rows] = share[at]
        if level in growth.depths:
            out.append(score.copy())
        if level >= growth.depths[-1]:
            break
        may = (n >= 2 * growth.leaf_size) & (p > 0) & (p < n)
        place = np.cumsum(may) - 1
        now[open_rows] = np.where(may[at], place[at], -1)
        heap, n, p = heap[may], n[may], p[may]
        k = len(heap)
        if not k:
            out += [score] * sum(d > level for d in growth.depths)
            break
        fit = np.flatnonzero((weight > 0) & (now >= 0))
        node, w, hits = now[fit], weight[fit], positive[fit]
        whole, n_before, p_before = _gain(growth.criterion, n, p), np.cumsum(n) - n, np.cumsum(p) - p
        fair = chosen(np.full(k, tree), heap, features, take) if take < features else np.ones((k, features), bool)
        best, f, bound = np.zeros(k), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for i in range(features):
            filled, ln, lp = _histogram(node * bins + b[fit, i], w, hits, k * bins)
            mine = filled // bins
            ln, lp = ln.cumsum() - n_before[mine], lp.cumsum() - p_before[mine]
            some = np.flatnonzero((ln >= growth.leaf_size) & (n[mine] - ln >= growth.leaf_size) & fair[mine, i])
            mine, ln, lp = mine[some], ln[some], lp[some]
            gain = np.round(whole[mine] - _gain(growth.criterion, ln, lp) - _gain(growth.criterion, n[mine] - ln, p[mine] - lp), 9)
            high = best.copy()
            np.maximum.at(high, mine, gain)
            first = np.flatnonzero((gain == high[mine]) & (gain > best[mine]))[::-1]  # ties: the earlier feature, the lower bin
            f[mine[first]], bound[mine[first]] = i, filled[some[first]] % bins
            best = high
        split = best > 0
        at = now.copy()
        inside = np.flatnonzero((at >= 0) & split[at])
        above = b[inside, f[at[inside]]] > bound[at[inside]]
        place = 2 * (np.cumsum(split) - 1)
        now[:] = -1
        now[inside] = place[at[inside]] + above
        heap = np.stack((2 * heap[split], 2 * heap[split] + 1), axis=1).ravel()
        level += 1
        if not len(heap):
            out += [score] * sum(d >= level for d in growth.depths)
            break
    return np.stack(out, axis=1) if out else np.zeros((cells, 0), np.int64)


def _histogram(at: np.ndarray, weight: np.ndarray, positive: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places that occur, their weights, their positives); a table of all places only where that is little."""
    if size <= max(8 * len(at), 1 << 16):
        n = np.bincount(at, weight, size)
        filled = np.flatnonzero(n)
        return filled, n[filled], np.bincount(at, positive, size)[filled]
    filled, at = np.unique(at, return_inverse=True)
    return filled, np.bincount(at, weight, len(filled)), np.bincount(at, positive, len(filled))


def out_of_block(table: DataFrame, growths: Sequence[Growth], trees: int | None = None, take: int | None = None, seed: int = 42, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(model, row_id, block, label, score): every row of ``table`` (as ``binned`` gives it) by every growth and
    depth, from trees grown on the other blocks; rows without a block from trees grown on all blocks.

    With ``trees`` a model is a forest: the mean over as many trees, each on its own Poisson bag, every node
    choosing among ``take`` features. A block without rows elsewhere scores 0. ``row_id`` must be unique. An action.
    """
    growths = list(growths)
    features = len(table.select("b").first()[0]) if table.limit(1).count() else 0
    blocks = [r[0] for r in table.select("block").distinct().orderBy("block").collect()]  # a handful, null first
    if not blocks:
        return table.sparkSession.createDataFrame([], "model string, row_id long, block int, label double, score double")
    take = take or features
    count = trees or 1
    place = F.lit(0)
    for i, block in enumerate(blocks):
        place = F.when(F.col("block").eqNullSafe(F.lit(block).cast("int")), i).otherwise(place)
    placed = table.withColumn("block_at", place)
    cells = table.select("b").distinct().count()
    packed = _packed(placed, [x is not None for x in blocks], cells, features, trees, seed)
    if cells <= local_rows:
        done = _at_once(packed, growths, features, take, count, len(blocks))
    else:
        done = _by_level(packed, growths, features, take, count, local_rows)
        every = max(sum(len(g.depths) for g in growths), 1)
        slots = [F.sum(F.get("snap", i)).alias(f"s{i}") for i in range(every)]
        done = done.groupBy("block_at", "b", "g").agg(*slots).select("block_at", "b", "g", F.array(*[f"s{i}" for i in range(every)]).alias("snap"))
    done = cut(done)
    # Trees that never parted (g = -1) hold the depths of all growths, one after another.
    every = [n for g in growths for n in g.names]
    names = F.get(F.array(F.array(*[F.lit(n) for n in every]), *[F.array(*[F.lit(n) for n in g.names]) for g in growths]), F.col("g") + 1)
    scores = small(done, done.count(), features + len(every))
    long = placed.join(scores, ["block_at", "b"]).select("row_id", "block", "label", F.explode(F.arrays_zip(names.alias("model"), F.col("snap").alias("score"))).alias("x"))
    long = long.filter("x.model IS NOT NULL")
    return long.select("x.model", "row_id", "block", F.col("label").cast("double").alias("label"), (F.col("x.score") / float(UNIT * count)).alias("score"))


def _bytes_of(column: pa.ChunkedArray | pa.Array, features: int) -> np.ndarray:
    """(row, feature): bin numbers of a column of packed rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, features)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin in ordered columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= (c[1:] != c[:-1]).reshape(len(c) - 1, -1).any(axis=1) if len(c) > 1 else False
    return np.flatnonzero(new)


def _packed(placed: DataFrame, known: list[bool], cells: int, features: int, trees: int | None, seed: int) -> DataFrame:
    """(unit, chunk, b, n, p): for the tree of every left-out block (unit = block's place * trees + tree) and
    every chunk of cells, their bins one after another with the weights of rows and of positives outside the
    block. A chunk has the same cells in the same order for all trees."""
    count, chunks = trees or 1, -(-cells // SCORED_ROWS)
    # Ranges of (bins, row), so that a cell of very many rows is summed by several tasks.
    ranges = -(-placed.count() // RANGE_ROWS)
    rows = placed.repartitionByRange(ranges, "b", "row_id").sortWithinPartitions("b", "block_at")

    def sums(batches):
        for batch in batches:
            if not len(batch):
                continue
            b, at = _bytes_of(batch.column("b"), features), batch.column("block_at").to_numpy()
            w = bags(batch.column("draw").to_numpy(), trees, seed) if trees else np.ones((len(b), 1), np.int8)
            label = batch.column("label").fill_null(0).to_numpy().astype(np.int32)
            starts = _starts(b, at)
            n = np.add.reduceat(w, starts, axis=0, dtype=np.int32)
            p = np.add.reduceat(w * label[:, None], starts, axis=0, dtype=np.int32)
            yield pa.record_batch([batch.column("b").take(pa.array(starts)), pa.array(at[starts], pa.int32()), pa.array([x.tobytes() for x in n]), pa.array([x.tobytes() for x in p])], names=["b", "block_at", "n", "p"])

    summed = rows.select("b", "block_at", "label", "draw").mapInArrow(sums, "b binary, block_at int, n binary, p binary")

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        b, at = _bytes_of(group.column("b"), features), group.column("block_at").to_numpy()
        order = np.lexsort((at, *b.T[::-1]))
        b, at = b[order], at[order]
        cell = np.zeros(len(b), np.int64)
        first = _starts(b)
        cell[first[1:]] = 1
        cell = cell.cumsum()
        starts = _starts(cell, at)
        outside = []
        for c in ("n", "p"):
            found = np.frombuffer(b"".join(group.column(c).to_pylist()), np.int32).reshape(-1, count)[order]
            by_block = np.zeros((len(known), len(first), count), np.int64)
            by_block[at[starts], cell[starts]] = np.add.reduceat(found, starts, axis=0, dtype=np.int64)
            whole = by_block[known].sum(axis=0)
            kind = "<i4" if whole.max(initial=0) < 1 << 31 else "<i8"
            outside.append([np.ascontiguousarray((whole - by_block[i] if k else whole).T).astype(kind) for i, k in enumerate(known)])
        units, bins = len(known) * count, b[first].tobytes()
        blobs = [pa.array([row.tobytes() for block in one for row in block], pa.binary()) for one in outside]
        return pa.table([pa.array(np.arange(units), pa.int32()), pa.array([key[0].as_py()] * units, pa.int32()), pa.array([bins] * units, pa.binary()), *blobs], names=["unit", "chunk", "b", "n", "p"])

    chunk = F.pmod(F.xxhash64("b"), F.lit(chunks)).cast("int").alias("chunk")
    return summed.select(chunk, "*").groupBy("chunk").applyInArrow(pack, "unit int, chunk int, b binary, n binary, p binary")


def _unpacked(b: bytes, n: bytes, p: bytes, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b, np.uint8).reshape(-1, features)
    return bins, *(np.frombuffer(x, f"<i{len(x) // len(bins)}").astype(np.float64) for x in (n, p))


def _at_once(packed: DataFrame, growths: list[Growth], features: int, take: int, count: int, blocks: int) -> DataFrame:
    """Scores of all cells, summed over the trees: a task grows each tree whole."""

    def grow(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        unit = key[0].as_py()
        parts = sorted(group.to_pylist(), key=lambda r: r["chunk"])
        cells = [_unpacked(r["b"], r["n"], r["p"], features) for r in parts]
        b, n, p = (np.concatenate(x) for x in zip(*cells))
        found = np.concatenate([grown(b, n, p, g, 1, unit % count, take) for g in growths], axis=1)
        ends = np.cumsum([len(x[0]) for x in cells])
        scores = [x.tobytes() for x in np.split(found, ends[:-1])]
        # One tree of each block tells the cells.
        bins = [None if unit % count else r["b"] for r in parts]
        return pa.table([pa.array([unit // count] * len(parts), pa.int32()), pa.array([r["chunk"] for r in parts], pa.int32()), pa.array(bins, pa.binary()), pa.array(scores, pa.binary())], names=["block_at", "chunk", "b", "scores"])

    units = packed.repartition(min(blocks * count, 1_000), "unit").groupBy("unit").applyInArrow(grow, "block_at int, chunk int, b binary, scores binary")

    def add(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        b = _bytes_of(group.column("b").drop_null(), features)
        total = np.zeros(0, np.int64)
        for scores in group.column("scores"):
            one = np.frombuffer(scores.as_buffer(), np.int64)
            total = total + one if len(total) else one
        size = len(total) // len(b)
        lists = pa.ListArray.from_arrays(np.arange(0, len(total) + 1, size, dtype=np.int32) if size else np.zeros(len(b) + 1, np.int32), pa.array(total))
        bins = pa.array([x.tobytes() for x in b], pa.binary())
        return pa.table([pa.array([key[0].as_py()] * len(b), pa.int32()), bins, pa.array([-1] * len(b), pa.int32()), lists], names=["block_at", "b", "g", "snap"])

    return units.groupBy("block_at", "chunk").applyInArrow(add, _DONE)


def _by_level(packed: DataFrame, growths: list[Growth], features: int, take: int, count: int, local_rows: int) -> DataFrame:
    """Scores of all cells in every tree: nodes of many cells are split by grouped counts, level by level."""

    def unpack(batches):
        for batch in batches:
            for r in batch.to_pylist():
                b, n, p = _unpacked(r["b"], r["n"], r["p"], features)
                yield pa.record_batch([pa.array([r["unit"]] * len(b), pa.int32()), pa.array([x.tobytes() for x in b], pa.binary()), pa.array(n.astype(np.int64)), pa.array(p.astype(np.int64))], names=["unit", "b", "n", "p"])

    rows = packed.mapInArrow(unpack, "unit int, b binary, n long, p long")
    rows = rows.select("unit", F.pmod("unit", F.lit(count)).alias("tree"), F.lit(1).cast("long").alias("node"), "b", "n", "p", F.expr("CAST(array() AS array<long>)").alias("snap"))
    # The growths part ways at the root.
    rows = rows.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(len(growths) - 1))))
    rows = cut(rows.select([c.split()[0] for c in _STATE.split(", ")]))
    finished, waiting = [], []
    for level in range(max(g.depths[-1] for g in growths) + 1):
        large = cut(_large(rows, local_rows))
        if not large.limit(1).count():
            break
        inside, others, ended = _one_level(rows, large, growths, level, features, take)
        waiting.append(others)
        finished.append(ended)
        rows = inside
    else:
        rows = rows.limit(0)
    local = reduce(DataFrame.unionByName, [*waiting, rows])
    done = reduce(DataFrame.unionByName, [*finished, _locally(local, growths, take, features)])
    return done.select(F.floor(F.col("unit") / count).cast("int").alias("block_at"), "b", "g", "snap")


_AT = ["unit", "g", "node"]


def _large(rows: DataFrame, local_rows: int) -> DataFrame:
    """Nodes with more cells than one task takes: (unit, g, node, n, p)."""
    sums = rows.groupBy(*_AT).agg(F.count("*").alias("cells"), F.sum("n").alias("n"), F.sum("p").alias("p"))
    return sums.filter(F.col("cells") > local_rows).drop("cells")


def _one_level(rows: DataFrame, large: DataFrame, growths: list[Growth], level: int, features: int, take: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells of split nodes in their children, cells of small nodes, scores of large nodes that end)."""
    nodes = large.count()
    pick = lambda values, kind: F.get(F.array(*[F.lit(v) for v in values]), F.col("g")).cast(kind)
    leaf, deepest = pick([g.leaf_size for g in growths], "long"), pick([g.depths[-1] for g in growths], "int")
    counted = rows.filter("n > 0").join(small(large.select(*_AT), nodes, 3), _AT, "left_semi")
    byte = [F.conv(F.hex(F.substring("b", i + 1, 1)), 16, 10).cast("int") for i in range(features)]
    cells = counted.select(*_AT, "tree", "n", "p", F.posexplode(F.array(*byte)).alias("f", "bucket"))
    cells = cells.groupBy(*_AT, "tree", "f", "bucket").agg(F.sum("n").alias("cn"), F.sum("p").alias("cp"))
    upto = Window.partitionBy(*_AT, "f").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    options = cells.select(*_AT, "tree", "f", "bucket", F.sum("cn").over(upto).alias("ln"), F.sum("cp").over(upto).alias("lp")).join(small(large, nodes, 5), _AT)

    @pandas_udf("boolean")
    def allowed(tree, node, f):
        import pandas as pd

        mask = chosen(tree.to_numpy(), node.to_numpy(), features, take)
        return pd.Series(mask[np.arange(len(mask)), f.to_numpy()])

    if take < features:
        options = options.filter(allowed("tree", "node", "f"))
    ln, lp, n, p = (F.col(c) for c in ("ln", "lp", "n", "p"))
    options = options.filter((ln >= leaf) & (n - ln >= leaf) & (F.lit(level) < deepest))
    rated = None
    for i, g in enumerate(growths):
        impurity = CRITERIA[g.criterion]
        gain = F.round(impurity(n, p) - impurity(ln, lp) - impurity(n - ln, p - lp), 9)
        rated = gain if rated is None else F.when(F.col("g") == i, gain).otherwise(rated)
    options = options.withColumn("gain", rated).filter("gain > 0")
    best = F.max_by(F.struct("f", "bucket"), F.struct(F.col("gain"), -F.col("f"), -F.col("bucket")))
    splits = options.groupBy(*_AT).agg(best.alias("s"))
    decided = cut(large.join(splits, _AT, "left").select(*_AT, "n", "p", "s.f", "s.bucket"))  # one row per large node

    snapped = F.array_contains(pick_list([list(g.depths) for g in growths]), level)
    share = F.rint(F.coalesce(F.try_divide(F.col("np").cast("double"), "nn"), F.lit(0.0)) * UNIT).cast("long")
    decided = decided.withColumnsRenamed({"n": "nn", "p": "np"})
    met = rows.join(small(decided, nodes, 7), _AT)
    met = met.withColumn("snap", F.when(snapped, F.concat("snap", F.array(share))).otherwise(F.col("snap")))
    value = F.conv(F.hex(F.expr("substring(b, f + 1, 1)")), 16, 10).cast("int")
    inside = met.filter("f IS NOT NULL").withColumn("node", F.col("node") * 2 + (value > F.col("bucket")).cast("int")).drop("nn", "np", "f", "bucket")
    depths = F.size(pick_list([list(g.depths) for g in growths]))
    ended = met.filter("f IS NULL").withColumn("snap", F.concat("snap", F.array_repeat(share, depths - F.size("snap"))))
    others = rows.join(small(large.select(*_AT), nodes, 3), _AT, "left_anti")
    names = [c.split()[0] for c in _STATE.split(", ")]
    return cut(inside.select(names)), others.select(names), ended.select("unit", "b", "g", "snap")


def pick_list(lists: list[list[int]]) -> Column:
    return F.get(F.array(*[F.array(*[F.lit(x) for x in one]) for one in lists]), F.col("g"))


def _locally(rows: DataFrame, growths: list[Growth], take: int, features: int) -> DataFrame:
    """Scores of cells whose subtree one task grows."""

    def grow(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        unit, which, root = (k.as_py() for k in key)
        weight, positive = (group.column(c).to_numpy().astype(np.float64) for c in ("n", "p"))
        found = grown(_bytes_of(group.column("b"), features), weight, positive, growths[which], root, group.column("tree")[0].as_py(), take)
        # Depths above the node were read on the way to it.
        found = np.concatenate((np.array(group.column("snap").to_pylist(), np.int64).reshape(len(group), -1), found), axis=1)
        lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32), pa.array(found.ravel()))
        return pa.table([pa.array([unit] * len(group), pa.int32()), group.column("b"), pa.array([which] * len(group), pa.int32()), lists], names=["unit", "b", "g", "snap"])

    needed = rows.select(*_AT, "tree", "b", "n", "p", "snap")
    return needed.groupBy(*_AT).applyInArrow(grow, "unit int, b binary, g int, snap array<long>")
