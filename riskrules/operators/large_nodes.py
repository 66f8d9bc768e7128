"""Rows of tree nodes in blocks, and the quantile edges of nodes that are too large for one task.

Passing rows one by one to the workers costs more than counting them, so the rows of all segments are laid
in blocks once. A level of the trees then takes two passes over the blocks. The first counts, per node and
feature, rows and positives below and up to some thousand cuts from a sample. These counts tell between
which cuts a wanted rank lies, if it does not lie on one; the second pass gathers the values between those
cuts only, in parts of bounded size, and ranks them. Edges and the counts at them are exact: the sample
decides how many values are gathered and nothing else.

The driver holds the nodes, their cuts and the counts at them, for a bounded number of nodes at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

BLOCK_ROWS = 65_536  # rows that travel together
FILE_BLOCKS = 8  # blocks of a file, which a reader may take into memory at once
CHUNK_ROWS = 1_000_000  # rows that a worker sorts by node at once
SAMPLE_ROWS = 1_000_000  # rows of the sample, over all large segments
CUTS = 1_024  # cuts per node and feature
PART_ROWS = 2_000_000  # values that one task ranks, beyond those between two neighbouring cuts
STATE_NUMBERS = 4_000_000  # counts that a worker holds in a pass
BATCH_BYTES = 8 << 20  # of blocks that pass to a worker at once, outside the executor's heap

_BLOCK = "s binary, c binary, y binary, x binary, ss binary, sx binary"
BY_NODE = "node int, y binary, x binary"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The jobs within pass blocks to the workers in batches of ``BATCH_BYTES``."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@dataclass
class Nodes:
    """Nodes of all trees by number: the roots are the segments, two children lie side by side. Node ids
    are 1 for a root and 2i, 2i + 1 for the children of i."""

    segment: list[int] = field(default_factory=list)
    node_id: list[int] = field(default_factory=list)
    path: list[tuple] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    p: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    limit: list[float] = field(default_factory=list)
    child: list[int] = field(default_factory=list)

    def add(self, segment: int, node_id: int, path: tuple, n: int, p: int) -> int:
        for name, value in zip(("segment", "node_id", "path", "n", "p", "feature", "limit", "child"), (segment, node_id, path, n, p, -1, 0.0, -1)):
            getattr(self, name).append(value)
        return len(self.n) - 1

    def split(self, i: int, f: int, name: str, limit: float, ln: int, lp: int) -> tuple[int, int]:
        self.feature[i], self.limit[i], self.child[i] = f, limit, len(self.n)
        low = self.add(self.segment[i], 2 * self.node_id[i], (*self.path[i], (name, "<=", limit)), ln, lp)
        return low, self.add(self.segment[i], 2 * self.node_id[i] + 1, (*self.path[i], (name, ">", limit)), self.n[i] - ln, self.p[i] - lp)

    def ways(self, wanted: Iterable[int]) -> _Ways:
        ends = np.zeros(len(self.n), bool)
        ends[list(wanted)] = True
        live = ends.copy()
        for i in range(len(live) - 1, -1, -1):
            if self.child[i] >= 0:
                live[i] |= live[self.child[i]] | live[self.child[i] + 1]
        return _Ways(ends, live, np.array(self.feature), np.array(self.limit), np.array(self.child))


@dataclass(frozen=True)
class _Ways:
    """How rows come to the wanted nodes: which nodes are such, which lead to one, and the splits."""

    ends: np.ndarray
    live: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    child: np.ndarray


@dataclass(frozen=True)
class _Block:
    """Rows ordered by segment: number and length of the segments' runs, labels, and (feature, row) values."""

    segment: np.ndarray
    length: np.ndarray
    y: np.ndarray
    x: np.ndarray

    def pieces(self, ways: _Ways) -> Iterator[tuple[int, np.ndarray]]:
        ends = self.length.cumsum()
        left = [(s, np.arange(end - n, end)) for s, n, end in zip(self.segment.tolist(), self.length.tolist(), ends.tolist()) if ways.live[s]]
        while left:
            i, rows = left.pop()
            if ways.ends[i]:
                yield i, rows
                continue
            low, child = self.x[ways.feature[i]][rows] <= ways.limit[i], int(ways.child[i])
            left += [(j, part) for j, part in ((child, rows[low]), (child + 1, rows[~low])) if ways.live[j] and len(part)]


def packed(rows: DataFrame, features: Sequence[str], rates: dict[int, float]) -> DataFrame:
    """Rows (_s, _y, features) in blocks, with a sample of each segment at its rate beside them."""
    features = list(features)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, n, made = TaskContext.get(), [], 0, 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            s = table.column("_s").to_numpy()
            order = s.argsort(kind="stable")
            s, y = s[order], table.column("_y").to_numpy().astype("<i4")[order]
            x = np.stack([table.column(f).to_numpy()[order] for f in features]).astype("<f8") + 0.0  # no negative zeros
            segment, length = np.unique(s, return_counts=True)
            rate = np.repeat([rates.get(k, 0.0) for k in segment.tolist()], length)
            some = np.random.default_rng([task.partitionId(), made]).random(len(s)) < rate
            made_of = (segment.astype("<i4"), length.astype("<i4"), y, x, s[some].astype("<i4"), x[:, some])
            return pa.record_batch([pa.array([a.tobytes()], pa.binary()) for a in made_of], names=["s", "c", "y", "x", "ss", "sx"])

        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                held.append(batch.slice(at, BLOCK_ROWS))
                n += len(held[-1])
                if n >= BLOCK_ROWS:
                    yield block()
                    held, n, made = [], 0, made + 1
        if n:
            yield block()

    return rows.select("_s", "_y", *features).mapInArrow(lay, _BLOCK)


def sample(blocks: DataFrame, features: int) -> dict[int, np.ndarray]:
    """(feature, row) values of the sampled rows of each segment."""
    found = blocks.select("ss", "sx").toArrow()
    s = np.concatenate([np.zeros(0, "<i4"), *_arrays(found, "ss", "<i4")])
    x = np.concatenate([np.zeros((features, 0)), *(a.reshape(features, -1) for a in _arrays(found, "sx", "<f8"))], axis=1)
    order = s.argsort(kind="stable")
    segment, start = np.unique(s[order], return_index=True)
    return dict(zip(segment.tolist(), np.split(x[:, order], start[1:], axis=1)))


def _arrays(table: pa.Table | pa.RecordBatch, column: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), kind) for v in table.column(column)]


def _by_node(batches: Iterator[pa.RecordBatch], ways: _Ways) -> Iterator[tuple[int, list[tuple[_Block, np.ndarray]]]]:
    """(node, its rows as places in blocks), for about ``CHUNK_ROWS`` rows after the other."""
    held, n = [], 0

    def nodes():
        found = defaultdict(list)
        for block in held:
            for i, rows in block.pieces(ways):
                found[i].append((block, rows))
        return found.items()

    for batch in batches:
        for s, c, y, x in zip(*(_arrays(batch, name, kind) for name, kind in (("s", "<i4"), ("c", "<i4"), ("y", "<i4"), ("x", "<f8")))):
            held.append(_Block(s, c, y, x.reshape(-1, len(y))))
            n += len(y)
            if n >= CHUNK_ROWS:
                yield from nodes()
                held, n = [], 0
    yield from nodes()


def _labels(places: list[tuple[_Block, np.ndarray]]) -> np.ndarray:
    return np.concatenate([block.y[rows] for block, rows in places])


def _values(places: list[tuple[_Block, np.ndarray]], f: int) -> np.ndarray:
    return np.concatenate([block.x[f][rows] for block, rows in places])


def _ordered(places, f: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values of the rows, and of the positives."""
    values = _values(places, f)
    positive = np.repeat(values, y)
    values.sort()
    positive.sort()
    return values, positive


def rows_by_node(blocks: DataFrame, ways: _Ways) -> DataFrame:
    """(node, y, x): the rows of the wanted nodes, a chunk's rows of a node together."""
    def deal(batches):
        for i, places in _by_node(batches, ways):
            x = np.concatenate([block.x[:, rows] for block, rows in places], axis=1)
            yield pa.record_batch([pa.array([i], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in (_labels(places), x))], names=["node", "y", "x"])

    return blocks.select("s", "c", "y", "x").mapInArrow(deal, BY_NODE)


def rows_of(group: pa.Table, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) values and labels of a node from its rows of ``rows_by_node``."""
    return np.concatenate([a.reshape(features, -1) for a in _arrays(group, "x", "<f8")], axis=1), np.concatenate(_arrays(group, "y", "<i4")).astype(np.int64)


def _cuts(values: np.ndarray) -> np.ndarray:
    """All values if they are few, else some that lie in about equal distances of rank."""
    different = np.unique(values)
    return different if len(different) <= CUTS else np.unique(np.sort(values)[((np.arange(CUTS) + 0.5) * len(values) / CUTS).astype(int)])


def edge_counts(blocks: DataFrame, nodes: Nodes, wanted: Sequence[int], samples: dict[int, np.ndarray], features: int, bins: int) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """(node, per feature: its edges of equal-share bins, the highest left out, rows and positives up to them)."""
    at_once = max(1, STATE_NUMBERS // (4 * CUTS * features))
    for first in range(0, len(wanted), at_once):
        yield from _round(blocks, nodes, list(wanted[first : first + at_once]), samples, features, bins)


def _round(blocks, nodes, wanted, samples, features: int, bins: int):
    nothing = np.zeros((features, 0))
    cuts = {i: [_cuts(v) for v in samples.get(i, nothing)] for i in wanted}
    ways = nodes.ways(wanted)
    ranked = {}
    bounds, asked = {}, {}
    for i, sums in _counted(blocks, ways, cuts):
        at = 2
        for f, cut in enumerate(cuts[i]):
            around = sums[at : at + 4 * len(cut)].reshape(4, len(cut))
            at += around.size
            found = ranked[i, f] = _Ranks(cut, around, int(sums[0]), int(sums[1]), bins)
            bounds[i, f] = found.bounds()
            asked |= {(i, f, part): ask for part, ask in found.asked().items()}
    if asked:
        for i, f, part, values, counts in _gathered(blocks, ways, {k: b for k, b in bounds.items() if len(b[0])}, asked):
            ranked[i, f].answer(part, values, counts)
    for i in wanted:
        yield i, [ranked[i, f].edges() for f in range(features)]


def _counted(blocks: DataFrame, ways: _Ways, cuts: dict[int, list[np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
    """(node, rows, positives, then per feature rows below, rows up to, positives below and up to each cut)."""
    def count(batches):
        sums = {}
        for i, places in _by_node(batches, ways):
            y = _labels(places)
            found = [[len(y), y.sum(dtype=np.int64)]]
            for f, cut in enumerate(cuts[i]):
                if len(cut):
                    found += [v.searchsorted(cut, side) for v in _ordered(places, f, y) for side in ("left", "right")]
            found = np.concatenate(found)
            sums[i] = sums[i] + found if i in sums else found
        for i, found in sums.items():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([found.astype("<i8").tobytes()], pa.binary())], names=["node", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(_arrays(group, "sums", "<i8"))
        return pa.table({"node": group.column("node").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "node int, sums binary"
    found = blocks.select("s", "c", "y", "x").mapInArrow(count, schema).groupBy("node").applyInArrow(add, schema).toArrow()
    return zip(found.column("node").to_pylist(), _arrays(found, "sums", "<i8"))


def _gathered(blocks: DataFrame, ways: _Ways, bounds: dict, asked: dict) -> Iterator[tuple]:
    """(node, feature, part, values at the asked ranks, rows below and up to them, positives below and up to them)."""
    of_node = defaultdict(list)
    for i, f in bounds:
        of_node[i].append(f)

    def gather(batches):
        for i, places in _by_node(batches, ways):
            if i not in of_node:
                continue
            y, out = _labels(places), []
            for f in of_node[i]:
                low, high, part = bounds[i, f]
                ordered = [(v, v.searchsorted(low, "right").tolist(), v.searchsorted(high, "left").tolist()) for v in _ordered(places, f, y)]
                starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
                for a, b in zip(starts, [*starts[1:], len(part)]):
                    inside = [np.concatenate([v[s:e] for s, e in zip(first[a:b], last[a:b])]) for v, first, last in ordered]
                    if len(inside[0]):
                        out.append((i, f, int(part[a]), *(v.tobytes() for v in inside)))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["node", "f", "part", "v", "q"])

    def rank(group: pa.Table) -> pa.Table:
        key = tuple(group.column(k)[0].as_py() for k in ("node", "f", "part"))
        v, q = (np.sort(np.concatenate(_arrays(group, k, "<f8"))) for k in ("v", "q"))
        ranks, n_before, p_before = asked[key]
        values = v[ranks - n_before]
        counts = [*(v.searchsorted(values, side) + n_before for side in ("left", "right")), *(q.searchsorted(values, side) + p_before for side in ("left", "right"))]
        out = (values.tobytes(), np.stack(counts).astype("<i8").tobytes())
        return pa.table({**{k: group.column(k).slice(0, 1) for k in ("node", "f", "part")}, **{k: pa.array([b], pa.binary()) for k, b in zip(("v", "q"), out)}})

    schema = "node int, f int, part int, v binary, q binary"
    found = blocks.select("s", "c", "y", "x").mapInArrow(gather, schema).groupBy("node", "f", "part").applyInArrow(rank, schema).toArrow()
    keys = (found.column(k).to_pylist() for k in ("node", "f", "part"))
    return zip(*keys, _arrays(found, "v", "<f8"), (c.reshape(4, -1) for c in _arrays(found, "q", "<i8")))


class _Ranks:
    """The ranks around the edges of a node's feature: those on a cut are known from the counts there, the
    others lie between two neighbouring cuts."""

    def __init__(self, cut: np.ndarray, around: np.ndarray, n: int, p: int, bins: int):
        below, upto, positives_below, positives_upto = around
        self.place = (n - 1) * (np.arange(bins + 1) / bins)
        self.ranks = np.unique(np.concatenate([np.floor(self.place), np.ceil(self.place)]).astype(np.int64))
        self.cut = cut
        # Between cuts i - 1 and i lie the ranks from start[i] to before end[i].
        start, end = np.append(0, upto), np.append(below, n)
        positive_start, positive_end = np.append(0, positives_upto), np.append(positives_below, p)
        at = upto.searchsorted(self.ranks, "right")
        self.open = self.ranks < end[at]
        self.values = np.zeros(len(self.ranks))
        self.counts = np.zeros((4, len(self.ranks)), np.int64)
        on = at[~self.open]
        self.values[~self.open], self.counts[:, ~self.open] = cut[on], around[:, on]
        self.gaps, self.gap = np.unique(at[self.open], return_inverse=True)
        rows, positives = (end - start)[self.gaps], (positive_end - positive_start)[self.gaps]
        before, positives_before = rows.cumsum() - rows, positives.cumsum() - positives
        self.part = before // PART_ROWS
        _, first, of = np.unique(self.part, return_index=True, return_inverse=True)
        # What lies before a gap in the whole node, less what lies before it in its part.
        self.n_before = start[self.gaps] - (before - before[first][of])
        self.p_before = positive_start[self.gaps] - (positives_before - positives_before[first][of])

    def bounds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.append(-np.inf, self.cut)[self.gaps], np.append(self.cut, np.inf)[self.gaps], self.part

    def _mine(self, part: int) -> np.ndarray:
        """Places of the ranks in a part."""
        return np.flatnonzero(self.open)[self.part[self.gap] == part]

    def asked(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ranks = self.ranks[self.open]
        return {k: (ranks[mine], self.n_before[self.gap[mine]], self.p_before[self.gap[mine]]) for k in np.unique(self.part).tolist() for mine in [self.part[self.gap] == k]}

    def answer(self, part: int, values: np.ndarray, counts: np.ndarray) -> None:
        mine = self._mine(part)
        self.values[mine], self.counts[:, mine] = values, counts

    def edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = (self.ranks.searchsorted(side(self.place)) for side in (np.floor, np.ceil))
        edges = between(self.values[low], self.values[high], self.place)
        # Rounding may put an edge on its upper neighbour or beyond, or below the lower one.
        n, p = (
            np.where(edges >= self.values[high], upto[high], np.where(edges >= self.values[low], upto[low], below[low]))
            for below, upto in (self.counts[:2], self.counts[2:])
        )
        edges, first = np.unique(edges, return_index=True)
        return edges[:-1], n[first][:-1], p[first][:-1]


def between(low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Values at fractional ranks from those at the whole ranks around them."""
    return np.where(low == high, low, (np.ceil(place) - place) * low + (place - np.floor(place)) * high)
