"""Language-model scores of whole texts: causal self-attention over subword ids, trained in numpy.

The probability of an id is that of its class, given the ids before it, times its share of the class.
All texts become ids once, in a written table. Over the ids of all training documents Spark counts ids
and their neighbours, which make the classes and shares. All windows of all training texts are dealt to
groups of about ``GROUP_WINDOWS``, so the number of groups grows with the corpus; in ``ROUNDS`` rounds every
group fits the one layer of causal self-attention from the same weights, and the mean of their weights
begins the next round. Over the rounds a group takes each of its windows once, or more often if they are
few. A text is cut into overlapping windows: each scores its last
``STRIDE`` places once, with the places before them as context; all windows of a batch go through
masked attention together.

Beside it, a unigram model of words: counts of all training words in a table; the most frequent (a
bounded number) are sent to the workers, which sum a text's logarithms and give out only the other
words, for a join with the table.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.llm.common import Remembered, cut, doc_crc, keyed_texts, mixed, per_text
from riskrules.llm.subwords import encoder, forget

WINDOW, STRIDE = 32, 24
DIM, CLASSES, OWN_CLASSES, OWN_INPUTS = 16, 96, 44, 448
STEPS, BATCH, RATE, ROUNDS = 1_500, 192, 0.02, 5
GROUP_WINDOWS = STEPS * BATCH  # training windows of a group: its steps take each of them once
PART = 48  # windows worked out together, so that their tables stay near the core
LOG2_E = np.float32(math.log2(math.e))  # powers of two are faster than those of e
BLOCK = 1 << 16  # cells of the table of neighbours that travel together
SEGMENT = 128  # neighbouring windows of a text that travel together
PIECE = 1 << 17  # ids whose neighbours are counted at a time
TOKENS, PARTIAL = 1_000_000, 1_500_000  # words counted at a time, and counts that a worker holds
WIDE = 200  # frequent ids that tell neighbours apart
FREQUENT = 250_000  # words sent to the workers, at most
SMOOTHING = 0.1
SEED = 11


@dataclass
class Attention:
    """Tables by input kind (an own id or a class), output weights by class, ids by class."""

    kind_of: np.ndarray  # id -> input kind; then the kinds of the end and of the start and padding
    class_of: np.ndarray  # id (and end) -> class
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    r: np.ndarray
    bias: np.ndarray  # by distance
    u: np.ndarray
    u0: np.ndarray
    share: np.ndarray  # log10 of an id's share of its class

    @property
    def end(self) -> int:
        return len(self.class_of) - 1


def _mask(bias: np.ndarray) -> np.ndarray:
    """(STRIDE, WINDOW): bias by distance, minus infinity for later places."""
    distance = np.arange(WINDOW - STRIDE, WINDOW)[:, None] - np.arange(WINDOW)[None]
    return np.where(distance >= 0, bias[np.maximum(distance, 0)], -1e9).astype(np.float32)


def _windows(sequences: list[np.ndarray], start: int, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """Input kinds of all sequences, each behind padding and a start and filled to whole strides; and
    the first place of every window."""
    parts, begins, at = [], [], 0
    for s in sequences:
        n = len(s) + 1  # the start stands for the place before the first id
        filled = -(-n // STRIDE) * STRIDE
        part = np.full(WINDOW - STRIDE + filled, padding, s.dtype)
        part[WINDOW - STRIDE] = start
        part[WINDOW - STRIDE + 1 : WINDOW - STRIDE + n] = s
        parts.append(part)
        begins.append(at + np.arange(0, filled, STRIDE))
        at += len(part)
    return np.concatenate(parts), np.concatenate(begins)


def _tame(*products: np.ndarray) -> bool:
    """Whether sums of one row of each product can be raised to e without taking off their largest."""
    high, low = sum(p.max(axis=0) for p in products), sum(p.min(axis=0) for p in products)
    return bool(high.max() < 75 and low.max() > -75)


def _tables(q: np.ndarray, k: np.ndarray, v: np.ndarray, r: np.ndarray, u: np.ndarray, u0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of k, v, q, r by kind, and u above u0, such that 2 is raised to their products in place of e."""
    return np.concatenate((k, v, q * LOG2_E, r), axis=1), np.concatenate((u, u0[None])) * LOG2_E


def _attended(table: np.ndarray, c: np.ndarray, mask: np.ndarray, tame: bool) -> tuple[np.ndarray, ...]:
    """(k, v, q, p, total, seen, h) of windows of kinds: p are the weights of the places each place sees, not yet
    divided by their sum ``total``; ``seen`` the mean of v by them; h its sum with r, and a one for u0."""
    d, rows = DIM, table.take(c, axis=0)
    own = rows[:, WINDOW - STRIDE :]
    k, v, q, r = rows[..., :d], rows[..., d : 2 * d], own[..., 2 * d : 3 * d], own[..., 3 * d :]
    p = np.matmul(q, k.transpose(0, 2, 1))
    # Padding is at a window's ends, and never its first own place, so every place sees another.
    padded = np.flatnonzero((c[:, 0] == len(table) - 1) | (c[:, -1] == len(table) - 1))
    padding = c[padded, None] == len(table) - 1
    if tame:  # numbers far from zero are raised slowly
        np.exp2(p, out=p)
        p *= np.exp2(mask)
        p[padded] *= ~padding
    else:
        p += mask
        p[padded] -= padding * p.dtype.type(1e9)
        p -= p.max(axis=2, keepdims=True)
        np.exp2(p, out=p)
    total = np.matmul(p, np.ones((WINDOW, 1), p.dtype))
    seen = np.matmul(p, v)
    seen /= total
    h = np.ones((len(c), STRIDE, d + 1), p.dtype)
    np.add(seen, r, out=h[..., :d])
    return k, v, q, p, total, seen, h


def logs(model: Attention, sequences: list[np.ndarray], chunk: int = PART) -> np.ndarray:
    """log10 probability of every sequence of ids with its end."""
    end, d = model.end, model.q.shape[1]
    start, padding = len(model.kind_of), len(model.kind_of) + 1
    kinds = np.concatenate([model.kind_of, [len(model.q) - 2, len(model.q) - 1]]).astype(np.int32)
    flat, begins = _windows([s.astype(np.int32) for s in sequences], start, padding)
    targets = []
    for s in sequences:
        t = np.full(-(-(len(s) + 1) // STRIDE) * STRIDE, -1, np.int32)
        t[: len(s)], t[len(s)] = s, end
        targets.append(t)
    lengths = np.array([len(t) for t in targets])
    target = np.concatenate(targets).reshape(-1, STRIDE)
    cats = kinds[flat]
    queries = model.q / np.float32(math.sqrt(d))
    table, u = _tables(queries, model.k, model.v, model.r, model.u, model.u0)
    mask = _mask(model.bias * LOG2_E)
    # The least and largest values are taken over all pairs of kinds, whatever the text.
    pairs = (queries @ model.k.T).reshape(-1, 1)
    tame = _tame(pairs, model.bias[:, None]) and _tame(model.r @ model.u, model.v @ model.u, model.u0[None])
    out = np.empty(target.shape, np.float32)
    steps, all_classes = np.arange(WINDOW), np.ones((CLASSES, 1), np.float32)
    for i in range(0, len(begins), chunk):
        h = _attended(table, cats[begins[i : i + chunk, None] + steps], mask, tame)[-1]
        l = np.matmul(h, u).reshape(-1, CLASSES)  # window by window, as one product would wake threads
        t = target[i : i + chunk].ravel()
        known = np.maximum(t, 0)
        if not tame:
            l -= l.max(axis=1, keepdims=True)
        picked = l[np.arange(len(l)), model.class_of[known]]
        np.exp2(l, out=l)
        p = (picked - np.log2(np.matmul(l, all_classes)[:, 0])) * np.float32(math.log10(2)) + model.share[known]
        out[i : i + chunk] = np.where(t >= 0, p, 0).reshape(-1, STRIDE)
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.add.reduceat(out.ravel().astype(np.float64), begin)


def _order(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts, kind="stable")


def _around(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, side): by id, its row in the table of neighbours (-1: none) and its column as a neighbour."""
    some = _order(counts)[OWN_CLASSES:]
    some = some[counts[some] >= 8]
    row, column = np.full(len(counts), -1), np.zeros(len(counts), np.int64)
    row[some] = np.arange(len(some))
    column[_order(counts)[:WIDE]] = np.arange(1, 1 + min(WIDE, len(counts)))
    return row, column


def _cells(sequences: list[np.ndarray], row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The cell of every pair of neighbours: by the id with a row, the side, and the other's column."""
    ids = np.concatenate([x for s in sequences for x in (s, [-1])]).astype(np.int64)
    some = ids >= 0
    at, next_to = np.where(some, row.take(ids), -1), column.take(ids)
    cells = []
    for me, other, side in ((slice(1, None), slice(None, -1), 0), (slice(None, -1), slice(1, None), 1)):
        there = (at[me] >= 0) & some[other]
        cells.append((at[me][there] * 2 + side) * (1 + WIDE) + next_to[other][there])
    return np.concatenate(cells)


def _neighbours(sequences: list[np.ndarray], row: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, n): how often the ids with a row have each column before (first half of a row) and after them."""
    return np.unique(_cells(sequences, row, column), return_counts=True)


def _classes(cells: np.ndarray, n: np.ndarray, names: list[str], counts: np.ndarray) -> np.ndarray:
    """A class for every id and the end: frequent ids have their own, others go by their neighbours
    (k-means over square roots of neighbour shares), rare ones by whether they end a word and are ASCII."""
    size = len(names)
    order = _order(counts)
    own = order[:OWN_CLASSES]
    rare = 4
    out = np.empty(size + 1, np.int64)
    for i, name in enumerate(names):
        out[i] = CLASSES - rare + 2 * name.endswith("</w>") + (not name.removesuffix("</w>").isascii())
    out[size] = 0
    out[own] = np.arange(1, len(own) + 1)
    some = order[OWN_CLASSES:]
    some = some[counts[some] >= 8]
    k = CLASSES - rare - len(own) - 1
    if len(some) <= k:
        out[some] = len(own) + 1 + np.arange(len(some))
        return out
    x = np.zeros((len(some), 2, 1 + WIDE), np.float32)
    x.reshape(-1)[cells] = n
    x /= np.maximum(x.sum(axis=2, keepdims=True), 1)
    x = np.sqrt(x, out=x).reshape(len(some), -1)
    centre = x[:k].copy()  # the most frequent
    heavy = counts[some].astype(np.float64)
    for _ in range(20):
        near = (x @ centre.T * 2 - (centre**2).sum(axis=1)).argmax(axis=1)
        weight = np.bincount(near, heavy, minlength=k)
        for c in np.flatnonzero(weight):
            mine = near == c
            centre[c] = (heavy[mine] @ x[mine]) / weight[c]
    out[some] = len(own) + 1 + near
    return out


def _started(names: list[str], counts: np.ndarray, ends: int, class_of: np.ndarray, seed: int = SEED) -> Attention:
    """Random tables; the output bias is the frequency of the classes."""
    rng, size = np.random.default_rng(seed), len(names)
    kind_of = OWN_INPUTS + class_of
    frequent = _order(counts)[:OWN_INPUTS]
    frequent = frequent[counts[frequent] > 0]
    kind_of[frequent] = np.arange(len(frequent))
    kinds = OWN_INPUTS + CLASSES + 2  # then the start and the padding
    table = lambda scale: (rng.standard_normal((kinds, DIM)) * scale).astype(np.float32)
    q, k, v, r = (table(0.3) for _ in range(4))
    u = (rng.standard_normal((DIM, CLASSES)) * 0.3).astype(np.float32)
    u0 = np.log(np.bincount(class_of, np.append(counts, ends), minlength=CLASSES) + 1.0).astype(np.float32)
    bias = (-0.1 * np.arange(WINDOW)).astype(np.float32)
    return Attention(kind_of.astype(np.int32), class_of.astype(np.int32), q, k, v, r, bias, u, u0, share=np.zeros(size + 1, np.float32))


def _drawn(s: np.ndarray, size: int, share: float, doc_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, window) of the training windows drawn from a text's ids: by a hash of the document, its text
    and the place, below ``share`` of all hashes. A window holds its places and the id after the last."""
    flat, begins, hashes = _laid(s, size, doc_id)
    chosen = (hashes >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share
    return hashes[chosen], flat[begins[chosen, None] + np.arange(WINDOW + 1)]


def _laid(s: np.ndarray, size: int, doc_id: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text's ids behind padding and the start and filled to whole strides, where its windows begin, and a
    hash of document, text and place for each."""
    filled = -(-(len(s) + 1) // STRIDE) * STRIDE
    flat = np.full(WINDOW - STRIDE + filled + 1, size + 2, np.int32)  # padding; the start is size + 1, the end size
    at = WINDOW - STRIDE + 1
    flat[at - 1], flat[at : at + len(s)], flat[at + len(s)] = size + 1, s, size
    begins = np.arange(0, filled, STRIDE)
    document = zlib.crc32(s.tobytes(), zlib.crc32(str(doc_id).encode()))
    return flat, begins, mixed(begins.astype(np.uint64) + (np.uint64(document) << np.uint64(31)))


_WEIGHTS = ("q", "k", "v", "r", "bias", "u", "u0")


def _improved(model: Attention, flat: np.ndarray, begins: np.ndarray, times: np.ndarray, turn: int, turns: int, steps: int, seed: int) -> dict[str, np.ndarray]:
    """The weights after one of ``turns`` equal shares of at least ``steps`` steps of Adam. The steps take the
    windows that begin at ``begins`` of ``flat`` in random order, every one before any comes again; a window
    that occurs several times weighs as much more in its batch."""
    first_step, last_step, total = _share(len(begins), turn, turns, steps)
    return _stepped(model, flat, begins, times, _visits(len(begins), first_step, last_step, seed), first_step, total)


def _share(n: int, turn: int, turns: int, steps: int) -> tuple[int, int, int]:
    """The first and the end of a turn's steps over ``n`` windows, and those of all turns."""
    total = max(steps, -(-n // BATCH))
    return total * turn // turns, total * (turn + 1) // turns, total


def _visits(n: int, first_step: int, last_step: int, seed: int) -> np.ndarray:
    """The windows, of ``n``, that these steps take, ``BATCH`` a step."""
    rounds = range(first_step * BATCH // n, -(-last_step * BATCH // n))
    visits = np.concatenate([np.zeros(0, np.int64), *(np.random.default_rng((seed, r)).permutation(n) for r in rounds)])
    skipped = first_step * BATCH - rounds.start * n
    return visits[skipped : skipped + (last_step - first_step) * BATCH]


def _stepped(model: Attention, flat: np.ndarray, begins: np.ndarray, times: np.ndarray, visits: np.ndarray, first_step: int, total: int) -> dict[str, np.ndarray]:
    """The weights after the steps that take ``visits``, which follow ``first_step`` of ``total`` steps."""
    size, shapes = model.end, {n: getattr(model, n).shape for n in _WEIGHTS}
    weights = np.concatenate([getattr(model, n).ravel() for n in _WEIGHTS])
    ends = np.cumsum([math.prod(s) for s in shapes.values()])
    w = {n: part.reshape(shapes[n]) for n, part in zip(_WEIGHTS, np.split(weights, ends[:-1]))}  # views
    kinds = np.concatenate([model.kind_of[:size], [len(w["q"]) - 1, len(w["q"]) - 2, len(w["q"]) - 1]])
    goals = np.concatenate([model.class_of, [-1, -1]])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    distance = np.maximum(np.arange(WINDOW - STRIDE, WINDOW)[:, None] - np.arange(WINDOW)[None], 0)
    for i, step in enumerate(range(first_step + 1, first_step + 1 + len(visits) // BATCH), 1):
        pick = visits[(i - 1) * BATCH : i * BATCH]
        windows = flat[begins[pick, None] + np.arange(WINDOW + 1)]
        grads = _gradients(w, kinds[windows[:, :-1]], goals[windows[:, WINDOW - STRIDE + 1 :]], distance, times[pick])
        rate = RATE * min(1.0, i / 20) * (1 - 0.9 * step / total)
        g = np.concatenate([grads[n].ravel() for n in _WEIGHTS])
        first *= 0.9
        first += 0.1 * g
        second *= 0.99
        second += 0.01 * g * g
        change = rate * (first / (1 - 0.9**i))
        change /= np.sqrt(second / (1 - 0.99**i)) + 1e-6
        weights -= change
    return w


def trained(ids: list[np.ndarray], names: list[str], steps: int = STEPS, seed: int = SEED) -> Attention:
    """The model of a few sequences of ids, in one place; without sequences it stays at its random start."""
    size = len(names)
    if not ids:
        return _started(names, np.zeros(size, np.int64), 0, _classes(np.array([], np.int64), np.array([]), names, np.zeros(size, np.int64)), seed)
    counts = np.bincount(np.concatenate(ids), minlength=size)
    model = _started(names, counts, len(ids), _classes(*_neighbours(ids, *_around(counts)), names, counts), seed)
    windows = np.concatenate([_drawn(s, size, 1.0)[1] for s in ids])
    begins = np.arange(len(windows)) * (WINDOW + 1)
    return replace(model, **_improved(model, windows.ravel(), begins, np.ones(len(windows), np.int64), 0, 1, steps, seed))


def _longest(x: np.ndarray) -> float:
    """Length of the longest row."""
    return math.sqrt(float(np.einsum("ij,ij->i", x, x).max()))


def _gradients(w: dict, c: np.ndarray, goal: np.ndarray, distance: np.ndarray, times: np.ndarray | None = None) -> dict:
    """Gradients of the mean cross entropy of the goals' classes, windows weighed by ``times``.

    Neither softmax is divided out: its sum goes to the narrow side of the products."""
    dtype, scale, d = w["q"].dtype, np.float32(1 / math.sqrt(DIM)), DIM
    table, u = _tables(w["q"] * scale, w["k"], w["v"], w["r"], w["u"], w["u0"])
    back, mask = np.ascontiguousarray(w["u"].T), _mask(w["bias"] * LOG2_E)
    share = (goal >= 0).astype(dtype)
    if times is not None:
        share *= times[:, None].astype(dtype)
    share /= max(1, share.sum())
    # Products are within those of lengths; beyond these bounds the largest values are taken off.
    tame = _longest(w["q"]) * _longest(w["k"]) * scale + np.abs(w["bias"]).max() < 60
    tame_classes = (_longest(w["v"]) + _longest(w["r"])) * _longest(back.T) + np.abs(w["u0"]).max() < 60
    all_classes, goal = np.ones((CLASSES, 1), dtype), np.maximum(goal, 0)  # without a goal the share is 0
    grads = np.zeros((*c.shape, 4 * d), dtype)  # as ``table``, for every place
    du, dbias = np.zeros_like(u), np.zeros((STRIDE, WINDOW), dtype)
    for i in range(0, len(c), PART):
        k, v, q, p, total, seen, h = _attended(table, c[i : i + PART], mask, tame)
        # Products window by window: one large product would be dealt to threads that wait for each other.
        e = np.matmul(h, u)
        if not tame_classes and (e.max() > 80 or e.min() < -80):
            e -= e.max(axis=2, keepdims=True)
        np.exp2(e, out=e)
        sums = np.matmul(e, all_classes)
        flat = e.reshape(-1)
        flat[np.arange(0, len(flat), CLASSES) + goal[i : i + PART].ravel()] -= sums.ravel()
        weight = share[i : i + PART, :, None] / sums
        dh = np.matmul(e, back)
        dh *= weight
        h *= weight
        du += np.matmul(h.transpose(0, 2, 1), e).sum(axis=0)
        out = grads[i : i + PART]
        own = out[:, WINDOW - STRIDE :]
        own[..., 3 * d :] = dh
        dh /= total
        da = np.matmul(dh, v.transpose(0, 2, 1))
        da -= np.einsum("bsd,bsd->bs", dh, seen)[..., None]
        da *= p
        dbias += da.sum(axis=0)
        np.matmul(da.transpose(0, 2, 1), q, out=out[..., :d])
        np.matmul(p.transpose(0, 2, 1), dh, out=out[..., d : 2 * d])
        np.matmul(da, k, out=own[..., 2 * d : 3 * d])
    places = c.ravel().astype(np.int16)  # kinds are few; such numbers are ordered by their digits
    order = np.argsort(places, kind="stable")
    places = places[order]
    starts = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    # Two columns are added as one complex number.
    pairs = grads.reshape(-1, 4 * d).take(order, axis=0).view(np.result_type(dtype, np.complex64))
    dtable = np.zeros_like(table)
    dtable[places[starts]] = np.add.reduceat(pairs, starts, axis=0).view(dtype)
    dk, dv, dq, dr = (dtable[:, j * d : (j + 1) * d] for j in range(4))
    return {
        "q": dq * scale,
        "k": dk / LOG2_E,
        "v": dv,
        "r": dr,
        "bias": np.bincount(distance.ravel(), dbias.ravel(), minlength=WINDOW).astype(w["bias"].dtype),
        "u": du[:d],
        "u0": du[d],
    }


class _Words(dict):
    """(ids, logarithm or None) of a word; the frequent ones are kept, the others remembered for a while."""

    def __init__(self, logs_of: dict[bytes, float], path: str):
        super().__init__()
        self.logs_of = logs_of
        one = encoder(path).one
        self.others = Remembered(lambda w: (one(w), None), 50_000)

    def __missing__(self, word: bytes):
        log = self.logs_of.get(word)
        if log is None:
            return self.others[word]
        self[word] = found = (self.others.function(word)[0], log)
        return found


_WORDS: list[_Words] = []


def _words(logs_of: dict[bytes, float], path: str) -> _Words:
    """One per worker for the broadcast table in use."""
    if not _WORDS or _WORDS[0].logs_of is not logs_of:
        _WORDS[:] = [_Words(logs_of, path)]
    return _WORDS[0]


def _forget_words() -> None:
    """Free the words and the encoder of the stage before in a worker that goes on to others."""
    _WORDS.clear()
    forget()


def _word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all given texts, summed in the workers before the shuffle."""

    def work(batches) -> Iterator[dict]:
        tokens, parts = [], []

        def count():
            found = pa.array(tokens, pa.binary()).value_counts()
            parts.append(pa.table([found.field("values"), found.field("counts")], names=["word", "n"]))
            tokens.clear()

        def summed() -> dict:
            found = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
            parts.clear()
            return {"word": found.column("word").combine_chunks(), "n": found.column("n_sum").combine_chunks()}

        for _, bodies in batches:
            for t in bodies:
                tokens += t.lower().split()
                if len(tokens) >= TOKENS:
                    count()
            if sum(map(len, parts)) >= PARTIAL:
                yield summed()
        count()
        yield summed()

    return per_text(texts, work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _id_counts(codes: DataFrame, kind: str, size: int) -> np.ndarray:
    """Occurrences of every id in all training texts."""

    def work(batches) -> Iterator[dict]:
        _forget_words()
        total = np.zeros(size, np.int64)
        for _, bodies in batches:
            total += np.bincount(np.frombuffer(b"".join(bodies), kind), minlength=size)
        at = np.flatnonzero(total)
        yield {"id": at, "n": total[at]}

    rows = per_text(codes, work, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # at most the tokenizer's ids
    out = np.zeros(size, np.int64)
    out[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return out


def _neighbour_counts(codes: DataFrame, kind: str, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_neighbours`` over all training texts: at most two times 1 + ``WIDE`` numbers for each id of the tokenizer."""
    row, column = _around(counts)
    cells = (int(row.max(initial=-1)) + 1) * 2 * (1 + WIDE)

    def work(batches) -> Iterator[dict]:
        _forget_words()
        # One table a worker; few texts at a time, as their ids take many times their bytes while they are counted.
        total, held, volume = np.zeros(cells, np.int32), [], 0

        def add():
            np.add.at(total, _cells(held, row, column), np.int32(1))
            held.clear()

        for _, bodies in batches:
            for body in bodies:
                text = np.frombuffer(body, kind)
                for i in range(0, len(text), PIECE):  # a piece begins with the id before it, so that no pair is lost
                    part = text[max(0, i - 1) : i + PIECE]
                    if i:
                        np.add.at(total, _cells([part[:2]], row, column), np.int32(1))
                        part = part[1:]
                    held.append(part)
                    volume += len(part)
                    if volume >= PIECE:
                        add()
                        volume = 0
        if held:
            add()
        for i in range(0, cells, BLOCK):
            some = total[i : i + BLOCK]
            at = np.flatnonzero(some)
            yield {"block": [i // BLOCK], "at": [at.astype("<u2").tobytes()], "n": [some[at].astype("<i8").tobytes()]}

    def add(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for at, n in zip(group.column("at"), group.column("n")):
            total[np.frombuffer(at.as_buffer(), "<u2")] += np.frombuffer(n.as_buffer(), "<i8")
        at = np.flatnonzero(total)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "at": pa.array([at.astype("<u2").tobytes()], pa.binary()), "n": pa.array([total[at].astype("<f4").tobytes()], pa.binary())})

    # Cells travel in blocks: a row for each would fill the executors.
    blocks = per_text(codes, work, "block int, at binary, n binary").groupBy("block").applyInArrow(add, "block int, at binary, n binary").toArrow().to_pylist()
    cell = [np.frombuffer(r["at"], "<u2").astype(np.int64) + r["block"] * BLOCK for r in blocks]
    return np.concatenate([np.zeros(0, np.int64), *cell]), np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(r["n"], "<f4") for r in blocks)])


def _fitted(codes: DataFrame, model: Attention, kind: str, n_windows: int, steps: int) -> Attention:
    """The attention fitted to all windows of all training texts, the same whatever the partitions."""
    size, groups = model.end, -(-n_windows // GROUP_WINDOWS)
    wide = "<u2" if size + 2 < 1 << 16 else "<i4"

    def lay(batches) -> Iterator[dict]:
        for doc_ids, bodies in batches:
            hashes, segments = [], []
            for doc_id, body in zip(doc_ids, bodies):
                flat, begins, h = _laid(np.frombuffer(body, kind), size, doc_id)
                flat = flat.astype(wide)
                for i in range(0, len(begins), SEGMENT):
                    hashes.append(h[i].view(np.int64))
                    segments.append(flat[begins[i] : begins[min(i + SEGMENT, len(begins)) - 1] + WINDOW + 1].tobytes())
            yield {"h": np.array(hashes, np.int64), "w": segments}

    if not groups:
        return model
    laid = per_text(codes, lay, "h long, w binary").select(F.pmod("h", F.lit(groups)).alias("group"), "h", "w")
    # Segments of repeated rows are one row each with their number, so that no group grows with them.
    once = laid.repartition(groups, "group").groupBy("group", "h", "w").agg(F.count("*").alias("n"))

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).to_pandas().sort_values(["h", "w"])
        lengths = rows["w"].map(len).to_numpy() // np.dtype(wide).itemsize
        counts = (lengths - (WINDOW - STRIDE) - 1) // STRIDE
        begins = np.repeat(np.cumsum(lengths) - lengths, counts) + STRIDE * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        flat, times = np.frombuffer(b"".join(rows["w"]), wide), np.repeat(rows["n"].to_numpy(), counts)
        group, place, before = key[0].as_py(), np.empty(len(begins), np.int32), np.zeros(len(begins), bool)
        for turn in range(ROUNDS):
            visits = _visits(len(begins), *_share(len(begins), turn, ROUNDS, steps)[:2], SEED + 1_000 * group)
            taken = np.unique(visits)
            new, again = taken[~before[taken]], taken[before[taken]]
            before[new] = True
            laid = np.concatenate([new, again])
            place[laid] = np.arange(len(laid))
            values = (
                (flat[begins[laid, None] + np.arange(WINDOW + 1)], wide),
                (np.arange(len(new)) * (WINDOW + 1), "<i8"),
                (times[new], "<i8"),
                (times[again], "<i8"),
                (place[visits], "<i4"),
            )
            yield pa.record_batch([pa.array([group]), pa.array([turn], pa.int32()), pa.array([len(begins)]), *(pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in values)], names=["group", "turn", "size", *parts])

    # A row has what a group's steps of one turn take, some 5 MB: the windows, one after another, first those that
    # no turn before took, where these begin and how often they occur, how often the others do, and the order.
    # A group in one row would fill the executors outside the heap, where rows pass to the workers.
    parts = ("flat", "begins", "times", "again", "visits")
    packed = _row_by_row(once.groupBy("group").applyInArrow(pack, f"group long, turn int, size long, {', '.join(f'{n} binary' for n in parts)}"))
    names = ", ".join(f"{n} binary" for n in _WEIGHTS)
    for turn in range(ROUNDS):
        now = model

        def fit(batches):
            for batch in batches:
                for i in range(len(batch)):
                    group, n, *values = (c[i] for c in batch.columns)
                    flat, times, again, visits = (np.frombuffer(x.as_buffer(), t) for x, t in zip(values, (wide, "<i8", "<i8", "<i4")))
                    first_step, _, total = _share(n.as_py(), turn, ROUNDS, steps)
                    times = np.concatenate([times, again])
                    w = _stepped(now, flat, np.arange(len(times)) * (WINDOW + 1), times, visits, first_step, total)
                    yield pa.record_batch([pa.array([group.as_py()]), *(pa.array([w[n].astype("<f4").tobytes()], pa.binary()) for n in _WEIGHTS)], names=["group", *_WEIGHTS])

        # Weights of a group: 150 kB. They are added up in the order of the groups, a part of them in each task.
        found = packed.filter(F.col("turn") == turn).select("group", "size", "flat", "times", "again", "visits").mapInArrow(fit, f"group long, {names}")
        while True:
            part = found.select(F.floor(F.col("group") / 64).alias("part"), "*")
            found = cut(part.groupBy("part").applyInPandas(_added, f"group long, groups double, {names}"))
            if found.count() == 1:
                break
        sums = found.first()
        model = replace(model, **{n: (np.frombuffer(sums[n], "<f8") / sums.groups).reshape(getattr(model, n).shape).astype(np.float32) for n in _WEIGHTS})
    return model


def _row_by_row(df: DataFrame) -> DataFrame:
    """``cut`` with every row in a file of its own, so that a reader of some rows leaves the others."""
    conf, name = df.sparkSession.conf, "spark.sql.files.maxRecordsPerFile"
    before = conf.get(name)
    conf.set(name, "1")
    try:
        return cut(df)
    finally:
        conf.set(name, before)


def _added(key, rows):
    """Sums of weights over at most 64 groups, or of such sums."""
    rows = rows.sort_values("group")
    kind = "<f8" if "groups" in rows else "<f4"
    sums = {n: [np.sum([np.frombuffer(w, kind).astype(np.float64) for w in rows[n]], axis=0).tobytes()] for n in _WEIGHTS}
    return pd.DataFrame({"group": [key[0]], "groups": [float(rows["groups"].sum()) if "groups" in rows else float(len(rows))], **sums})


def _frequent(words: DataFrame) -> DataFrame:
    """The words of the largest counts, at most ``FREQUENT``: the least count that fits comes from the
    numbers of words by count, of which there are few (a corpus of T tokens has under sqrt(2T) counts)."""
    sizes = words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(FREQUENT).collect()
    least, have = math.inf, 0
    for r in sizes:
        have += r.words
        if have > FREQUENT:
            break
        least = r.n
    return words.filter(F.col("n") >= least) if sizes and least < math.inf else words.filter(F.lit(False))


def learned(codes: DataFrame, path: str, n_docs: int, steps: int | None = None) -> Attention:
    """The model of all training texts, given as (doc_id, ids) of a written table."""
    known, steps = encoder(path), STEPS if steps is None else steps
    names = [known.tokenizer.id_to_token(i) or "" for i in range(known.size)]
    counts = _id_counts(codes, known.kind, known.size)
    model = _started(names, counts, n_docs, _classes(*_neighbour_counts(codes, known.kind, counts), names, counts))
    model = _fitted(codes, model, known.kind, int(counts.sum()) // STRIDE + n_docs, steps)
    ids = np.append(counts, n_docs) + 0.05
    model.share = np.log10(ids / np.bincount(model.class_of, ids, minlength=CLASSES)[model.class_of]).astype(np.float32)
    return model


def scored(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", held_out=None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_ids) of every row.

    Training rows are those for which ``held_out`` (crc32 of the id as text mod 10 is 0) is false. A null
    or blank text is its end alone. Rows are scored each, repeated ones too; a null id counts as empty
    text for the split. Without training rows every token is unknown.
    """
    held = doc_crc() % 10 == 0 if held_out is None else held_out
    texts = keyed_texts(docs, key, text)
    training = texts.filter(~held)
    words = cut(_word_counts(training))
    n_docs = training.select(F.count("*")).first()[0]
    n_words, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = n_words + n_docs, n_distinct + (n_docs > 0)
    below = math.log10(total + SMOOTHING * (distinct + 1))
    often = _frequent(words).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast({w: math.log10(n + SMOOTHING) for w, n in zip(often.column("word").to_pylist(), often.column("n").to_pylist())})
    end_log = math.log10(n_docs + SMOOTHING)

    def work(batches) -> Iterator[dict]:
        subwords, part, row = encoder(path), TaskContext.get().partitionId(), 0
        words_of = _words(shared.value, path)
        for ids, bodies in batches:
            begin = 0
            while begin < len(ids):
                keys, doc_ids, sizes, known, base, codes = [], [], [], [], [], []
                rare, rare_n, volume = [], [], 0
                while begin < len(ids) and volume < 1 << 20:
                    body, me = bodies[begin], part << 33 | row
                    tokens = body.lower().split()
                    pairs = list(map(words_of.__getitem__, tokens))
                    found = [x for _, x in pairs if x is not None]
                    rest = Counter([t for t, (_, x) in zip(tokens, pairs) if x is None]) if len(found) < len(tokens) else {}
                    rare.append(list(rest))
                    rare_n.append(list(rest.values()))
                    keys.append(me)
                    doc_ids.append(ids[begin])
                    sizes.append(len(tokens) + 1)
                    known.append(len(found) + (n_docs > 0))
                    base.append(sum(found) + end_log)
                    same = subwords.short and b"<" not in body  # the text's chunks are these tokens
                    code = b"".join([c for c, _ in pairs]) if same else subwords.encode(body)
                    codes.append(code)
                    volume, begin, row = volume + len(body), begin + 1, row + 1
                yield {"key": keys, "doc_id": doc_ids, "n": sizes, "known": known, "base": base, "ids": pa.array(codes, pa.binary()), "rare": rare, "rare_n": rare_n}

    # Column by column: what reads the ids does not read the rare words.
    made = cut(per_text(texts, work, "key long, doc_id long, n long, known long, base double, ids binary, rare array<binary>, rare_n array<long>"))
    model, kind = learned(made.filter(~held).select("doc_id", "ids"), path, n_docs), encoder(path).kind

    def score(batches) -> Iterator[dict]:
        for abouts, bodies in batches:
            begin = 0
            while begin < len(bodies):
                end, volume = begin, 0
                while end < len(bodies) and volume < 1 << 19:
                    volume, end = volume + len(bodies[end]), end + 1
                codes = [np.frombuffer(b, kind) for b in bodies[begin:end]]
                yield {"about": abouts[begin:end], "n_ids": [len(c) + 1 for c in codes], "score": logs(model, codes)}
                begin = end

    about = F.struct("key", "doc_id", "n", "known", "base").alias("about")
    whole = per_text(made.select(about, "ids"), score, "about struct<key: long, doc_id: long, n: long, known: long, base: double>, n_ids long, score double")
    rest = made.select("key", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("rare_n").alias("times")))).join(words, "word", "left")
    rest = rest.groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)).alias("rest"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more")
    )
    out = whole.select("about.*", "n_ids", "score").join(rest, "key", "left")
    base = F.col("base") + F.coalesce("rest", F.lit(0.0)) - F.col("n") * F.lit(below)
    return out.select(
        "doc_id",
        held.alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        "n_ids",
    )
