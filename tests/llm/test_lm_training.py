"""Training takes every window of every text; neighbours are counted piece by piece."""

import math
import time
from collections import Counter

import numpy as np
import public_tokenizers

from riskrules.llm import lm_score as lm
from riskrules.llm.subwords import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng, kind = np.random.default_rng(4), encoder(PATH).kind
    ids = [rng.integers(1, 300, n).astype(kind) for n in (0, 23, 24, 2_000, 400)]
    return [*enumerate(ids), *[(4, ids[4])] * 2]  # the last text three times


def test_every_window_is_in_a_group(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_WINDOWS", 30)
    monkeypatch.setattr(lm, "SEGMENT", 8)
    written, cut = [], lm.cut
    monkeypatch.setattr(lm, "cut", lambda df: written.append(cut(df)) or written[-1])
    known = encoder(PATH)
    codes = spark.createDataFrame([(i, x.tobytes()) for i, x in texts()], "doc_id long, ids binary")
    lm.learned(codes, PATH, len(texts()), steps=5)
    packed = next(df for df in written if "flat" in df.columns).collect()
    assert len(packed) > 2
    found = {}
    for r in packed:
        flat, begins, times = (np.frombuffer(x, t) for x, t in ((r.flat, "<u2"), (r.begins, "<i8"), (r.times, "<i8")))
        for b, n in zip(begins, times):
            window = tuple(flat[b : b + lm.WINDOW + 1])
            found[window] = found.get(window, 0) + n
    wanted = {}
    for i, x in texts():
        for window in map(tuple, lm._drawn(x, known.size, 1.0, i)[1]):
            wanted[window] = wanted.get(window, 0) + 1
    assert found == wanted


def test_every_window_is_taken(monkeypatch):
    """With more windows than the least number of steps takes, and once before any comes again."""
    taken, gradients = [], lm._gradients
    monkeypatch.setattr(lm, "_gradients", lambda w, c, goal, distance, times: taken.append(times) or gradients(w, c, goal, distance, times))
    monkeypatch.setattr(lm, "BATCH", 16)
    m = lm.trained([np.array([1, 2, 3])], ["a", "b", "c", "d"], steps=1)
    for windows, steps in ((200, 5), (7, 5)):
        taken.clear()
        flat = np.random.default_rng(1).integers(0, 4, 24 * windows + 9)
        for turn in range(4):
            lm._improved(m, flat, np.arange(windows) * 24, np.arange(windows) + 1, turn, 4, steps, 9)
        order = np.concatenate(taken)
        assert len(order) == 16 * max(steps, -(-windows // 16))
        assert all(len(set(order[i : i + windows])) == windows for i in range(0, len(order) - windows + 1, windows))


def test_neighbours_by_pieces(spark, monkeypatch):
    monkeypatch.setattr(lm, "PIECE", 150)
    kind, size = encoder(PATH).kind, encoder(PATH).size
    ids = [x for _, x in texts()]
    codes = spark.createDataFrame([(i, x.tobytes()) for i, x in texts()], "doc_id long, ids binary").coalesce(1)
    counts = np.bincount(np.concatenate(ids), minlength=size)
    cell, n = lm._neighbour_counts(codes, kind, counts)
    assert dict(zip(cell.tolist(), n.tolist())) == dict(zip(*map(np.ndarray.tolist, lm._neighbours(ids, *lm._around(counts)))))


def test_a_row_holds_one_turn(spark, monkeypatch):
    """Rows of the written groups hold what one turn takes, not a whole group, and lead to the same weights."""
    monkeypatch.setattr(lm, "GROUP_WINDOWS", 8_000)
    written, cut = [], lm.cut
    monkeypatch.setattr(lm, "cut", lambda df: written.append(cut(df)) or written[-1])
    known, rng = encoder(PATH), np.random.default_rng(6)
    rows = [(i, rng.integers(1, 300, 20_000).astype(known.kind)) for i in range(20)]
    rows += rows[:5]
    ids = [x for _, x in rows]
    codes = spark.createDataFrame([(i, x.tobytes()) for i, x in rows], "doc_id long, ids binary")
    names = [""] * known.size
    counts = np.bincount(np.concatenate(ids), minlength=known.size)
    start = lm._started(names, counts, len(ids), lm._classes(*lm._neighbours(ids, *lm._around(counts)), names, counts))
    found = lm._fitted(codes, start, known.kind, 20_800, 5)
    packed = next(df for df in written if "flat" in df.columns).collect()
    window = 2 * (lm.WINDOW + 1)
    assert len(packed) == 15 and all(len(r.flat) <= window * (-(-r["size"] // lm.BATCH) // lm.ROUNDS + 1) * lm.BATCH for r in packed)
    # The same groups, each as a whole.
    groups = {}
    for i, x in dict((i, x) for i, x in rows).items():
        flat, begins, h = lm._laid(x, known.size, i)
        for j in range(0, len(begins), lm.SEGMENT):
            last = begins[min(j + lm.SEGMENT, len(begins)) - 1] + lm.WINDOW + 1
            groups.setdefault(int(h[j].view(np.int64)) % 3, []).append((int(h[j].view(np.int64)), flat[begins[j] : last], 1 + (i < 5)))
    assert len(groups) == 3
    model = start
    for turn in range(lm.ROUNDS):
        made = []
        for g in sorted(groups):
            segments = sorted(groups[g], key=lambda s: s[0])
            flat = np.concatenate([s for _, s, _ in segments])
            at = np.cumsum([0] + [len(s) for _, s, _ in segments])
            begins = np.concatenate([a + np.arange(0, len(s) - lm.WINDOW, lm.STRIDE) for a, (_, s, _) in zip(at, segments)])
            times = np.concatenate([np.full(len(range(0, len(s) - lm.WINDOW, lm.STRIDE)), n) for _, s, n in segments])
            made.append(lm._improved(model, flat, begins, times, turn, lm.ROUNDS, 5, lm.SEED + 1_000 * g))
        mean = {n: (np.sum([w[n].astype(np.float64) for w in made], axis=0) / len(made)).astype(np.float32) for n in lm._WEIGHTS}
        model = lm.replace(model, **mean)
    assert all(np.array_equal(getattr(found, n), getattr(model, n)) for n in lm._WEIGHTS)


def plain_gradients(w, c, goal, distance, times):
    """All windows of a step together, both softmaxes divided out, sums by kind for each pair of tables."""
    own, scale, d = slice(lm.WINDOW - lm.STRIDE, None), np.float32(1 / math.sqrt(lm.DIM)), lm.DIM
    now, kinds = c[:, own], len(w["q"])
    kv, qr = np.concatenate((w["k"], w["v"]), axis=1)[c], np.concatenate((w["q"] * scale, w["r"]), axis=1)[now]
    k, v, q = kv[..., :d], kv[..., d:], qr[..., :d]
    p = np.matmul(q, k.transpose(0, 2, 1)) + lm._mask(w["bias"])
    p[np.broadcast_to((c == kinds - 1)[:, None], p.shape)] = -1e9
    p = np.exp(p - p.max(axis=2, keepdims=True))
    p /= p.sum(axis=2, keepdims=True)
    h = np.matmul(p, v) + qr[..., d:]
    e = np.matmul(h, w["u"]) + w["u0"]
    e = np.exp(e - e.max(axis=2, keepdims=True))
    share = (goal >= 0) * times[:, None].astype(np.float32)
    share /= max(1, share.sum())
    e *= share[..., None] / e.sum(axis=2, keepdims=True)
    b, s = np.nonzero(goal >= 0)
    e[b, s, goal[b, s]] -= share[b, s]
    dh = np.matmul(e, w["u"].T)
    da = np.matmul(dh, v.transpose(0, 2, 1))
    da = (da - np.einsum("bst,bst->bs", da, p)[..., None]) * p

    def summed(places, values):
        order = np.argsort(places.ravel(), kind="stable")
        places = places.ravel()[order]
        starts = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        out = np.zeros((kinds, d), values.dtype)
        out[places[starts]] = np.add.reduceat(values.reshape(-1, d)[order], starts, axis=0)
        return out

    return {
        "q": summed(now, np.matmul(da, k) * scale),
        "k": summed(c, np.matmul(da.transpose(0, 2, 1), q)),
        "v": summed(c, np.matmul(p.transpose(0, 2, 1), dh)),
        "r": summed(now, dh),
        "bias": np.bincount(distance.ravel(), da.sum(axis=0).ravel(), minlength=lm.WINDOW),
        "u": np.matmul(h.transpose(0, 2, 1), e).sum(axis=0),
        "u0": e.sum(axis=(0, 1)),
    }


def a_step(scale=0.3):
    """Weights, kinds, goals, distances and numbers of a step whose windows are in part padded at an end."""
    rng, kinds = np.random.default_rng(8), lm.OWN_INPUTS + lm.CLASSES + 2
    w = {n: (rng.standard_normal((kinds, lm.DIM)) * scale).astype(np.float32) for n in ("q", "k", "v", "r")}
    w |= {"bias": (rng.standard_normal(lm.WINDOW) * 0.1).astype(np.float32), "u": (rng.standard_normal((lm.DIM, lm.CLASSES)) * scale).astype(np.float32)}
    w["u0"] = np.log(rng.integers(1, 1_000_000, lm.CLASSES)).astype(np.float32)
    c, goal = rng.integers(0, kinds - 1, (lm.BATCH, lm.WINDOW)), rng.integers(0, lm.CLASSES, (lm.BATCH, lm.STRIDE))
    c[:6, : lm.WINDOW - lm.STRIDE] = kinds - 1
    for i in range(6, 14):
        c[i, lm.WINDOW - 3 * (i - 5) + 1 :], goal[i, lm.STRIDE - 3 * (i - 5) :] = kinds - 1, -1
    distance = np.maximum(np.arange(lm.WINDOW - lm.STRIDE, lm.WINDOW)[:, None] - np.arange(lm.WINDOW)[None], 0)
    return w, c, goal, distance, rng.integers(1, 4, lm.BATCH)


def test_gradients_of_parts_are_those_of_the_whole():
    for scale in (0.3, 1.0, 3.0, 8.0):  # the larger ones need the largest values taken off
        step = a_step(scale)
        found, wanted = lm._gradients(*step), plain_gradients(*step)
        for n in lm._WEIGHTS:
            assert np.allclose(found[n], wanted[n], rtol=1e-3, atol=1e-4 * np.abs(wanted[n]).max()), (scale, n)


def test_padding_does_not_slow_a_step():
    """A step takes clearly less time than the plain form, also with padded windows, which the steps of a corpus have."""
    step, best = a_step(), {}
    for _ in range(30):
        for f in (lm._gradients, plain_gradients):
            begin = time.process_time()
            f(*step)
            best[f] = min(best.get(f, math.inf), time.process_time() - begin)
    assert best[lm._gradients] < 0.68 * best[plain_gradients]


def test_words_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lm, "TOKENS", 7)
    monkeypatch.setattr(lm, "PARTIAL", 11)
    rng = np.random.default_rng(2)
    bodies = [" ".join(f"W{x}" for x in rng.integers(0, 40, n)).encode() for n in (0, 1, 6, 7, 8, 300, 50)] + [b" \n"]
    texts = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text binary").coalesce(2)
    found = {bytes(r.word): r.n for r in lm._word_counts(texts).collect()}
    assert found == Counter(w for b in bodies for w in b.lower().split())
    assert lm._word_counts(texts.limit(0)).collect() == []
