"""Base scores against plain counts, windows against one place at a time, and held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from riskrules.llm import lm_score as lm
from riskrules.llm.common import table
from riskrules.llm.subwords import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def base_scores(rows):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, (_, t) in enumerate(rows)}
    counts = Counter(w for i, (d, _) in enumerate(rows) if not held(d) for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    return [(d, held(d), len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[i])) for i, (d, _) in enumerate(rows)]


def compare(found, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key)
    theirs = sorted(base_scores(rows), key=key)
    assert [m[:5] for m in mine] == [t[:5] for t in theirs]
    assert np.allclose([m[5] for m in mine], [t[5] for t in theirs], rtol=1e-9)


def test_given_documents(spark, folder, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3_000)  # so that many words go through the join
    monkeypatch.setattr(lm, "STEPS", 300)
    docs = table(spark, folder, "documents")
    found = lm.scored(docs, PATH).collect()
    compare(found, [(r.doc_id, r.text) for r in docs.collect()])
    # Held-out texts: clearly likelier than by the counts of the same ids alone.
    subwords, rows = encoder(PATH), docs.collect()
    ids = {r.doc_id: np.frombuffer(subwords.encode((r.text or "").encode()), subwords.kind) for r in rows}
    counts = np.bincount(np.concatenate([ids[r.doc_id] for r in rows if not held(r.doc_id)]), minlength=subwords.size) + 0.05
    share, out = np.log10(counts / counts.sum()), [r for r in found if r.held_out]
    assert sum(r.score for r in out) > 0.85 * sum(share[ids[r.doc_id]].sum() for r in out)


def test_odd_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 5)
    rows = [(1, "A b a"), (2, None), (3, ""), (4, " \n"), (None, "b c"), (5, "a " * 40_000), (6, "é <|endoftext|> Z"), (1, "A b a"), (10, "unseen words"), (11, "a b")]
    docs = docs_of(rows, extra=("n", "word", "key", "score"))
    found = lm.scored(docs, PATH).collect()
    compare(found, rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert lm.scored(docs_of([]), PATH).count() == 0


def test_only_held_out_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 2)
    ids = [i for i in range(200) if held(i)][:3]
    rows = [(i, "some words") for i in ids]
    found = lm.scored(docs_of(rows), PATH).collect()
    compare(found, rows)
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in found)


def plain_logs(m, ids):
    """One place at a time, with the places that its window shows it."""
    kinds = [len(m.q) - 2, *m.kind_of[ids]]
    total = 0.0
    for place, target in enumerate([*ids, m.end]):
        end = (place // lm.STRIDE + 1) * lm.STRIDE - 1  # the last place of the window
        seen = np.array(kinds[max(0, end - lm.WINDOW + 1) : place + 1])
        distance = np.arange(len(seen) - 1, -1, -1)
        a = m.k[seen] @ m.q[kinds[place]] / math.sqrt(m.q.shape[1]) + m.bias[distance]
        a = np.exp(a - a.max())
        l = (a / a.sum()) @ m.v[seen] + m.r[kinds[place]]
        l = l @ m.u + m.u0
        l -= l.max()
        total += (l[m.class_of[target]] - np.log(np.exp(l).sum())) / math.log(10) + m.share[target]
    return total


def test_each_place_once():
    rng = np.random.default_rng(3)
    names = [f"w{i}</w>" if i % 3 else f"p{i}" for i in range(300)]
    ids = [rng.integers(0, 300, n) for n in (0, 1, 23, 24, 25, 47, 48, 200)]
    m = lm.trained(ids * 5, names, steps=30)
    m.share = np.log10(rng.random(301)).astype(np.float32)
    for scale in (1.0, 40.0):  # the second needs the largest value taken off
        m.u, m.u0 = m.u * np.float32(scale), m.u0 * np.float32(scale)
        assert np.allclose(lm.logs(m, ids, chunk=3), [plain_logs(m, i) for i in ids], rtol=1e-3, atol=1e-2)


def test_probabilities_sum_to_one():
    names = [f"w{i}" for i in range(60)]
    ids = [np.array([1, 2, 3, 1, 2, 3, 1, 2, 3] * 5)] * 10
    m = lm.trained(ids, names, steps=60)
    counts = np.concatenate([np.bincount(np.concatenate(ids), minlength=60), [10]]) + 0.05
    m.share = np.log10(counts / np.bincount(m.class_of, counts, minlength=lm.CLASSES)[m.class_of]).astype(np.float32)
    start = [np.array([], np.int64)]
    whole = lm.logs(m, start)[0]  # only the end
    firsts = lm.logs(m, [np.array([i]) for i in range(60)]) - np.array([plain_logs(m, np.array([i])) - first(m, i) for i in range(60)])
    # Classes without any id keep their share of the class probabilities.
    assert (10**firsts).sum() + 10**whole <= 1.0001
    assert lm.logs(m, [ids[0][:30]])[0] > lm.logs(m, [np.array([5] * 30)])[0]


def first(m, i):
    """log10 probability of the first id alone."""
    kind = len(m.q) - 2
    l = (m.v[kind] + m.r[kind]) @ m.u + m.u0
    l -= l.max()
    return (l[m.class_of[i]] - np.log(np.exp(l).sum())) / math.log(10) + m.share[i]


def test_learns_from_all_texts(spark, monkeypatch):
    """Counts and neighbours as in one place; windows from the ends of long texts; groups grow with the
    corpus; the model does not depend on partitions, and rows repeated often do not fill a group."""
    monkeypatch.setattr(lm, "GROUP_WINDOWS", 40)
    rng = np.random.default_rng(5)
    kind, size = encoder(PATH).kind, encoder(PATH).size
    ids = [rng.integers(1, 400, n).astype(kind) for n in (0, 5, 30, 3_000, 700)] + [np.array([7, 8, 9], kind)] * 200
    rows = [(i if i < 5 else 5, x.tobytes()) for i, x in enumerate(ids)]
    codes = lambda n: spark.createDataFrame(rows, "doc_id long, ids binary").repartition(n)
    counts = lm._id_counts(codes(3), kind, size)
    assert (counts == np.bincount(np.concatenate(ids), minlength=size)).all()
    cell, n = lm._neighbour_counts(codes(3), kind, counts)
    plain = dict(zip(*map(np.ndarray.tolist, lm._neighbours(ids, *lm._around(counts)))))
    assert dict(zip(cell.tolist(), n.tolist())) == plain
    assert len(lm._drawn(ids[3].astype(np.int64), size, 1.0)[1]) == 3_001 // lm.STRIDE + 1
    last = lm._drawn(ids[3], size, 1.0)[1][-1].tolist()
    assert size in last and last[: last.index(size)] == ids[3][-last.index(size) :].tolist()
    one, two = (lm.learned(codes(n), PATH, len(rows), steps=10) for n in (1, 7))
    assert all(np.allclose(getattr(one, n), getattr(two, n), atol=1e-5) for n in (*lm._WEIGHTS, "share"))
    assert (one.kind_of == two.kind_of).all() and np.abs(one.u).max() < 10


def test_most_frequent_words_that_fit(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3)
    words = lambda *n: spark.createDataFrame([(f"w{i}".encode(), x) for i, x in enumerate(n)], "word binary, n long")
    found = lambda *n: sorted(r.n for r in lm._frequent(words(*n)).collect())
    assert found(5, 4, 4, 1, 1) == [4, 4, 5] and found(5, 4, 4, 4) == [5] and found(1, 1) == [1, 1] and found(2, 2, 2, 2) == [] and found() == []


def test_gradients():
    rng = np.random.default_rng(0)
    kinds = lm.OWN_INPUTS + lm.CLASSES + 2
    w = {n: rng.standard_normal((kinds, lm.DIM)) * 0.3 for n in ("q", "k", "v", "r")}
    w |= {"bias": rng.standard_normal(lm.WINDOW) * 0.1, "u": rng.standard_normal((lm.DIM, lm.CLASSES)) * 0.3, "u0": rng.standard_normal(lm.CLASSES)}
    c, goal = rng.integers(0, 20, (2, lm.WINDOW)), rng.integers(0, lm.CLASSES, (2, lm.STRIDE))
    c[0, :5], goal[1, -3:] = kinds - 1, -1
    distance = np.maximum(np.arange(lm.WINDOW - lm.STRIDE, lm.WINDOW)[:, None] - np.arange(lm.WINDOW)[None], 0)

    def loss():
        q, k, v = w["q"][c[:, lm.WINDOW - lm.STRIDE :]], w["k"][c], w["v"][c]
        a = q @ k.transpose(0, 2, 1) / math.sqrt(lm.DIM) + lm._mask(w["bias"])
        a = np.where((c == kinds - 1)[:, None], -1e9, a)
        p = np.exp(a - a.max(axis=2, keepdims=True))
        l = (p / p.sum(axis=2, keepdims=True)) @ v + w["r"][c[:, lm.WINDOW - lm.STRIDE :]]
        l = l @ w["u"] + w["u0"]
        l = l - l.max(axis=2, keepdims=True)
        l = l - np.log(np.exp(l).sum(axis=2, keepdims=True))
        return -np.mean([l[b, s, goal[b, s]] for b in range(2) for s in range(lm.STRIDE) if goal[b, s] >= 0])

    grads = lm._gradients(w, c, goal, distance)
    for n in w:
        at = np.unravel_index(np.abs(grads[n]).argmax(), w[n].shape)
        kept = w[n][at]
        w[n][at] = kept + 1e-3
        up = loss()
        w[n][at] = kept - 1e-3
        down = loss()
        w[n][at] = kept
        assert abs((up - down) / 2e-3 - grads[n][at]) < 1e-4 + 1e-2 * abs(grads[n][at]), n
