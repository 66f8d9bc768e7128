"""Toxicity scores: misspelt lexicon terms by Levenshtein automata, weighed by their context.

The lexicon is a given list of insults plus words and word beginnings learned from labelled rows. It is
kept as a trie; a word runs through the deterministic automaton of (trie node, edits so far) states,
whose transitions are made when first needed, so most words leave it after two or three letters. Given
terms and the strongest learned ones allow one edit from five letters on and two from nine; shorter and
weaker ones and beginnings none.

Every hit is weighed by the words around it: enclosing quotation marks and words of reporting lower it,
words of address raise it. Sums of weights, distinct terms and the share of hits feed a logistic score.

The fit reads a bounded sample of labelled rows (``SAMPLE_ROWS``), of copies and near copies (equal least
shingle hash) one, so that the words of one much copied text are no evidence. Scores are made of whole
texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.llm.common import Remembered, cut, doc_crc, kept_rows, keyed_texts, per_text, word_hashes
from riskrules.llm.near_dedup import shingle_set

# Given insults (fixed values); the rest is learned.
INSULTS = """idiot moron stupid loser trash scum pathetic worthless disgusting clown dumb fool jerk creep imbecile
idiota estúpido imbécil basura idiote imbécile ordure trottel dummkopf abschaum""".split()
# Words that report speech, and words that address somebody.
REPORTING = "said says say wrote writes called calls quote quoted quotes term word phrase dijo dice escribió dit écrit sagte sagt schrieb wort".split()
ADDRESS = "you your you're youre yours u ur du dich dir ihr tu te vous toi eres usted".split()
QUOTES = "\"'“”„‟«»‘’‹›`"
EDGES = QUOTES + ".,;:!?()[]{}<>…-–—_/\\|&%$#*=+~"
SAMPLE_ROWS = 20_000
MAX_TERMS = 2_000  # candidate terms that reach the driver, those of the strongest evidence
EVIDENCE = 20.0  # least G-statistic of a learned term
LEAST_ODDS = 2.0  # and its least log odds
NEAR_TERMS = 200  # learned terms that allow edits, the strongest
MAX_STATES = 30_000  # of the automaton, after which it starts anew
WINDOW = 6
BEGINNINGS = range(3, 7)


class Automaton:
    """The trie of a lexicon intersected with Levenshtein automata, made deterministic step by step."""

    def __init__(self, words: list[str], beginnings: list[str], exact: frozenset[str] = frozenset()):
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, tuple[str, int]] = {}  # node -> (term, edits allowed)
        self.opens: dict[int, str] = {}  # node of a beginning -> term
        self.allowed = [0]  # most edits allowed by a term at or below the node
        for term in sorted(set(words)):
            edits = 0 if len(term) < 5 or term in exact else 1 if len(term) < 9 else 2
            self.ends[self._add(term, edits)] = (term, edits)
        for term in sorted(set(beginnings)):
            self.opens[self._add(term, 0)] = term
        self._restart()

    def _restart(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.opened: list[str | None] = []
        self.start = self._state(self._closed({0: 0}))

    def _add(self, term: str, edits: int) -> int:
        node = 0
        self.allowed[0] = max(self.allowed[0], edits)
        for letter in term:
            node = self.children[node].setdefault(letter, len(self.children))
            if node == len(self.children):
                self.children.append({})
                self.allowed.append(0)
            self.allowed[node] = max(self.allowed[node], edits)
        return node

    def _closed(self, nodes: dict[int, int]) -> tuple:
        """With the nodes reached by leaving out letters of a term."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                edits = nodes[node] + 1
                if edits <= self.allowed[child] and edits < nodes.get(child, 99):
                    nodes[child] = edits
                    todo.append(child)
        return tuple(sorted(nodes.items()))

    def _state(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            ends = [(edits, self.ends[n][0]) for n, edits in state if n in self.ends and edits <= self.ends[n][1]]
            self.accepts.append(min(ends)[::-1] if ends else None)
            opens = [self.opens[n] for n, edits in state if n in self.opens and edits == 0]
            self.opened.append(opens[0] if opens else None)
        return self.numbers[state]

    def _step(self, number: int, letter: str) -> int:
        out: dict[int, int] = {}
        for node, edits in self.states[number]:
            if edits + 1 <= self.allowed[node] and edits + 1 < out.get(node, 99):
                out[node] = edits + 1
            for own, child in self.children[node].items():
                e = edits + (own != letter)
                if e <= self.allowed[child] and e < out.get(child, 99):
                    out[child] = e
        self.steps[number][letter] = to = self._state(self._closed(out))
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits): the word itself, else its longest beginning (with "-" at the end), else the nearest term."""
        if len(self.states) > MAX_STATES:
            self._restart()
        state, opened = self.start, None
        for letter in word:
            to = self.steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if not self.states[state]:
                return (opened + "-", 0) if opened else None
            opened = self.opened[state] or opened
        found = self.accepts[state]
        return found if found and (not opened or not found[1]) else (opened + "-", 0) if opened else None


def plain(token: bytes) -> str:
    """A token's letters: decoded, lower case, without marks at its edges."""
    return token.decode("utf-8", "replace").lower().strip(EDGES)


@dataclass(frozen=True)
class Model:
    terms: dict[str, float]  # weight of a term; beginnings end with "-"
    exact: frozenset[str]  # terms that allow no edit
    harmless: frozenset[str]  # spellings near a term that clean labelled rows use
    weights: tuple[float, ...]  # the constant first


def _context(tokens: list[bytes], at: int) -> float:
    """Between 0.1 and 1.3: low where the hit is quoted or reported, high where somebody is addressed."""
    around = [t.decode("utf-8", "replace") for t in tokens[max(0, at - WINDOW) : at + WINDOW + 1]]
    middle = min(at, WINDOW)
    before, after = around[: middle + 1], around[middle:]
    opened = any(t[:1] in QUOTES for t in before if t) and not any(t.rstrip(".,;:!?)")[-1:] in QUOTES for t in before[:-1] if t)
    closed = any(t.rstrip(".,;:!?)")[-1:] in QUOTES for t in after if t)
    words = {t.strip(EDGES) for t in around}
    weight = 1.0 - 0.7 * (opened and closed) - 0.2 * bool(words & set(REPORTING)) + 0.3 * bool(words & set(ADDRESS))
    return max(0.1, weight)


class Scanner:
    """Hits and features of whole texts."""

    def __init__(self, terms: dict[str, float], exact: frozenset[str]):
        automaton = Automaton([t for t in terms if t[-1] != "-"], [t[:-1] for t in terms if t[-1] == "-"], exact)
        self.terms, self.harmless = terms, frozenset()

        def look(token: bytes):
            word = plain(token)
            found = automaton.match(word) if word else None
            return found and (*found, word)

        self.look = Remembered(look, 50_000).__getitem__

    def hits(self, text: bytes) -> tuple[int, list[tuple[str, int, str, float]]]:
        """Number of tokens, and (term, edits, spelling, weight of term and context) per hit."""
        tokens = text.lower().split()
        found = list(map(self.look, tokens))
        if not any(found):
            return len(tokens), []
        met = [(i, f) for i, f in enumerate(found) if f and not (f[1] and f[2] in self.harmless)]
        return len(tokens), [(*f, self.terms[f[0]] * _context(tokens, i)) for i, f in met]

    def measured(self, n: int, hits: list) -> list[float]:
        """Features of a text of ``n`` tokens with these hits."""
        if not hits:
            return [0.0, 0.0, 0.0, 0.0]
        exact, near = (sum(w for _, e, _, w in hits if bool(e) == b) for b in (False, True))
        return [np.log1p(exact), np.log1p(near), np.log1p(sum({s: w for *_, s, w in hits}.values())), min(1.0, 10 * (exact + near) / n)]


_SCANNERS: dict[tuple, Scanner] = {}


def scanner(terms: dict[str, float], exact: frozenset[str], harmless: frozenset[str] = frozenset()) -> Scanner:
    """A worker's scanner of these terms; it keeps the last few, with the words that they remember."""
    key = (tuple(sorted(terms.items())), exact)
    if key not in _SCANNERS:
        while len(_SCANNERS) > 1:
            del _SCANNERS[next(iter(_SCANNERS))]
        _SCANNERS[key] = Scanner(terms, exact)
    _SCANNERS[key].harmless = harmless
    return _SCANNERS[key]


def _sketches(batches) -> Iterator[dict]:
    """The least shingle hash of each text; copies share it, near copies mostly."""
    hashes = word_hashes()
    for ids, texts in batches:
        yield {"doc_id": ids, "sketch": [int(s[0]) >> 1 if len(s := shingle_set(t, hashes)) else -1 for t in texts]}


def _terms(batches) -> Iterator[dict]:
    """Documents per word and word beginning, by mark (label, plus two in the second fold; in place of ids)."""
    counts = tuple(Counter() for _ in range(4))

    def out():
        keys = list(set().union(*counts))
        made = {"term": keys, **{f"n{m}": [c[k] for k in keys] for m, c in enumerate(counts)}}
        for c in counts:
            c.clear()
        return made

    for marks, texts in batches:
        for mark, text in zip(marks, texts):
            words = {w for w in map(plain, set(text.lower().split())) if w}
            counts[mark].update(words | {w[:k] + "-" for k in BEGINNINGS for w in words if len(w) > k})
        if sum(map(len, counts)) > 150_000:
            yield out()
    yield out()


def lexicon(terms: list[tuple[str, int, float]]) -> dict[str, float]:
    """Weights in (0, 1] of the terms kept among (term, toxic rows, log odds).

    A beginning is kept if it reaches well beyond its words, and gives way to a longer one that meets
    almost as many rows.
    """
    words = {t: n for t, n, _ in terms if t[-1] != "-"}
    opens = {t[:-1]: n for t, n, _ in terms if t[-1] == "-"}

    def stays(term: str) -> bool:
        start, n = term[:-1], opens[term[:-1]]
        best = max([m for w, m in words.items() if w.startswith(start)], default=0)
        return n >= 1.5 * best and not any(m >= 0.95 * n for o, m in opens.items() if len(o) > len(start) and o.startswith(start))

    return {t: min(1.0, (odds - LEAST_ODDS + 0.5) / 3.5) for t, _, odds in terms if t[-1] != "-" or stays(t)}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Newton steps on weighted rows with a ridge on all but the constant."""
    x, weight = np.column_stack([np.ones(len(x)), x]), weight / weight.sum()
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge @ w
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(mark, text) of a bounded sample of the labelled rows that may be learned from (crc32(id) mod 5 > 0);
    the mark is the label, plus two in the second of two folds, which copies share."""
    known = labels.select(F.col(key).cast("long").alias("doc_id"), (F.col(label).cast("int") > 0).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(doc_crc() % 5 != 0).groupBy("doc_id").agg(F.max("label").alias("label"))
    known = cut(known)
    share = SAMPLE_ROWS / max(1, known.count())
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # At most about SAMPLE_ROWS pairs of numbers are broadcast: 300 kB.
    rows = cut(keyed_texts(docs, key, text).join(F.broadcast(known), "doc_id"))
    sketches = per_text(rows.select("doc_id", "text"), _sketches, "doc_id long, sketch long")
    chosen = sketches.join(F.broadcast(known), "doc_id").groupBy("label", "sketch").agg(F.min("doc_id").alias("doc_id"))
    chosen = chosen.select("doc_id", (F.col("label") + 2 * F.pmod("sketch", F.lit(2))).cast("int").alias("mark"))
    return cut(rows.join(F.broadcast(chosen), "doc_id").select("mark", "text"))


def _learned(counts: DataFrame, sizes: dict[int, int], marks: tuple[int, ...]) -> tuple[dict[str, float], frozenset[str]]:
    """Terms with weights, and those that allow no edit, from the rows of some marks."""
    terms = dict.fromkeys(INSULTS, 1.0)
    size = [float(sum(sizes.get(m, 0) for m in marks if m % 2 == label)) for label in (0, 1)]
    if not all(size):
        return terms, frozenset()
    clean, toxic = (sum([F.col(f"n{m}") for m in marks if m % 2 == label], F.lit(0)) for label in (0, 1))
    both, share = clean + toxic, size[1] / sum(size)
    part = lambda n, p: F.when(n > 0, n * F.log(n / (both * p))).otherwise(0.0)
    g = 2 * (part(toxic, share) + part(clean, 1 - share))
    odds = F.log((toxic + 0.5) / (size[1] + 1)) - F.log((clean + 0.5) / (size[0] + 1))
    strong = counts.select("term", toxic.alias("toxic"), odds.alias("odds"), g.alias("g")).filter((F.col("g") >= EVIDENCE) & (F.col("odds") >= LEAST_ODDS))
    found = strong.orderBy(F.desc("g"), "term").limit(MAX_TERMS).select("term", "toxic", "odds").collect()
    learned = lexicon([tuple(r) for r in found])
    exact = frozenset([t for t in learned if t[-1] != "-" and t not in terms][NEAR_TERMS:])
    return learned | terms, exact


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Lexicon and weights from the labelled sample. Without both classes only the given insults count.

    The weights are fitted to features that each fold gets from the other's lexicon, as terms look better
    on the rows they were chosen by; the final lexicon is learned from both.
    """
    sample = labelled(docs, labels, key, text, label)
    sizes = {r.mark: r.n for r in sample.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    counts = per_text(sample, _terms, "term string, n0 long, n1 long, n2 long, n3 long")
    counts = cut(counts.groupBy("term").agg(*[F.sum(f"n{m}").alias(f"n{m}") for m in range(4)]).filter("n1 + n3 > 1"))
    terms, exact = _learned(counts, sizes, (0, 1, 2, 3))
    others = {0: _learned(counts, sizes, (2, 3)), 1: _learned(counts, sizes, (0, 1))}

    def seen(batches):
        look = scanner(terms, exact)
        near = Counter(), Counter()
        for marks, texts in batches:
            for mark, one in zip(marks, texts):
                near[mark % 2].update({w for _, e, w, _ in look.hits(one)[1] if e})
        keys = list(near[0].keys() | near[1].keys())
        yield {"word": keys, "clean": [near[0][k] for k in keys], "toxic": [near[1][k] for k in keys]}

    # Spellings within the edits of some term: as many as the sample's words near the lexicon.
    near = per_text(sample, seen, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = sum(sizes.get(m, 0) for m in (0, 2)) / max(1, sum(sizes.get(m, 0) for m in (1, 3)))
    harmless = frozenset(r.word for r in near.filter(F.col("clean") > F.col("toxic") * ratio / 10).orderBy(F.desc("clean"), "word").limit(100_000).collect())

    def measure(batches):
        for marks, texts in batches:
            rows = [None] * len(marks)
            for fold, lexicon_of in others.items():
                own = scanner(*lexicon_of, harmless)
                for i, (mark, one) in enumerate(zip(marks, texts)):
                    if mark // 2 == fold:
                        rows[i] = own.measured(*own.hits(one))
            yield {"label": [m % 2 for m in marks], **{f"f{k}": [float(r[k]) for r in rows] for k in range(4)}}

    rows = per_text(sample, measure, "label int, f0 double, f1 double, f2 double, f3 double").groupBy("label", "f0", "f1", "f2", "f3").count()
    found = np.array([tuple(r) for r in rows.collect()], float).reshape(-1, 6)
    found = found[np.lexsort(found.T)]
    found = np.repeat(found[:, :5], found[:, 5].astype(int), axis=0)
    y, x = (found[:, 0] > 0).astype(float), found[:, 1:]
    # The same insults misspelt: labelled rows have few, so half of a toxic row's weight counts with them.
    both = (y > 0) & (x[:, 0] > 0)
    misspelt = x[both][:, [1, 0, 2, 3]]
    # Without any hit a row is clean as far as this method sees; one row of each kind keeps the fit defined.
    x = np.vstack([x, misspelt, np.zeros((1, 4)), [[np.log1p(4), np.log1p(1), np.log1p(3), 0.5]]])
    y, weight = np.concatenate([y, np.ones(len(misspelt)), [0.0, 1.0]]), np.concatenate([np.where(both, 0.5, 1.0), np.full(len(misspelt), 0.5), [1.0, 1.0]])
    return Model(terms, exact, harmless, tuple(float(w) for w in _logistic(x, y, weight)))


def _probability(model: Model, features: list[float]) -> float:
    z = model.weights[0] + float(np.dot(model.weights[1:], features))
    return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, hits, terms) of every row; a null or empty text has no hits.

    ``terms`` are the distinct terms met, sorted. Repeated rows are scored each; ids may be null.
    """
    def work(batches):
        own = scanner(model.terms, model.exact, model.harmless)
        for ids, texts in batches:
            found = [own.hits(t) for t in texts]
            hits = [h for _, h in found]
            yield {
                "doc_id": ids,
                "score": [_probability(model, own.measured(n, h)) for n, h in found],
                "hits": [len(h) for h in hits],
                "terms": [sorted({t for t, *_ in h}) for h in hits],
            }

    return per_text(keyed_texts(docs, key, text), work, "doc_id long, score double, hits long, terms array<string>")


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` scored under 0.5, with all their columns."""
    model = fitted(docs, labels, key, text)

    def keep(batches):
        own = scanner(model.terms, model.exact, model.harmless)
        for texts in batches:
            yield [_probability(model, own.measured(*own.hits(t))) < 0.5 for t in texts]

    return kept_rows(docs, text, keep)
