"""Url verdicts and licence scans against their SQL, on odd rows; mixing against a plain loop."""

import math
import random
from collections import defaultdict

import pytest
from conftest_rows import compared

from riskrules.llm import licenses, mixing, url_filter
from riskrules.llm.common import prepared, table

URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?y#z", "x://example.com", "x://example.com?/en/", "x://www.example.com/en/1", "x://a.www.example.com/en/", "x://notexample.com/en/",
    "x://example.com/en", "x://net/es/", "x://a.net/fr/x", "x://a.net/de/x", "x://b.org/free-bet", "x://b.org/freebet", "x://b.org/free/free", "x://b.org/xxx", "x://b.org/xxxx", "porn no scheme",
    "x://b.org/a?q=cheap#pills", "x://É.org/écasino", "a://b://c.net/es/", "x://:80/en/", "x://user@b.com:8/x", "x://b.org/" + "free " * 20_000, "x://CASINO.org", "x://.com/", "x://com/", "x://b.org/win_bonus",
    "http://bank.com.org/loan/loans", "x://b.org/bets-betting", "x://b.org/adult-education", "x://b.org/adults/cheap", "x://b.org/porno",
]


def test_urls(spark):
    prepared(spark)
    rows = [(i, u, "<html>", 1) for i, u in enumerate(URLS)] + [(None, "x://a.com/", None, 1), (3, "x://a.com/", None, 1), (3, "x://a.com/", None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict int").repartition(2)
    compared(url_filter.judged(pages), url_filter.oracle(), pages=pages.select("page_id", "url"))
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_forms_count_once():
    terms = url_filter.Terms(url_filter.STRICT, url_filter.SOFT, url_filter.LIMIT)
    weigh = lambda url: sum(terms.weights[t] for t in terms.met(url))
    assert weigh("http://bank.com/loan/loans") == 1 and weigh("x://a/adult-education") == 1 and weigh("x://a/bet/win") == 2 and weigh("x://a/casinos") == 2


def test_broken_url_is_defined(spark):
    prepared(spark)
    (found,) = url_filter.judged(spark.sql("SELECT 1L AS page_id, CAST(x'783A2F2FFF2E636F6D2F' AS string) AS url")).collect()
    assert (found.rule, found.verdict) == ("com/", "allow")


def test_longest_rule_wins():
    rules = url_filter.Rules([("allow", "com/"), ("block", "a.com/x/"), ("allow", "a.com/x/y"), ("block", "b.a.com/")])
    assert rules.best("a.com", "/x/yz") == ("a.com/x/y", "allow") and rules.best("b.a.com", "/x/") == ("b.a.com/", "block")
    assert rules.best("ba.com", "/x/") == ("com/", "allow") and rules.best("a.org", "/") is None and rules.best("", "") is None


def test_licences(spark, docs_of, sentences):
    full = [" ".join(t.words) for t in licenses.TEMPLATES + licenses.BASE]
    rows = [(i, f"{sentences(20)}. {t.upper()}!") for i, t in enumerate(full)]
    rows += [(100 + i, f"{' '.join(t.key)}") for i, t in enumerate(licenses.TEMPLATES)]  # key phrase at the very start
    rows += [(200, "MIT-License; mit\nlicense mit license"), (201, "mit the license"), (202, None), (203, ""), (204, "...  "), (205, "ÉÀ9 é"), (206, "license mit"), (None, "MIT License")]
    rows += [(300, "x cc by 4 0"), (301, "licensed within cc by 4 0"), (302, "permission is hereby granted free of charge to any one who reads a sentence")]  # key phrases without enough of the rest
    rows += [(207, "mit " * 40_000 + "license"), (208, "GNU General   Public\tLicense version 3"), (209, "cc by nc 4.0 cc by 4.0"), (5, "mit license"), (5, "mit license")]
    docs = docs_of(rows, extra=("words", "found", "t0", "score", "labels"))
    compared(licenses.scanned(docs).drop("spans"), licenses.oracle(), documents=docs.select("doc_id", "text"))
    by = {r.doc_id: r for r in licenses.scanned(docs).collect()}
    assert by[200].n_base == 3 and by[200].first_word == 0 and by[207].first_word == 39_999 and by[202].labels == "" and by[206].score == 0
    assert by[3].labels == "gpl,gpl-3.0" and by[3].score == 1.0 and by[3].spans
    assert by[300].labels == "" and by[301].labels == "cc-by-4.0" and by[302].labels == "" and 0.8 < by[301].score < 1
    assert licenses.scanned(docs.limit(0)).count() == 0
    none = licenses.scanned(docs.filter("doc_id BETWEEN 202 AND 205"))
    assert {r.labels for r in none.collect()} == {""} and none.count() == 4


def filled(sizes, weights, epochs=3):
    """Targets by the plain procedure: clamp, share the excess, repeat."""
    goal = {s: sum(sizes.values()) * weights[s] / sum(weights.values()) for s in sizes}
    for _ in range(len(sizes) + 1):
        over = sum(max(0.0, goal[s] - epochs * sizes[s]) for s in sizes)
        goal = {s: min(goal[s], epochs * sizes[s]) for s in sizes}
        rest = [s for s in sizes if goal[s] < epochs * sizes[s]]
        for s in rest:
            goal[s] += over * weights[s] / sum(weights[r] for r in rest)
    return goal


@pytest.mark.parametrize("seed", range(2))
def test_mix(spark, docs_of, sentences, seed):
    rng, rows = random.Random(seed), []
    sources = [("a", 300), ("B", 40), ("é", 80), ("", 5), (None, 60), ("zz", 3), ("~", 1)]
    for source, n in sources:
        rows += [(len(rows) + i, " ".join("w" * rng.choice([1, 1, 1, 3])) + " x" * rng.randint(0, 60), "en", source, 0) for i in range(n)]
    rows += [(9000, None, None, "a", None), (9001, " \n", None, "empty", None), (None, "no id", None, "a", 0), (9002, "same row", None, "a", 0), (9002, "same row", None, "a", 0)]
    docs = docs_of(rows, extra=("size", "draw", "target", "whole", "row"))
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    sizes, of = defaultdict(int), {r[0]: r[3] for r in rows}
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    goal = filled(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    taken = defaultdict(int)
    for r in found:
        source = of[r.doc_id]
        taken[source] += r.taken
        assert r.source_size == sizes[source] and math.isclose(r.target, goal[source], abs_tol=1e-6) and 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - goal[s]) <= max(2, 0.01 * goal[s]) for s in sizes)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.taken)
    assert sorted(map(key, found)) == sorted(map(key, mixing.mixed(docs.repartition(7)).collect()))
    again = mixing.repeated(docs)
    assert again.columns == docs.columns
    words = defaultdict(int)
    for r in again.collect():
        words[r.doc_id] += len((r.text or "").encode().split())
    total = defaultdict(int)
    for r in found:
        total[r.doc_id] += r.taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in total.items() if v}


def test_mix_of_little(docs_of):
    assert mixing.mixed(docs_of([])).count() == 0 and mixing.repeated(docs_of([])).count() == 0
    blank = docs_of([(1, None), (2, " ")])
    assert [r.taken for r in mixing.mixed(blank).collect()] == [0, 0] and mixing.repeated(blank).count() == 2


def test_no_text_comes_too_often(docs_of):
    """Sources at their cap: texts without words come no more often than others."""
    rows = [(i, "", "en", "a", 0) for i in range(40)] + [(100 + i, "w x", "en", "a", 0) for i in range(3)] + [(200 + i, "w " * 50, "en", "b", 0) for i in range(60)]
    times = defaultdict(int)
    for r in mixing.repeated(docs_of(rows)).collect():
        times[r.doc_id] += 1
    assert max(times.values()) <= 3


def test_mix_is_native(spark, folder):
    for df in (mixing.mixed(table(spark, folder, "documents")), licenses.scanned(table(spark, folder, "documents"))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
