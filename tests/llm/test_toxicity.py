"""Automata against plain edit distance, contexts, and held-out accuracy."""

import random

from pyspark.sql import functions as F

from riskrules.llm import toxicity
from riskrules.llm.common import doc_crc, table
from riskrules.llm.toxicity import Automaton, Scanner


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (x != y)))
        line = new
    return line[-1]


def test_automaton_is_edit_distance():
    rng = random.Random(1)
    terms = ["abba", "abbabab", "babbabbab", "bbbaaab", "ababababab"]
    allowed = {t: 0 if len(t) < 5 else 1 if len(t) < 9 else 2 for t in terms}
    automaton = Automaton(terms, ["bbab"])
    for _ in range(4000):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        near = sorted((distance(word, t), t) for t in terms if distance(word, t) <= allowed[t])
        found = automaton.match(word)
        if word in terms:
            assert found == (word, 0)
        elif word.startswith("bbab"):
            assert found == ("bbab-", 0)
        else:
            assert (found is None) == (not near)
            assert found is None or (found[1], found[0]) == near[0]


def test_states_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_STATES", 50)
    automaton, rng = Automaton(["worthless", "disgusting"], []), random.Random(2)
    for _ in range(500):
        automaton.match("".join(rng.choice("wdiorsgthle") for _ in range(10)))
        assert len(automaton.states) < 120
    assert automaton.match("wortless") == ("worthless", 1)


def test_context_separates_quotation_from_abuse():
    scanner = Scanner(dict.fromkeys(toxicity.INSULTS, 1.0), frozenset())
    weight = lambda text: scanner.hits(text.encode())[1][0][3]
    assert weight("he said the word \"idiot\" is a quote") < weight("what an idiot that was") < weight("you are such an idiot today")
    assert scanner.hits("An IDIOT, stupidd and id1ot!".encode())[1][0][:2] == ("idiot", 0)
    assert [h[1] for h in scanner.hits("stupidd id1ot scums".encode())[1]] == [1, 1]


def test_held_out_accuracy(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fitted(docs, labels)
    found = toxicity.scored(docs, model).join(labels, "doc_id").filter(doc_crc() % 5 == 0)
    rows = found.select("toxic", (F.col("score") >= 0.5).cast("int").alias("predicted"), "score").collect()
    assert sum(r.toxic == r.predicted for r in rows) / len(rows) > 0.93
    assert not [r for r in rows if r.predicted and not r.toxic]
    again = toxicity.fitted(docs.repartition(5), labels)
    assert again == model


def test_odd_rows(spark, docs_of):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1)], "doc_id long, toxic int")
    rows = [(1, "idiot moron " * 4), (2, ""), (3, None), (None, "You idiot moron scum"), (4, "word " * 50_000), (1, "idiot moron " * 4)]
    docs = docs_of(rows, extra=("score", "label", "toxic", "predicted"))
    model = toxicity.fitted(docs, labels)
    found = toxicity.scored(docs, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    by = {r.doc_id: r for r in found}
    assert by[1].score > 0.5 and by[None].score > 0.5 and by[4].score == by[2].score == by[3].score < 0.5
    assert by[1].terms == ["idiot", "moron"] and by[1].hits == 8
    left = toxicity.without_toxic(docs, labels)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4]


def test_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fitted(docs_of([]), labels)
    assert toxicity.scored(docs_of([]), model).count() == 0
    assert toxicity.scored(docs_of([(1, "you idiot, moron, scum")]), model).first().score > 0.5
