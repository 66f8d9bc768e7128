"""Near-duplicate classes against all pairs compared by their full shingle sets."""

import random
from collections import Counter, defaultdict

import pytest

from riskrules.llm import near_dedup
from riskrules.llm.common import components, table


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """{id: smallest id reachable}; rows of one id are one document."""
    sets, where = [(d, shingles(t)) for d, t in rows if d is not None], defaultdict(list)
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, s) in enumerate(sets):
        common = Counter(j for x in s for j in where[x])
        for j, n in common.items():
            e, other = sets[j]
            if 100 * n >= 75 * (len(s) + len(other) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
        for x in s:
            where[x].append(i)
    return {d: root(d) for d in parent}


def edited(text, share, rng):
    return " ".join("zz" + str(rng.randint(0, 9999)) if rng.random() < share else w for w in text.split())


def test_given_documents_and_planted_groups(spark, folder, docs_of, sentences):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in table(spark, folder.replace("sf0.01", "sf0.001"), "documents").collect()]
    base, other = sentences(150), sentences(40)
    rows += [(1000 + i, edited(base, rng.choice([0.0, 0.005, 0.02, 0.05, 0.1]), rng)) for i in range(160)]  # a star of edits
    rows += [(2000 + i, sentences(60) + " " + other) for i in range(60)]  # a shared passage
    rows += [(3000, "One two"), (3001, "one  TWO"), (3002, "one two three"), (3003, " \t\n"), (3004, ""), (3005, None), (3006, "\u00a0")]
    rows += [(3100, sentences(30_000)), (3101, other), (3102, other.upper()), (3102, "one two")]
    found = near_dedup.classes(docs_of(rows)).collect()
    assert len(found) == len(rows)
    wanted = brute(rows)
    assert {r.doc_id: r.component_id for r in found} == wanted
    sizes = defaultdict(set)
    for d, t in rows:
        sizes[d].add(len(shingles(t)))
    assert all(r.n_shingles in sizes[r.doc_id] and r.kept == (r.component_id == r.doc_id) for r in found)
    assert wanted[3102] == 3000 and wanted[3003] == 3003  # linked by either of its rows; blank with nothing


def test_null_ids_stay_and_empty_table(docs_of):
    found = near_dedup.classes(docs_of([(None, "a b c d e f"), (None, None), (1, "a b c d e f")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in found) == [(-1, -1, True), (-1, -1, True), (1, 1, True)]
    assert near_dedup.classes(docs_of([])).count() == 0


def test_rows_that_stay_keep_their_columns(docs_of, sentences):
    text = sentences(80)
    rows = [(5, text), (4, text), (4, text), (6, text + " more"), (7, sentences(50)), (None, text)]
    docs = docs_of(rows, extra=("component_id", "kept", "n_shingles", "print", "hub"))
    out = near_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 4), (False, 7), (True, 0)]


def test_blocks_find_links_beyond_the_hub(spark, docs_of, sentences, monkeypatch):
    """Chains whose ends are not similar, compared in many small blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 500)
    rows, words = [], sentences(120).split()
    for i in range(60):
        words[i * 2 : i * 2 + 2] = [f"n{i}a", f"n{i}b"]
        rows.append((i, " ".join(words)))
    assert {r.doc_id: r.component_id for r in near_dedup.classes(docs_of(rows)).collect()} == brute(rows)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)]])
def test_components(spark, edges):
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == ({} if len(edges) < 2 else {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90})


def test_different_texts_of_one_id_both_stay(docs_of, sentences, monkeypatch):
    """Only a text that has a near copy goes, whatever else stands under its id."""
    one, two, three, four = (sentences(80) for _ in range(4))
    rows = [(1, one), (2, two), (2, three), (2, three), (3, one + " more"), (3, four), (4, three + " more")]
    rows += [(5, None), (5, sentences(50)), (6, ""), (6, sentences(50)), (7, two), (7, two + " more")]
    wanted = [(1, one), (2, two), (2, three), (3, four), *rows[7:11]]
    docs = docs_of(rows, extra=("component_id", "id", "unit"))
    out = near_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(wanted, key=repr)


def test_two_near_texts_of_one_id_leave_one(docs_of, sentences):
    text = sentences(80)
    out = near_dedup.deduplicated(docs_of([(9, text), (9, text + " more"), (9, sentences(60))])).collect()
    assert len(out) == 2 and {r.doc_id for r in out} == {9} and sum(r.text.startswith(text) for r in out) == 1
