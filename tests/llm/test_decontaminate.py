"""Myers' distance and the search against a plain dynamic program."""

import random

from riskrules.llm import decontaminate as d


def substring_distance(item, text):
    line = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (x != y)))
        line = new
    return min(line), line.index(min(line))


def test_bit_parallel_distance():
    rng = random.Random(4)
    for _ in range(300):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 90)))
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 150)))
        assert d.Pattern(item).best(text) == substring_distance(item, text)


def test_pieces_cover_the_item():
    for n in (1, 15, 31, 32, 100, 400):
        item = bytes(range(48, 58)) * 40
        parts = d.pieces(item[:n])
        assert b"".join(p for _, p in parts) == item[:n] and len(parts) == d.budget(n) + 1
        assert all(len(p) >= min(n, d.PIECE_BYTES) for _, p in parts)


def planted(sentences):
    rng = random.Random(9)
    items = [(i, sentences(rng.randint(12, 60))) for i in range(12)] + [(50, "short"), (51, ""), (52, None), (None, "no id here at all"), (0, None)]
    rows = []
    for i, (k, t) in enumerate(items[:12]):
        plain = list(t)
        for _ in range(d.budget(len(d.plain(t.encode())))):
            plain[rng.randrange(len(plain))] = "Q"
        rows.append((i, f"{sentences(30)} {t.upper()}!! {sentences(200)}"))
        rows.append((100 + i, f"{sentences(30)} {''.join(plain)} {sentences(20)}"))
        rows.append((200 + i, f"{sentences(30)} {t[: len(t) // 3]} {sentences(20)}"))
    return items, rows + [(300, "a Short text"), (301, None), (302, ""), (None, items[3][1]), (303, sentences(30_000) + items[4][1])]


def test_search_is_complete(spark, docs_of, sentences):
    items, rows = planted(sentences)
    table = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    docs = docs_of([*rows, rows[0]], extra=("item_id", "distance", "places"))
    found = d.matches(docs, table).collect()
    wanted = set()
    for doc, text in rows:
        for k, t in items:
            if k is not None and (plain := d.plain((t or "").encode())):
                body = d.plain((text or "").encode())[-60_000:]
                if len(body) > 20_000:
                    body = body[-2_000:]
                least = substring_distance(plain, body)[0]
                if least <= d.budget(len(plain)):
                    wanted.add((doc, k, least))
    assert {(r.doc_id, r.item_id, r.distance) for r in found} >= wanted
    # The long text was compared in part only; elsewhere the sets are equal.
    assert {x for x in ((r.doc_id, r.item_id, r.distance) for r in found) if x[0] != 303} == {x for x in wanted if x[0] != 303}
    assert all((i, i) in {(w[0], w[1]) for w in wanted} and (100 + i, i) in {(w[0], w[1]) for w in wanted} for i in range(12))
    assert sum(r.doc_id == 0 for r in found) == 2 * len({w for w in wanted if w[0] == 0})  # the repeated row
    assert all(p.distance <= d.budget(r.item_bytes) for r in found for p in r.places)
    left = d.without_items(docs, table)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {doc for doc, _ in rows} - {w[0] for w in wanted}


def test_blocks_and_empty_tables(spark, docs_of, sentences, monkeypatch):
    items, rows = planted(sentences)
    table = spark.createDataFrame(items, "item_id long, text string")
    docs, key = docs_of(rows), lambda r: (r.doc_id or -1, r.item_id, r.distance)
    whole = sorted(map(key, d.matches(docs, table).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 500)
    assert sorted(map(key, d.matches(docs, table).collect())) == whole
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.matches(docs, none).count() == 0 and d.without_items(docs, none).count() == len(rows)
    assert d.matches(docs_of([]), table).count() == 0


def test_budget_is_the_stated_share():
    assert [d.budget(n) for n in (12, 13, 25, 31, 81, 100, 146)] == [0, 1, 2, 2, 6, 8, 11]
    for n in range(1, 500):
        parts = [p for _, p in d.pieces(bytes(n))]
        assert sum(map(len, parts)) == n and len(parts) == n * 8 // 100 + 1 and min(map(len, parts)) >= min(n, d.PIECE_BYTES)


def test_passages_of_the_stated_share(spark, docs_of, sentences):
    """A replaced word, capitals of other scripts, short items and items without id; expectations are given, not computed."""
    long = "the quiet harbour keeps seven wooden boats behind its stone wall while people mend their nets and wait"
    accents = "ñandú y ciónñga óvalo señaló más íntima acción del otoño español según cada niño pequeño"
    items = [(1, long), (2, accents), (3, "purple elephants knit at dawn"), (None, "an item that nobody has numbered"), (5, "ΟΔΟΣ ΚΑΙ ΠΟΛΗ ΤΗΣ ΝΥΧΤΑΣ")]
    pad = sentences(40)
    rows = [
        (10, f"{pad} {long.replace('wooden', 'kayaks')} {pad}"),
        (20, f"{pad} {accents.upper()} {pad}"),
        (30, f"{pad} purple elephxnts knit at dawm {pad}"),
        (40, f"{pad} An item that NOBODY has numbered {pad}"),
        (50, f"{pad} οδος και πολη της νυχτας {pad}"),
        (60, f"{pad} {long.replace('wooden boats', 'rather small craft')} {pad}"),
        (70, pad),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows)
    assert {(r.doc_id, r.item_id) for r in d.matches(docs, table).collect()} == {(10, 1), (20, 2), (30, 3), (40, None), (50, 5)}
    assert {r.doc_id for r in d.without_items(docs, table).collect()} == {60, 70}


def test_bytes_of_two_texts_under_one_id(spark, docs_of, sentences):
    one, two = "seven wooden boats", "a much longer text that stands under the same id"
    table = spark.createDataFrame([(1, one), (1, two)], "item_id long, text string")
    found = d.matches(docs_of([(1, f"{sentences(9)} {one} {sentences(9)} {two}")]), table).collect()
    assert sorted(r.item_bytes for r in found) == [len(one), len(two)]
