"""Benchmark passages in documents, also edited ones: pigeonhole pieces, verified by Myers' distance.

A test item may differ by an error budget of single-byte edits. It is split into budget + 1 pieces; an
occurrence within the budget leaves at least one piece untouched, so every occurrence has an exact piece
hit. One Aho-Corasick automaton finds the pieces of all items in one run over a whole text. Around each
hit Myers' bit-parallel algorithm computes the least edit distance of the item to any part of the text.

Texts and items are compared as UTF-8 bytes with case folded in all scripts and ASCII punctuation and
blanks as one blank.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.llm.common import cut, kept_rows, keyed_texts, per_text

ERROR_SHARE = 0.08  # edits allowed as a share of the item's bytes
PIECE_BYTES = int(1 / ERROR_SHARE) // 2  # least piece that the share leaves; every hit is verified
BLOCK_BYTES = 4_000_000  # text of the items that one pass over the documents looks for

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    if not text.isascii():
        text = text.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")
    return b" ".join(text.translate(_PLAIN).split())


def budget(size: int) -> int:
    return int(size * ERROR_SHARE)


def pieces(item: bytes) -> list[tuple[int, bytes]]:
    """(offset, piece): the item in budget + 1 parts of nearly equal size."""
    n = budget(len(item)) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit vectors of one item: the least distance to any part of a text, and where it ends."""

    def __init__(self, item: bytes):
        self.item, self.size, self.limit = item, len(item), budget(len(item))
        self.masks = [0] * 256
        for i, c in enumerate(item):
            self.masks[c] |= 1 << i

    def best(self, text: bytes) -> tuple[int, int]:
        """(distance, end) with the first end of the least distance."""
        at = text.find(self.item)
        if at >= 0:
            return 0, at + self.size
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, distance, masks = full, 0, self.size, self.masks
        least, end = self.size, 0
        for j, c in enumerate(text):
            eq = masks[c]
            x = eq | down
            d0 = (((eq & up) + up) ^ up) | x
            hp = down | (full & ~(d0 | up))
            hn = up & d0
            if hp & top:
                distance += 1
            elif hn & top:
                distance -= 1
            hp, hn = (hp << 1) & full, (hn << 1) & full
            up, down = hn | (full & ~(d0 | hp)), hp & d0
            if distance < least:
                least, end = distance, j + 1
        return least, end


class Finder:
    """Occurrences of a block of items in whole texts."""

    def __init__(self, items: list[tuple[int, bytes]]):
        import ahocorasick

        self.patterns = [Pattern(i) for _, i in items]
        self.ids = [k for k, _ in items]
        of: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(items):
            for offset, piece in pieces(item):
                of.setdefault(piece.decode("latin-1"), []).append((n, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in of.items():
            self.automaton.add_word(piece, places)
        if of:
            self.automaton.make_automaton()

    def found(self, text: bytes) -> Iterator[tuple[int, int, int, list[tuple[int, int]]]]:
        """(item id, least distance, bytes, [(end, distance)] of its places) of every item that occurs."""
        text = plain(text)
        windows: dict[int, list[list[int]]] = {}
        if not self.patterns or not text:
            return
        for end, places in self.automaton.iter(text.decode("latin-1")):
            for n, offset in places:
                begin, p = end + 1 - offset, self.patterns[n]
                a, b = max(0, begin - p.limit), min(len(text), begin + p.size + p.limit)
                own = windows.setdefault(n, [])
                # Hits come in the order of their ends; windows of one occurrence overlap nearly whole.
                if own and abs(own[-1][2] - begin) <= p.limit:
                    own[-1][0], own[-1][1] = min(a, own[-1][0]), max(b, own[-1][1])
                else:
                    own.append([a, b, begin])
        for n, own in sorted(windows.items()):
            p = self.patterns[n]
            ends = {}
            for a, b, _ in own:
                distance, end = p.best(text[a:b])
                if distance <= p.limit:
                    ends[a + end] = min(distance, ends.get(a + end, distance))
            if ends:
                yield self.ids[n], min(ends.values()), p.size, sorted(ends.items())


def blocks(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, bytes]]]:
    """The test items in blocks of bounded size; null and blank texts are left out, null ids are not."""
    rows = items.select(F.col(key).cast("long").alias("k"), F.col(text).cast("binary").alias("t"))
    rows = rows.filter("t IS NOT NULL").distinct()
    block, size = [], 0
    for k, t in rows.sort("k", "t").toLocalIterator():
        t = plain(bytes(t))
        if t:
            block.append((k, t))
            size += len(t)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


_ROWS = "doc_id long, item_id long, distance long, item_bytes long, places array<struct<end: long, distance: long>>"


def _matches(texts: DataFrame, items: list[tuple[int, bytes]]) -> DataFrame:
    def work(batches):
        finder = Finder(items)
        kind = pa.list_(pa.struct([("end", pa.int64()), ("distance", pa.int64())]))
        for ids, bodies in batches:
            rows = [(i, *f) for i, t in zip(ids, bodies) for f in finder.found(t)]
            yield {
                "doc_id": [r[0] for r in rows],
                "item_id": [r[1] for r in rows],
                "distance": [r[2] for r in rows],
                "item_bytes": [r[3] for r in rows],
                "places": pa.array([[{"end": e, "distance": d} for e, d in r[4]] for r in rows], kind),
            }

    return per_text(texts, work, _ROWS)


def matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, item_bytes, places) of every document and item met within its budget.

    ``distance`` is the least of all places; a place is the end of an occurrence in the plain text. Null
    and blank texts and items meet nothing. Rows are reported each: a repeated document row repeats its
    matches; a null doc_id or item_id stays null. Repeated item rows count once; two texts under one item id give a
    row each. With several blocks each is a pass over the documents and written before the next.
    """
    texts, out = keyed_texts(docs, key, text), None
    for block in blocks(items, item_key, item_text):
        rows = _matches(texts, block)
        rows = rows if out is None and sum(len(t) for _, t in block) < BLOCK_BYTES else cut(rows)
        out = rows if out is None else out.union(rows)
    return out if out is not None else docs.sparkSession.createDataFrame([], _ROWS)


def without_items(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item occurs, with all their columns."""
    for block in blocks(items, item_key, item_text):

        def keep(batches, block=block):
            finder = Finder(block)
            for bodies in batches:
                yield [next(finder.found(t), None) is None for t in bodies]

        docs = kept_rows(docs, text, keep)
    return docs
