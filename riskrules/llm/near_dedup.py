"""Near-duplicate classes by tensored MinHash banding, confirmed on full shingle sets.

A document's set holds the hashes of its distinct windows of five words. Two small collections of
MinHash tuples are computed: 12 tuples of three hashes and 9 of two. A table key combines one tuple of
either collection, so 54 hashes serve 108 tables of five hashes. A pair at similarity 0.75 meets with
probability 0.998, one at 0.8 with 0.9998, unrelated texts hardly ever.

Documents with equal sets are one class from the start. Tuples that occur once are dropped before they
are combined. Every table cell names a hub, its member that meets most others; a hub and all members
of its cells form a group. Members are compared with their hub by a join. Where a member's component
then still differs from the hub's, it is compared with every member of the group, in blocks of bounded
size, and only links that join two components are given out. So all pairs that meet in a table are
decided exactly, while the rows written stay linear in the size of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.llm.common import chosen_rows, components, cut, keyed_texts, mixed, per_text, window_hashes, word_hashes
from riskrules.session import small

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
TUPLES = ((12, 3), (9, 2))  # (number of tuples, hashes in each) of the two collections
BLOCK_SHINGLES = 200_000  # shingles of a group that one task compares with as many


def shingle_set(text: bytes, hashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct window hashes of a whole text."""
    words = text.lower().split()
    return np.unique(window_hashes(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), width))


def _tuples(values: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For either collection the (documents, tuples) keys; ``starts`` are the sets' places in values."""
    seeds = mixed(np.arange(1, 200, dtype=np.uint64))
    out, k = [], 0
    for number, size in TUPLES:
        keys = np.empty((len(starts), number), np.uint64)
        for i in range(number):
            key = np.full(len(starts), seeds[-1 - i] + np.uint64(size), np.uint64)
            for _ in range(size):
                key = mixed(key * np.uint64(3) + np.minimum.reduceat(values * (seeds[k] | np.uint64(1)), starts))
                k += 1
            keys[:, i] = key
        out.append(keys.view(np.int64))
    return out


def _list(keys: np.ndarray) -> pa.Array:
    rows, width = keys.shape
    return pa.ListArray.from_arrays(np.arange(0, rows * width + 1, width, dtype=np.int32), keys.ravel())


def _signatures(batches) -> Iterator[dict]:
    import hashlib

    hashes = word_hashes()
    for ids, texts in batches:
        begin = 0
        while begin < len(ids):
            sets, size, end = [], 0, begin
            while end < len(ids) and size < 400_000:
                sets.append(shingle_set(texts[end], hashes))
                size += len(sets[-1])
                end += 1
            full = [s for s in sets if len(s)]
            if full:
                starts = np.cumsum([0] + [len(s) for s in full[:-1]])
                first, second = _tuples(np.concatenate(full), starts)
                yield {
                    "doc_id": [i for i, s in zip(ids[begin:end], sets) if len(s)],
                    "n_shingles": [len(s) for s in full],
                    "print": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in full],
                    "u": _list(first),
                    "v": _list(second),
                }
            bare = [i for i, s in zip(ids[begin:end], sets) if not len(s)]
            if bare:
                nothing = [None] * len(bare)
                yield {"doc_id": bare, "n_shingles": [0] * len(bare), "print": nothing, "u": nothing, "v": nothing}
            begin = end


def _sets(batches) -> Iterator[dict]:
    hashes = word_hashes()
    for ids, texts in batches:
        for i in range(0, len(ids), 64):
            yield {"doc_id": ids[i : i + 64], "shingles": [shingle_set(t, hashes).view(np.int64) for t in texts[i : i + 64]]}


def _met(prints: DataFrame) -> DataFrame:
    """(hub, doc_id): every document with the hubs of the table cells that it shares with others."""
    one = lambda name, side: prints.select("doc_id", F.explode(name).alias("half"), F.lit(side).alias("side"))
    halves = one("u", 0).union(one("v", 1))
    shared = halves.groupBy("side", "half").agg(F.count("*").alias("n")).filter("n > 1").select("side", "half")
    own = halves.join(shared, ["side", "half"], "left_semi").groupBy("doc_id")  # 21 values a document at most
    own = own.agg(*[F.collect_list(F.when(F.col("side") == s, F.col("half"))).alias(n) for n, s in (("u", 0), ("v", 1))])
    combined = own.select("doc_id", "v", F.explode("u").alias("u1")).select("doc_id", "u1", F.explode("v").alias("v1"))
    keys = cut(combined.select("doc_id", F.xxhash64("u1", "v1").alias("key")))
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = cut(keys.join(counts, "key"))
    weight = members.groupBy("doc_id").agg(F.sum("n").alias("w"))
    hubs = members.join(weight, "doc_id").groupBy("key").agg(F.max(F.struct("w", "doc_id"))["doc_id"].alias("hub"))
    return members.select("key", "doc_id").join(hubs, "key").filter("hub != doc_id").select("hub", "doc_id").distinct()


def _similar(common, one, other):
    return 100 * common >= SIMILARITY_PERCENT * (one + other - common)


class _Index:
    """Sizes of intersections of one set with many, from postings."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate(sets) if sets else np.empty(0, np.int64)
        order = np.argsort(values, kind="stable")
        self.rows = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.values, self.starts, self.counts = np.unique(values[order], return_index=True, return_counts=True)

    def common(self, one: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.values, one)
        inside = at < len(self.values)
        at = at[inside][self.values[at[inside]] == one[inside]]
        n = self.counts[at]
        places = np.repeat(self.starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.rows[places], minlength=len(self.sizes))


def _links(block: pd.DataFrame) -> pd.DataFrame:
    """Links that join two components, between the two chunks of a block or inside its only one.

    A row with ``away`` false is in its hub's component; two such rows need no comparison.
    """
    first, second = block[block.chunk == block.ci.iloc[0]], block[block.chunk == block.cj.iloc[0]]
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    found = []
    for queries, targets in ((first, second), (second, first)):
        away = queries[queries.away]
        if targets.empty or away.empty:
            continue
        sets = [np.asarray(s, np.int64) for s in targets.shingles]
        index, ids, comps = _Index(sets), targets.doc_id.to_numpy(), targets.component.to_numpy()
        for doc, comp, one in zip(away.doc_id, away.component, away.shingles):
            one = np.asarray(one, np.int64)
            common = index.common(one)
            for i in np.flatnonzero(_similar(common, len(one), index.sizes) & (comps != comp)):
                x, y = root(comp), root(comps[i])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((doc, ids[i]))
        if block.ci.iloc[0] == block.cj.iloc[0]:
            break
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _rest(cells: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of a group of which one is not in the hub's component."""
    own = cells.select("hub").distinct().select("hub", F.col("hub").alias("doc_id"))
    label = labels.select(F.col("node").alias("doc_id"), "component")
    rows = cells.union(own).join(label, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    rows = rows.join(label.select(F.col("doc_id").alias("hub"), F.col("component").alias("main")), "hub", "left")
    rows = rows.withColumn("away", F.col("component") != F.coalesce("main", "hub")).join(sets.select("doc_id", "n"), "doc_id")
    rows = cut(rows.select("hub", "doc_id", "component", "away", "n"))
    groups = rows.groupBy("hub").agg(F.count("*").alias("members"), F.max("away").alias("open"), F.sum("n").alias("total"))
    groups = groups.filter("open AND members > 2").select("hub", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("chunks"))
    rows = rows.join(groups, "hub").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
    pair = F.expr("transform(sequence(0, chunks - 1), c -> struct(least(c, chunk) AS ci, greatest(c, chunk) AS cj))")
    rows = rows.withColumn("pair", F.explode(pair)).select("hub", "doc_id", "component", "away", "chunk", "pair.ci", "pair.cj")
    return rows.join(sets.select("doc_id", "shingles"), "doc_id").groupBy("hub", "ci", "cj").applyInPandas(_links, "a long, b long")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    A null or blank text has an empty set, is linked with nothing and kept. A text of fewer than five
    words is one shingle. Rows of one id are one document for links. A row without id has component
    null and is kept. Columns besides key and text are not read; an empty table gives no rows.
    """
    texts = keyed_texts(docs, key, text)
    prints = cut(per_text(texts, _signatures, "doc_id long, n_shingles long, print binary, u array<long>, v array<long>"))
    known = prints.filter("doc_id IS NOT NULL AND print IS NOT NULL")
    first = cut(known.groupBy("print").agg(F.min("doc_id").alias("first")))
    chosen = known.join(first.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
    cells = cut(_met(chosen))
    wanted = cut(cells.select("doc_id").union(cells.select("hub")).distinct())
    sets = cut(per_text(chosen_rows(texts, wanted), _sets, "doc_id long, shingles array<long>").withColumn("n", F.size("shingles")))
    left = sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("s1"))
    sizes = sets.select("doc_id", "n")
    hub_sizes = sizes.select(F.col("doc_id").alias("hub"), F.col("n").alias("n1"))
    near = cells.join(sizes, "doc_id").join(hub_sizes, "hub").filter(100 * F.least("n", "n1") >= SIMILARITY_PERCENT * F.greatest("n", "n1"))
    near = near.join(left, "hub").join(sets.select("doc_id", "shingles"), "doc_id")
    common = F.size(F.array_intersect("s1", "shingles"))
    starred = cut(near.filter(_similar(common, F.col("n"), F.col("n1"))).select(F.col("hub").alias("a"), F.col("doc_id").alias("b")))
    linked = starred.union(_rest(cells, components(starred), sets))
    repeated = known.join(first, "print").filter("doc_id != first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    label = components(linked.union(repeated))
    out = prints.select("doc_id", "n_shingles").join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _units(docs: DataFrame, key: str, text: str, unit: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a number per id and text, and (unit, id) of all rows; None where that is the id itself.

    Only ids that stand with different texts get other numbers: hashes of id and text, which are tried
    until no two texts share one and none is the id of other rows.
    """
    own = F.col(f"`{key}`").cast("long")
    body = F.struct(F.col(f"`{text}`").isNull(), F.sha2(F.col(f"`{text}`").cast("binary"), 256))
    ids = docs.select(own.alias("id")).filter("id IS NOT NULL")
    again = cut(ids.groupBy("id").count().filter("count > 1").select("id"))
    again = small(again, again.count(), 1)
    texts = docs.select(own.alias("id"), F.to_json(body).alias("body")).join(again, "id", "left_semi").distinct()
    texts = cut(texts)
    several = cut(texts.groupBy("id").count().filter("count > 1").select("id"))
    n = several.count()
    if not n:
        return docs.withColumn(unit, own), None
    pairs = cut(texts.join(small(several, n, 1), "id", "left_semi"))
    total = pairs.count()
    for seed in count():
        number = lambda i, b: F.xxhash64(F.lit(seed), i, b)  # noqa: B023, E731
        numbers = cut(pairs.select(number(F.col("id"), F.col("body")).alias("unit")).distinct())
        if numbers.count() == total and not ids.join(small(numbers, total, 1), F.col("id") == F.col("unit"), "left_semi").limit(1).count():
            break
    flag = several.select(F.col("id").alias(f"{unit}_of"))
    out = docs.join(small(flag, n, 1), own == F.col(f"{unit}_of"), "left")
    out = out.withColumn(unit, F.when(F.col(f"{unit}_of").isNull(), own).otherwise(number(own, F.to_json(body)))).drop(f"{unit}_of")
    return out, cut(out.select(F.col(unit).alias("doc_id"), own.alias("id")).distinct())


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, with all their columns.

    A row is judged by its own text: different texts under one id are different documents, and of a
    class the smallest id stays. Repeated rows of one id and text are one; rows without id all stay.
    """
    unit = "__unit"
    rows, known = _units(docs, key, text, unit)
    result = cut(classes(rows, unit, text))
    if known is None:
        gone = result.filter("NOT kept").select(F.col("doc_id").alias(unit)).distinct()
    else:
        members = result.filter("doc_id IS NOT NULL").select("doc_id", "component_id").distinct().join(known, "doc_id")
        members = cut(members)
        first = members.groupBy("component_id").agg(F.min(F.struct("id", "doc_id"))["doc_id"].alias("first"))
        gone = members.join(first, "component_id").filter("doc_id != first").select(F.col("doc_id").alias(unit))
    gone = cut(gone)
    # Up to a million ids are sent to the tasks; more are joined, which shuffles the texts.
    rest = rows.join(small(gone, gone.count(), 1), unit, "left_anti")
    again = result.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(unit))
    if not again.limit(1).count():
        return rest.select(*[f"`{c}`" for c in docs.columns])
    from pyspark.sql import Window

    twice = rest.join(again, unit, "left_semi")
    order = Window.partitionBy(unit).orderBy(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (key, text)], F.lit(0).alias("__none"))))
    one = twice.withColumn("__nth", F.row_number().over(order)).filter("__nth = 1").drop("__nth")
    return rest.join(again, unit, "left_anti").unionByName(one).select(*[f"`{c}`" for c in docs.columns])
