"""Licence scans by a positional rare-token index, in DataFrame operations only.

A template is a licence sentence with a mandatory key phrase. Document frequencies of all template words
are counted first; the index keeps, for each template, its words of highest inverse document frequency
among those that occur at all, with their places. A file is looked up by these rare words only: each
occurrence proposes the start of the template relative to it, and a start counts only where the postings
of two rare words meet. A met start stands if the whole key phrase is there and a least share of the
template's words is found at their relative places.

The three base phrases are templates that consist of their key phrase.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words as the contract defines them: lower-case ASCII letters, digits and everything beyond ASCII.
_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
RARE_WORDS = 3  # looked up per template
AGREEING = 2  # of them must propose the same start
LEAST_SHARE = 0.75  # of a template's words, at their places
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    first: int  # place of the key phrase
    size: int  # and its number of words

    @classmethod
    def of(cls, label: str, text: str) -> Template:
        """The key phrase stands in brackets."""
        head, _, rest = text.partition("[")
        key, _, tail = rest.partition("]")
        return cls(label, tuple((head + key + tail).split()), len(head.split()), len(key.split()))

    @property
    def key(self) -> tuple[str, ...]:
        return self.words[self.first : self.first + self.size]


BASE = (
    Template.of("mit", "[mit license]"),
    Template.of("apache", "[apache license]"),
    Template.of("gpl", "[general public license]"),
)
# Sentences of public licences.
TEMPLATES = (
    Template.of("mit", "released under the [mit license]"),
    Template.of("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software"),
    Template.of("apache-2.0", "licensed under the [apache license version 2 0]"),
    Template.of("gpl-3.0", "this work is licensed under the gnu [general public license version 3]"),
    Template.of("gpl-2.0", "this work is licensed under the gnu [general public license version 2]"),
    Template.of("lgpl", "licensed under the gnu [lesser general public license]"),
    Template.of("agpl", "licensed under the gnu [affero general public license]"),
    Template.of("cc-by-4.0", "licensed under [cc by 4 0]"),
    Template.of("cc-by-sa-4.0", "licensed under [cc by sa 4 0]"),
    Template.of("cc-by-nc-4.0", "licensed under [cc by nc 4 0]"),
    Template.of("bsd", "[redistribution and use in source and binary forms] with or without modification are permitted"),
    Template.of("mpl-2.0", "subject to the terms of the [mozilla public license] version 2 0"),
)


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(plain, _GAP), lambda w: w != "")


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rarest(texts: DataFrame, templates: tuple[Template, ...]) -> dict[Template, tuple[int, ...]]:
    """For each template the places of the words that fewest documents have, of those that any has."""
    known = sorted({w for t in templates for w in t.words})
    own = texts.select(F.explode(F.array_intersect(F.col("words"), _literal(known))).alias("word"))
    counts = {r.word: r["count"] for r in own.groupBy("word").count().collect()}  # as many rows as template words
    met = {t: sorted((i for i, w in enumerate(t.words) if w in counts), key=lambda i: (counts[t.words[i]], i)) for t in templates}
    return {t: tuple(met[t][:RARE_WORDS]) for t in templates}


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", base: tuple[Template, ...] = BASE, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row.

    ``spans`` lists (label, start, words, share) of all standing proposals, starts counted in words from 0
    (the template's first word may lie before the text). A text without words has counts 0, no first and
    last word, empty labels and score 0. Repeated rows are scanned each; ids may be null.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), words(F.col(text)).alias("words"))
    every = tuple(dict.fromkeys(base + templates))
    rare = rarest(texts, every)
    anchors = sorted({t.words[i] for t in every for i in rare[t]})
    place = F.transform("words", lambda w, i: F.when(w.isin(anchors), F.struct(w.alias("w"), i.cast("int").alias("i"))))
    found = F.when(F.arrays_overlap("words", _literal(anchors)), F.array_compact(place)) if anchors else F.lit(None)
    rows = texts.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), F.coalesce(found, F.expr("CAST(array() AS array<struct<w:string,i:int>>)")).alias("found"))

    def met(t: Template) -> Column:
        """Starts on which the postings of rare words agree."""
        def posting(i: int) -> Column:
            return F.transform(F.filter("found", lambda f: f["w"] == t.words[i]), lambda f: f["i"] - i)

        lists = [posting(i) for i in rare[t]]
        if not lists:
            return F.expr("CAST(array() AS array<int>)")
        if len(lists) < AGREEING:
            return lists[0]
        return F.array_sort(reduce(F.array_union, [F.array_intersect(a, b) for a, b in combinations(lists, AGREEING)]))

    def share(t: Template, s: Column) -> Column:
        one = lambda j: F.coalesce((F.get("words", s + j) == t.words[j]).cast("int"), F.lit(0))
        return sum([one(j) for j in range(1, len(t.words))], one(0)) / F.lit(len(t.words))

    def standing(t: Template) -> Column:
        """Met starts where the key phrase and enough of the other words stand."""
        phrase = _literal(t.key)
        keyed = F.filter(met(t), lambda s: (s + t.first >= 0) & (F.slice("words", F.greatest(s + t.first + 1, F.lit(1)), t.size) == phrase))
        return keyed if t.size == len(t.words) else F.filter(keyed, lambda s: share(t, s) >= LEAST_SHARE)

    columns = [f"t{n}" for n in range(len(every))]
    rows = rows.select("doc_id", "n_words", "words", *[standing(t).alias(c) for t, c in zip(every, columns)])
    span = lambda t, c: F.transform(c, lambda s: F.struct(F.lit(t.label).alias("label"), s.alias("start"), F.lit(len(t.words)).alias("words"), share(t, s).alias("share")))
    own = dict(zip(every, columns))
    rows = rows.select("doc_id", "n_words", *columns, F.concat(*[span(t, own[t]) for t in templates]).alias("spans"))
    places = F.concat(*[own[t] for t in base])
    base_labels = F.array_compact(F.array(*[F.when(F.size(own[t]) > 0, F.lit(t.label)) for t in base]))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.transform("spans", lambda s: s["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.when(F.size(places) > 0, 1.0).otherwise(0.0)).alias("score"),
        "spans",
    )


def oracle() -> str:
    """The query's columns in SQL over ``documents``: words with positions, joined to the templates' words."""
    every = tuple(dict.fromkeys(BASE + TEMPLATES))
    words_of = ", ".join(f"({n}, {j}, '{w}', {t.first <= j < t.first + t.size})" for n, t in enumerate(every) for j, w in enumerate(t.words))
    names = ", ".join(f"({n}, '{t.label}', {t in BASE}, {t in TEMPLATES}, {len(t.words)}, {t.size})" for n, t in enumerate(every))
    joined = lambda which: f"coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE {which}), '')"
    return f"""
WITH w AS (SELECT n, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS l
  FROM (SELECT row_number() OVER () AS n, doc_id, text FROM documents)),
tw(t, j, word, key) AS (VALUES {words_of}),
tn(t, label, base, more, size, keys) AS (VALUES {names}),
p AS (SELECT n, pos, word FROM (SELECT n, unnest(l) AS word, unnest(range(0, len(l))) AS pos FROM w) WHERE word IN (SELECT word FROM tw)),
df AS (SELECT word, count(DISTINCT n) AS df FROM p GROUP BY word),
rare AS (SELECT t, j, tw.word FROM tw JOIN df USING (word) QUALIFY row_number() OVER (PARTITION BY t ORDER BY df, j) <= {RARE_WORDS}),
need AS (SELECT t, least({AGREEING}, count(*)) AS m FROM rare GROUP BY t),
met AS (SELECT n, rare.t, pos - j AS s FROM p JOIN rare USING (word) JOIN need ON need.t = rare.t GROUP BY 1, 2, 3 HAVING count(*) >= any_value(m)),
agreed AS (SELECT met.n, met.t, met.s, count(*) AS words, count(*) FILTER (WHERE key) AS key_words
  FROM met JOIN tw ON tw.t = met.t JOIN p ON p.n = met.n AND p.pos = met.s + tw.j AND p.word = tw.word GROUP BY 1, 2, 3),
hit AS (SELECT a.n, a.s, tn.*, words / CAST(size AS DOUBLE) AS share FROM agreed a JOIN tn USING (t) WHERE key_words = keys AND (keys = size OR words / CAST(size AS DOUBLE) >= {LEAST_SHARE})),
d AS (SELECT n, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
  {joined("base")} AS base_labels, {joined("true")} AS labels, coalesce(max(share) FILTER (WHERE more), 1.0) AS score FROM hit GROUP BY n)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN d USING (n)"""
