"""Url verdicts: allow and block rules by host and path, then a weighted vocabulary of url terms.

One Aho-Corasick automaton counts the terms of a url, with word boundaries on both sides (neither
neighbour is an ASCII letter or digit). A term is one or more forms, ``bet|bets``, that count as one. A
strict term weighs the whole limit, a soft one half of it; a url is rejected once its distinct terms reach
the limit, so by one strict or two different soft terms. The lists are parameters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.llm.common import per_text

# Fixed values of the published contract: (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
STRICT = ("porn|porno", "xxx", "viagra", "casino|casinos", "escort|escorts", "spam")
SOFT = (
    "adult|adults", "free", "bet|bets|betting", "win|wins|winner|winners", "cheap|cheapest", "pill|pills", "farm|farms", "poker", "dating", "loan|loans", "bonus|bonuses",
    "jackpot|jackpots", "hot|hottest", "click|clicks",
)
LIMIT = 2


def parts(url: str) -> tuple[str, str]:
    """(host, path) as the contract defines them."""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    host = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[host:]
    end = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return lowered(rest[:host]), path[:end]


def lowered(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


class Rules:
    """The longest rule that fits: its host is the url's or a parent, its path a beginning of the url's."""

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.of: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.of.setdefault(host, []).append((slash + path, rule, verdict))

    def best(self, host: str, path: str) -> tuple[str, str] | None:
        fits, labels = [], host.split(".")
        for i in range(len(labels)):
            for start, rule, verdict in self.of.get(".".join(labels[i:]), ()):
                if path.startswith(start):
                    fits.append((len(rule), verdict == "block", rule, verdict))
        return max(fits)[2:] if fits else None


class Terms:
    def __init__(self, strict: Sequence[str], soft: Sequence[str], limit: int):
        import ahocorasick

        self.limit, self.weights = limit, {**dict.fromkeys(soft, 1), **dict.fromkeys(strict, limit)}
        self.automaton = ahocorasick.Automaton()
        for term in self.weights:
            for form in term.split("|"):
                self.automaton.add_word(form, (term, len(form)))
        self.automaton.make_automaton()

    def met(self, url: str) -> set[str]:
        url = lowered(url)
        found = set()
        for end, (term, size) in self.automaton.iter(url):
            around = url[end - size : end - size + 1] if end >= size else "", url[end + 1 : end + 2]
            if not any(c.isascii() and c.isalnum() for c in around):
                found.add(term)
        return found


def judged(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, limit: int = LIMIT
) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_strict, n_soft) of every row.

    Without a fitting rule the vocabulary decides. A null url or one without ``://`` has empty host and
    path; a null url meets no term and is allowed. Bytes that are not UTF-8 count as the replacement mark. Of rules of one length a block wins. Repeated rows are
    judged each; ids may be null.
    """
    urls = pages.select(F.col(key).cast("long").alias("doc_id"), F.col(url).cast("binary").alias("text"))
    strong = set(strict)

    def work(batches) -> Iterator[dict]:
        table, terms = Rules(rules), Terms(strict, soft, limit)
        for ids, texts in batches:
            out: dict[str, list] = {n: [] for n in ("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft")}
            for i, data in zip(ids, texts):
                text = data.decode(errors="replace")
                host, path = parts(text)
                rule, met = table.best(host, path), terms.met(text)
                own = "block" if sum(terms.weights[t] for t in met) >= limit else "allow"
                for n, v in zip(out, (i, host, path, rule and rule[0], rule[1] if rule else own, len(met & strong), len(met - strong))):
                    out[n].append(v)
            yield out

    return per_text(urls, work, "page_id long, host string, path string, rule string, verdict string, n_strict long, n_soft long")


_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def oracle() -> str:
    """The same in SQL over ``pages``."""
    low = lambda e: f"translate({e}, '{_A}', '{_Z}')"
    met = lambda t: f"CAST(regexp_matches({low('u')}, '(^|[^a-z0-9])({t})($|[^a-z0-9])') AS BIGINT)"
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in RULES)
    return f"""
WITH p AS (SELECT row_number() OVER () AS n, page_id, coalesce(url, '') AS u FROM pages),
h AS (SELECT n, page_id, u, CASE WHEN contains(u, '://') THEN {low("regexp_extract(u, '://([^/?#]*)', 1)")} ELSE '' END AS host,
  CASE WHEN contains(u, '://') THEN regexp_extract(u, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM p),
r(v, rule, rh, rp) AS (VALUES {rules}),
f AS (SELECT n, max_by(rule, length(rule)) AS rule, max_by(v, length(rule)) AS v
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n),
t AS (SELECT *, {" + ".join(map(met, STRICT))} AS n_strict, {" + ".join(map(met, SOFT))} AS n_soft FROM h)
SELECT t.page_id, host, path, f.rule, coalesce(f.v, CASE WHEN n_strict * {LIMIT} + n_soft >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft
FROM t LEFT JOIN f ON t.n = f.n"""
