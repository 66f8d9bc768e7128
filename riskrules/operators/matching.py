"""Applying rule tables to data and checking them.

A rule set is small next to the data: it goes to the driver and comes back as a constant, as one
predicate for a handful of rules or as an array that each row is tested against. Counts per rule
come from cells of the table, so rows are never joined with rules.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.functions.measures import ratio, rounded
from riskrules.operators import ordered
from riskrules.operators.binning import edge_counts
from riskrules.session import small

# The comparison signs a rule text may use.
COMPARISONS = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b,
}
MAX_RULES_PER_PASS = 2000
# Meetings of cells and rules up to which counting by cells pays.
MAX_CELL_TESTS = 200_000_000


@dataclass(frozen=True)
class Rule:
    """Conditions (feature, op, threshold) that must all hold, within a day of life if one is given."""

    rule_id: int
    conditions: tuple[tuple[str, str, float], ...]
    maturity: int | None = None


def known_number(column: str) -> Column:
    """The value as a double, null for NaN: a comparison with it then counts as not met."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def compare(value: Column, op: str, limit: Column | float) -> Column:
    return F.coalesce(COMPARISONS[op](value, limit), F.lit(False))


def rule_predicate(rule: Rule, maturity_column: str = "matuirity_day") -> Column:
    tests = [compare(known_number(f), op, t) for f, op, t in rule.conditions]
    if rule.maturity is not None:
        tests.append(compare(F.col(maturity_column), "==", rule.maturity))
    return reduce(lambda a, b: a & b, tests)


def any_rule(rules: Sequence[Rule], maturity_column: str = "matuirity_day") -> Column:
    """One predicate: all conditions inside a rule, any of the rules. For a handful of rules."""
    if not rules:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [rule_predicate(r, maturity_column) for r in rules])


def to_driver(rule_table: DataFrame, order: Sequence[str | Column], limit: int = 100_000) -> list[Rule]:
    """A rule table (column ``conditions``) as rules numbered from 1 in a given order; an action."""
    rows = rule_table.orderBy(*order).select("conditions").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rules; raise the support first")
    return [Rule(i, tuple((c["feature"], c["op"], float(c["threshold"])) for c in r["conditions"])) for i, r in enumerate(rows, 1)]


def from_text(rule_texts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rules written as ``feature op number`` in several nullable columns, as a ``conditions`` array.

    Text that is not of that form (a rate, a count) is no condition.
    """
    def parsed(column: str) -> Column:
        parts = F.split(F.trim(F.col(column)), r"\s+")
        good = (F.size(parts) == 3) & F.get(parts, 1).isin(list(COMPARISONS)) & F.get(parts, 2).try_cast("double").isNotNull()
        item = F.struct(F.get(parts, 0).alias("feature"), F.get(parts, 1).alias("op"), F.get(parts, 2).try_cast("double").alias("threshold"))
        return F.when(good, item)

    items = F.array(*[parsed(c) for c in columns])
    return rule_texts.withColumn("conditions", F.filter(items, lambda x: x.isNotNull()))


def from_wide(wide: DataFrame, thresholds: Sequence[str], op: str = ">") -> DataFrame:
    """Rules as rows with one nullable threshold per feature, as a ``conditions`` array."""
    items = F.array(
        *[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("feature"), F.lit(op).alias("op"), F.col(c).cast("double").alias("threshold"))) for c in thresholds]
    )
    return wide.withColumn("conditions", F.filter(items, lambda x: x.isNotNull()))


def matrix_text(matrix: DataFrame, flags: Sequence[str], key: str) -> DataFrame:
    """Rows of booleans to ``(a & b)`` each; rows without a true flag give null."""
    names = F.filter(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags]), lambda x: x.isNotNull())
    text = F.when(F.size(names) > 0, F.concat(F.lit("("), F.array_join(names, " & "), F.lit(")")))
    return matrix.select(key, text.alias("condition_text"))


def union_text(texts: DataFrame, key: str) -> DataFrame:
    """The whole rule matrix as one text, ``False`` when it has no condition. Rule tables are small."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col("condition_text").alias("t"))))
    joined = F.array_join(F.filter(F.transform(lines, lambda x: x["t"]), lambda t: t.isNotNull()), " | ")
    return texts.agg(F.coalesce(F.nullif(joined, F.lit("")), F.lit("False")).alias("condition_text"))


def rule_hits(df: DataFrame, rules: Sequence[Rule], maturity_column: str | None = None) -> DataFrame:
    """``df`` with ``rule_ids``, the numbers of the rules each row meets.

    The rules are a constant array: the plan does not grow with their number.
    """
    features = sorted({f for r in rules for f, _, _ in r.conditions})
    place = {f: i for i, f in enumerate(features)}
    signs = list(COMPARISONS)
    constant = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("id"),
                F.lit(r.maturity).cast("int").alias("maturity"),
                F.array(
                    *[
                        F.struct(F.lit(place[f]).alias("f"), F.lit(signs.index(op)).alias("op"), F.lit(float(t)).alias("t"))
                        for f, op, t in r.conditions
                    ]
                ).alias("cs"),
            )
            for r in rules
        ]
    )
    values = F.array(*[known_number(f) for f in features])
    based = df.withColumn("_values", values)

    def holds(c: Column) -> Column:
        v = F.get(F.col("_values"), c["f"])
        test = F.lit(False)
        for i, sign in enumerate(signs):
            test = F.when(c["op"] == i, COMPARISONS[sign](v, c["t"])).otherwise(test)
        return F.coalesce(test, F.lit(False))

    def met(r: Column) -> Column:
        in_day = F.lit(True)
        if maturity_column is not None:
            in_day = r["maturity"].isNull() | F.coalesce(r["maturity"] == F.col(maturity_column), F.lit(False))
        return in_day & F.forall(r["cs"], holds)

    ids = F.transform(F.filter(constant, met), lambda r: r["id"])
    return based.withColumn("rule_ids", ids).drop("_values")


def per_rule(
    df: DataFrame, rules: Sequence[Rule], label: str, maturity_column: str | None = None, rules_per_pass: int = MAX_RULES_PER_PASS
) -> DataFrame:
    """Rows, positives and rate of every rule on any table; a rule that no row meets has n = 0 and no rate.

    Rules of up to three features are counted from the cells their thresholds cut the table into:
    a row adds to one cell per set of features, whatever the number of rules. Longer rules, and
    sets of features with too many cells, are tested row by row, as many rules at a time as fit
    one constant.
    """
    short, long = _by_size(rules)
    parts = [_counted_by_cells(df, short, label, maturity_column)] if short else []
    for start in range(0, len(long), rules_per_pass):
        hit = rule_hits(df, long[start : start + rules_per_pass], maturity_column)
        met = hit.select(F.col(label).alias("_y"), F.explode("rule_ids").alias("rule_id"))
        parts.append(met.groupBy("rule_id").agg(F.count("*").alias("n"), F.sum("_y").alias("positives")))
    every = df.sparkSession.createDataFrame([(r.rule_id,) for r in rules], "rule_id int")
    whole = every.join(reduce(DataFrame.unionByName, parts), "rule_id", "left") if parts else every.withColumn("n", F.lit(0)).withColumn("positives", F.lit(0))
    whole = whole.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "positives")})
    return whole.withColumn("rate", F.when(F.col("n") > 0, F.col("positives") / F.col("n")))


def _by_size(rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    """Rules to count from cells, and rules to test row by row."""
    sets: dict[tuple, list[Rule]] = {}
    for r in rules:
        sets.setdefault(tuple(sorted({f for f, _, _ in r.conditions})), []).append(r)
    edges: dict[str, set] = {}
    for r in rules:
        for f, op, t in r.conditions:
            edges.setdefault(f, set()).add((op in (">", "<="), t))
    short, long = [], []
    for features, members in sets.items():
        cells = math.prod(len(edges[f]) + 2 for f in features)
        (short if len(features) <= 3 and cells * len(members) <= MAX_CELL_TESTS else long).extend(members)
    return short, long


def _bounds(op: str, t: float) -> tuple[float | None, float | None]:
    """A comparison as (strictly above, not above), on the double just below ``t`` where it must include ``t``."""
    before = math.nextafter(t, -math.inf)
    return {">": (t, None), ">=": (before, None), "<=": (None, t), "<": (None, before), "==": (before, t)}[op]


def _counted_by_cells(df: DataFrame, rules: Sequence[Rule], label: str, maturity_column: str | None) -> DataFrame:
    sets = sorted({tuple(sorted({f for f, _, _ in r.conditions})) for r in rules})
    edges: dict[str, set[float]] = {}
    for r in rules:
        for f, op, t in r.conditions:
            edges.setdefault(f, set()).update(b for b in _bounds(op, t) if b is not None)
    ordered = {f: sorted(ts) for f, ts in edges.items()}
    features = sorted(ordered)
    # The day as it is, as in ``rule_hits``: day 3.5 is no row of a rule for day 3.
    day = F.col(maturity_column).cast("double") if maturity_column is not None else F.lit(None).cast("double")
    # Bucket: number of edges below the value, -1 when it is unknown.
    counted = edge_counts(df, ordered)
    buckets = F.array(*[F.when(known_number(f).isNull(), -1).otherwise(F.col(f"{f}_above")) for f in features])
    spots = F.array(
        *[
            F.struct(F.lit(i).alias("s"), *[F.lit(features.index(c[k]) if k < len(c) else -1).alias(f"p{k}") for k in range(3)])
            for i, c in enumerate(sets)
        ]
    )
    base = counted.select(F.col(label).alias("_y"), day.alias("day"), buckets.alias("_b")).select("_y", "day", "_b", F.inline(spots))
    at = [F.when(F.col(f"p{k}") >= 0, F.get("_b", F.col(f"p{k}"))).alias(f"b{k}") for k in range(3)]
    cells = base.select("_y", "day", "s", *at).groupBy("s", "day", "b0", "b1", "b2").agg(F.count("*").alias("n"), F.sum("_y").alias("p"))

    # A rule is a range of buckets per feature; cells and rules meet on the set of features.
    rows = []
    for r in rules:
        names = tuple(sorted({f for f, _, _ in r.conditions}))
        low, high = {f: 0 for f in names}, {f: len(ordered[f]) for f in names}
        for f, op, t in r.conditions:
            over, upto = _bounds(op, t)
            if over is not None:
                low[f] = max(low[f], ordered[f].index(over) + 1)
            if upto is not None:
                high[f] = min(high[f], ordered[f].index(upto))
        spans = [(low[f], high[f]) for f in names] + [(None, None)] * (3 - len(names))
        rows.append((r.rule_id, sets.index(names), r.maturity if maturity_column is not None else None, *[x for span in spans for x in span]))
    schema = "rule_id int, s int, only_day int, " + ", ".join(f"l{k} int, h{k} int" for k in range(3))
    spans = small(df.sparkSession.createDataFrame(rows, schema), len(rows), 9)
    inside = reduce(lambda a, b: a & b, [F.col(f"l{k}").isNull() | F.col(f"b{k}").between(F.col(f"l{k}"), F.col(f"h{k}")) for k in range(3)])
    in_day = F.col("only_day").isNull() | (F.col("only_day") == F.col("day"))
    met = cells.join(spans, "s").filter(inside & F.coalesce(in_day, F.lit(False)))
    return met.groupBy("rule_id").agg(F.sum("n").alias("n"), F.sum("p").alias("positives"))


def rule_set_rates(tables: Mapping[str, DataFrame], predicate: Column, label: str) -> DataFrame:
    """Rows and rate, overall and where the rule set holds, for several tables (train, test, new)."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n"),
            F.avg(label).alias("rate"),
            F.count_if(predicate).alias("hit_n"),
            F.sum(F.when(predicate, F.col(label))).alias("hit_positives"),
            F.avg(F.when(predicate, F.col(label))).alias("hit_rate"),
        ).withColumn("lift", ratio(F.col("hit_rate"), F.col("rate")))

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def check(df: DataFrame, predicate: Column, label: str) -> DataFrame:
    """Rows, positives, negatives and rate under a hand-written rule."""
    kept = df.filter(predicate)
    return kept.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(label), F.lit(0)).alias("positives"),
        F.coalesce(F.sum(F.col(label) - 1), F.lit(0)).alias("minus_negatives"),
        F.avg(label).alias("rate"),
    )


def coverage(rule_table: DataFrame, order: Sequence[Column], n: str = "n", positives: str = "positives") -> DataFrame:
    """Share of rows and positives per rule and running down the list.

    Shares are of the rules' own totals, as rules may overlap. The order must be complete. An action.
    """
    totals = rule_table.agg(F.sum(n).alias("n"), F.sum(positives).alias("p"))
    all_n, all_p = totals.select("n").scalar(), totals.select("p").scalar()
    rows, hits = F.coalesce(n, F.lit(0)), F.col(positives)
    upto = ordered.running_over_all(rule_table, order, {"_rows_upto": rows, "_hits_upto": hits})
    shares = upto.withColumns(
        {
            "payers_covered": ratio(rows, all_n),
            "payers_covered_to_point": rounded(ratio(F.col("_rows_upto"), all_n), 4),
            "disputes_covered": rounded(ratio(hits, all_p), 5),
            "disputes_covered_to_point": rounded(ratio(F.col("_hits_upto"), all_p), 3),
        }
    )
    return shares.drop("_rows_upto", "_hits_upto")


def best_per_group(rule_table: DataFrame, group: str, order: Sequence[Column], count: int = 3) -> DataFrame:
    ranks = Window.partitionBy(group).orderBy(*order)
    return rule_table.withColumn("position", F.row_number().over(ranks)).filter(F.col("position") <= count)


def data_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """How many rows fail each check, in one pass."""
    return df.agg(F.count("*").alias("rows_checked"), *[F.count_if(c).alias(n) for n, c in checks.items()])


def non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where none of the columns is negative; null is not negative but is dropped with them."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in columns]))


def without_value(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())
