"""One-, two- and three-condition rules over threshold indicators.

Indicators ``x > t`` for sorted thresholds are nested, so a rule's rows form a corner of a small
histogram. The data is read once: every row adds to one cell per feature combination, cells are
summed on the mapper, and at most (T+1)^k cells per combination are shuffled. Running sums along
each axis then give every rule, both sides of every condition, from the cells alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.functions.measures import ratio
from riskrules.operators import ordered
from riskrules.operators.binning import edge_counts
from riskrules.operators.matching import known_number
from riskrules.operators.quantiles import edge_table
from riskrules.session import cut, small

Combos = Sequence[tuple[str, ...]]


def feature_combinations(features: Sequence[str], size: int) -> list[tuple[str, ...]]:
    """Combinations of different features in canonical order."""
    return list(combinations(sorted(features), size))


def label_measures(label: str, amount: str | None = None, payment: str | None = None) -> dict[str, Column]:
    """What a rule is measured by: rows, positives and, if given, disputed amount and payment."""
    out = {"n": F.lit(1), "positives": F.col(label)}
    if amount:
        out["amount"] = F.col(amount)
    if payment:
        out["payment"] = F.col(payment)
    return out


def cells(df: DataFrame, thresholds: Mapping[str, Sequence[float]], combos: Combos, measures: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Histogram per combination: column ``combo`` (its number), buckets ``b1..bk`` and summed measures."""
    features = sorted({f for c in combos for f in c})
    counted = edge_counts(df, {f: thresholds[f] for f in features})
    base = counted.select(
        *by, F.array(*[F.col(f"{f}_above") for f in features]).alias("_b"), *[m.alias(n) for n, m in measures.items()]
    )
    size = len(combos[0])
    # The combinations are a constant: the row holds its buckets once and is read per combination.
    picks = F.array(
        *[F.struct(F.lit(i).alias("combo"), *[F.lit(features.index(f)).alias(f"p{k}") for k, f in enumerate(c, 1)]) for i, c in enumerate(combos)]
    )
    spread = base.select(*by, "_b", *measures, F.inline(picks))
    placed = spread.select(*by, "combo", *[F.get("_b", F.col(f"p{k}")).alias(f"b{k}") for k in range(1, size + 1)], *measures)
    return placed.groupBy(*by, "combo", *[f"b{k}" for k in range(1, size + 1)]).agg(*[F.sum(m).alias(m) for m in measures])


def grid(df: DataFrame, thresholds: Mapping[str, Sequence[float]], combos: Combos) -> DataFrame:
    """Every cell a combination can have, with the features' names and thresholds."""
    size = len(combos[0])
    rows = [(i, *c, *[[float(t) for t in thresholds[f]] for f in c]) for i, c in enumerate(combos)]
    schema = ", ".join(["combo int", *[f"f{k} string" for k in range(1, size + 1)], *[f"t{k} array<double>" for k in range(1, size + 1)]])
    table = df.sparkSession.createDataFrame(rows, schema)
    for k in range(1, size + 1):
        table = table.withColumn(f"b{k}", F.explode(F.sequence(F.lit(0), F.size(f"t{k}"))))
    return table


def rules(
    df: DataFrame,
    thresholds: Mapping[str, Sequence[float]],
    measures: Mapping[str, Column],
    size: int = 1,
    combos: Combos | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """All rules of ``size`` conditions on different features, both sides of each condition.

    Columns: ``conditions`` (array of feature, op, threshold), the measures and ``rate``. Rules
    that no row meets are left out, as a group-by would.
    """
    used = {f: list(ts) for f, ts in thresholds.items() if ts}
    combos = feature_combinations(list(used), size) if combos is None else [c for c in combos if all(f in used for f in c)]
    if not combos:
        raise ValueError("no combination of features has thresholds")
    counted = cells(df, used, combos, measures, by)
    axes = [f"b{k}" for k in range(1, size + 1)]
    where = grid(df, used, combos)
    if by:
        where = where.join(counted.select(*by, "combo").distinct(), "combo")
    # Absent cells count as zero, else the running sums would skip their thresholds.
    full = where.join(counted, [*by, "combo", *axes], "left").na.fill(0, list(measures))

    return _from_cells(full, size, list(measures), by)


def rules_by_group(df: DataFrame, features: Sequence[str], by: str, quantiles: int, measures: Mapping[str, Column]) -> DataFrame:
    """One-condition rules per value of ``by``, each group with bins of its own. An action for the edges.

    Edges and thresholds are tables of one row per group and feature, joined back to the rows.
    """
    features = sorted(features)
    edges = edge_table(df, features, quantiles, [by]).withColumnRenamed("column", "f1")
    items = F.array(*[F.struct(F.lit(f).alias("f1"), known_number(f).alias("_v")) for f in features])
    long = df.select(by, *[m.alias(n) for n, m in measures.items()], F.inline(items)).filter(F.col(by).isNotNull())

    def placed(table: DataFrame) -> DataFrame:
        """Rows with ``b1``, the number of the table's ``t1`` below the value."""
        below = F.size(F.filter("t1", lambda t: t < F.col("_v")))
        return long.join(small(table, table.count(), quantiles + 3), [by, "f1"]).withColumn("b1", F.when(F.col("_v").isNull(), 0).otherwise(below))

    inner = edges.select(by, "f1", F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0))).alias("t1"))
    filled = placed(inner).filter(F.col("_v").isNotNull()).select(by, "f1", "b1").distinct()
    lefts = filled.join(edges, [by, "f1"]).groupBy(by, "f1").agg(F.array_sort(F.collect_set(F.get("edges", F.col("b1")))).alias("ts"))  # at most ``quantiles``
    combo = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("f1")).cast("int").alias("combo")
    thresholds = cut(lefts.filter(F.size("ts") > 1).select(by, "f1", combo, F.expr("slice(ts, 1, size(ts) - 1)").alias("t1")))
    counted = placed(thresholds).groupBy(by, "f1", "b1").agg(*[F.sum(m).alias(m) for m in measures])
    where = thresholds.withColumn("b1", F.explode(F.sequence(F.lit(0), F.size("t1"))))
    full = where.join(counted, [by, "f1", "b1"], "left").na.fill(0, list(measures))
    return _from_cells(full, 1, list(measures), [by])


def _from_cells(full: DataFrame, size: int, measures: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rules from complete cells: along each axis in turn, the sum above a threshold and the rest."""
    axes = [f"b{k}" for k in range(1, size + 1)]
    fixed = [*by, "combo", *[f"f{k}" for k in range(1, size + 1)], *[f"t{k}" for k in range(1, size + 1)]]
    done: list[str] = []
    for axis in axes:
        others = [*by, "combo", *[a for a in axes if a != axis], *done]
        line = Window.partitionBy(*others)
        above = line.orderBy(F.col(axis).desc()).rowsBetween(Window.unboundedPreceding, 0)
        sums = full.select(
            *fixed, *axes, *done, *[F.sum(m).over(above).alias(f"_gt_{m}") for m in measures], *[F.sum(m).over(line).alias(f"_all_{m}") for m in measures]
        )
        side = f"s{axis[1:]}"
        high = F.struct(F.lit(">").alias(side), *[F.col(f"_gt_{m}").alias(m) for m in measures])
        low = F.struct(F.lit("<=").alias(side), *[(F.col(f"_all_{m}") - F.col(f"_gt_{m}")).alias(m) for m in measures])
        full = sums.filter(F.col(axis) >= 1).select(*fixed, *axes, *done, F.inline(F.array(high, low)))
        done.append(side)
    conditions = F.array(
        *[
            F.struct(F.col(f"f{k}").alias("feature"), F.col(f"s{k}").alias("op"), F.get(F.col(f"t{k}"), F.col(f"b{k}") - 1).alias("threshold"))
            for k in range(1, size + 1)
        ]
    )
    counts = [F.col(m).cast("long").alias(m) if m in ("n", "positives") else F.col(m) for m in measures]
    found = full.filter(F.col("n") > 0).select(*by, conditions.alias("conditions"), *counts)
    return found.withColumn("rate", F.col("positives") / F.col("n"))


def supported(found: DataFrame, positives: int, n: int = 0, rate: float = 0.0) -> DataFrame:
    return found.filter((F.col("positives") >= positives) & (F.col("n") >= n) & (F.col("rate") >= rate))


def candidates(found: DataFrame, positives: int, lift: float = 1.32) -> DataFrame:
    """Indicators with enough positives whose rate beats the mean of all rules' rates by ``lift``."""
    mean_rate = found.agg(F.avg("rate").alias("m")).scalar()
    return found.filter((F.col("positives") >= positives) & (F.col("rate") >= mean_rate * lift))


def columns_of(found: DataFrame) -> DataFrame:
    """The distinct indicators (feature, threshold) used by rules, whatever their side."""
    return found.select(F.explode("conditions").alias("c")).select("c.feature", "c.threshold").distinct()


def candidate_pairs(indicators: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pairs of indicators on different features, in canonical order.

    Pairs of features are listed first and joined to the indicators by feature, so no product of
    indicators is filtered afterwards.
    """
    pairs = indicators.sparkSession.createDataFrame(feature_combinations(features, 2), "feature_1 string, feature_2 string")
    first = indicators.select(F.col("feature").alias("feature_1"), F.col("threshold").alias("threshold_1"))
    second = indicators.select(F.col("feature").alias("feature_2"), F.col("threshold").alias("threshold_2"))
    return pairs.join(first, "feature_1").join(second, "feature_2")


def condition(number: int) -> Column:
    return F.get("conditions", number - 1)


def restricted(found: DataFrame, indicators: DataFrame, size: int) -> DataFrame:
    """Rules all of whose conditions use one of the given indicators."""
    allowed = indicators.select(F.col("feature").alias("_f"), F.col("threshold").alias("_t")).distinct()
    out = found
    for k in range(1, size + 1):
        out = out.join(allowed, (condition(k)["feature"] == F.col("_f")) & (condition(k)["threshold"] == F.col("_t")), "left_semi")
    return out


def _pair_key(a: int, b: int) -> list[Column]:
    return [condition(a)["feature"], condition(a)["threshold"], condition(b)["feature"], condition(b)["threshold"]]


def with_good_pairs(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples whose three pairs of indicators all belong to the given pair rules."""
    good = pairs.select(*[k.alias(f"_k{i}") for i, k in enumerate(_pair_key(1, 2))]).distinct()
    out = triples
    for a, b in ((1, 2), (1, 3), (2, 3)):
        on = [k == F.col(f"_k{i}") for i, k in enumerate(_pair_key(a, b))]
        out = out.join(good, on, "left_semi")
    return out


def condition_text(c: Column, digits: int = 4) -> Column:
    return F.concat_ws(" ", c["feature"], c["op"], F.format_string(f"%.{digits}f", c["threshold"]))


def as_columns(found: DataFrame, size: int, digits: int = 4) -> DataFrame:
    """Conditions as text columns ``column_1..k`` beside the measures."""
    texts = {f"column_{k}": condition_text(condition(k), digits) for k in range(1, size + 1)}
    return found.select(*[t.alias(n) for n, t in texts.items()], *[c for c in found.columns if c != "conditions"])


def compacted(wide: DataFrame, indicators: Sequence[str], measures: Sequence[str], size: int) -> DataFrame:
    """Sparse wide rows (one column per indicator, most null) to ``column_1..k`` of name and value."""
    used = F.filter(
        F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f"{c}_"), F.col(f"`{c}`").cast("string"))) for c in indicators]),
        lambda x: x.isNotNull(),
    )
    rows = wide.withColumn("_used", used).filter(F.size("_used") >= size)
    return rows.select(*[F.get("_used", k - 1).alias(f"column_{k}") for k in range(1, size + 1)], *measures)


def with_rule_measures(found: DataFrame, totals: DataFrame, uplift: float = 1.15) -> DataFrame:
    """Share of the disputed amount, pseudo dispute rate and lift.

    ``totals`` has one row with ``total_amount`` and ``base_rate``.
    """
    total = totals.select("total_amount").scalar()
    base = totals.select("base_rate").scalar()
    return found.withColumns(
        {
            "amount_share": ratio(F.col("amount"), total),
            "pseudo_dispute_rate": ratio(F.col("amount"), F.col("payment")) * uplift,
            "lift": ratio(F.col("rate"), base),
        }
    )


def top(found: DataFrame, positives: int, count: int, order: str = "rate") -> DataFrame:
    """The best rules with enough support, ties broken by the conditions."""
    return supported(found, positives).orderBy(F.desc(order), F.desc("n"), "conditions").limit(count)


def bottom(found: DataFrame, count: int, order: str = "rate") -> DataFrame:
    return found.orderBy(F.asc(order), F.asc("n"), F.desc("conditions")).limit(count)


def ranked(found: DataFrame, *keys: str) -> DataFrame:
    """Sorted descending by several keys, ties broken by the conditions."""
    return found.orderBy(*[F.desc(k) for k in keys], "conditions")


def slice_of(found: DataFrame, feature: str, op: str, position: int = 1) -> DataFrame:
    """Rules with a feature and side at a position, fewest rows first."""
    c = condition(position)
    return found.filter(c["feature"].contains(feature) & (c["op"] == op)).orderBy("n", "conditions")


def threshold_grid(pairs: DataFrame, first: str, second: str, ops: tuple[str, str] = (">", ">"), value: str = "rate") -> DataFrame:
    """Long form of the heat map of a feature pair: one row per (threshold, threshold)."""
    a, b = condition(1), condition(2)
    chosen = pairs.filter((a["feature"] == first) & (b["feature"] == second) & (a["op"] == ops[0]) & (b["op"] == ops[1]))
    return chosen.groupBy(a["threshold"].alias("threshold_1"), b["threshold"].alias("threshold_2")).agg(F.avg(value).alias(value))


def grid_matrix(long: DataFrame, thresholds: Sequence[float], value: str = "rate") -> DataFrame:
    """The heat map as a matrix, one column per threshold of the second feature."""
    return long.groupBy("threshold_1").pivot("threshold_2", [float(t) for t in thresholds]).agg(F.first(value))


def every_nth_value(found: DataFrame, column: str, step: int = 3) -> DataFrame:
    """Rows whose value is the first, fourth, seventh ... distinct value of a column of a rule table."""
    values = found.select(column).distinct()
    numbered = ordered.running_over_all(values, [F.col(column)], {"_r": F.lit(1)})
    kept = numbered.filter((F.col("_r") - 1) % step == 0).select(column)
    return found.join(kept, column, "left_semi")
