"""Bins, indicators, mined rules and rule tables, over line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskrules.functions import measures as m
from riskrules.operators import binning, mining
from riskrules.plans.registry import query, rd, rds, sql_rd

FEATURES = ["l_discount", "l_extendedprice", "l_quantity", "l_tax"]


def items(r):
    """Line items with a label that depends on quantity and discount, and the amounts of a rule."""
    hit = (F.col("l_returnflag") == "R") & (F.col("l_quantity") * F.col("l_discount") > 1.5)
    rows = r.table("lineitem").withColumn("label", hit.cast("int"))
    return rows.withColumns({"disputed": F.col("label") * F.col("l_extendedprice"), "payment": F.col("l_extendedprice")})


LABELLED = """
it AS (SELECT *, CASE WHEN l_returnflag = 'R' AND l_quantity * l_discount > 1.5 THEN 1 ELSE 0 END AS label, l_extendedprice AS payment FROM lineitem),
its AS (SELECT *, label * l_extendedprice AS disputed FROM it)"""


def _shares(q: int) -> str:
    return "[" + ", ".join(f"{i / q!r}e0" for i in range(q + 1)) + "]"


def edges_sql(q: int, features=FEATURES, source: str = "its") -> str:
    """Distinct edges, rows in long form with their bin's left edge, and the indicator thresholds."""
    edges = " UNION ALL ".join(f"SELECT '{f}' AS feature, list_sort(list_distinct(quantile_cont({f}, {_shares(q)}))) AS es FROM {source}" for f in features)
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS value, label, disputed, payment FROM {source}" for f in features)
    return f"""
edges AS ({edges}),
long AS ({long}),
binned AS (SELECT l.*, e.es[1 + len(list_filter(e.es[2:len(e.es) - 1], lambda x: x < l.value))] AS left_edge FROM long l JOIN edges e ON l.feature = e.feature),
lefts AS (SELECT DISTINCT feature, left_edge FROM binned),
th AS (SELECT feature, left_edge AS t FROM lefts x WHERE left_edge < (SELECT max(left_edge) FROM lefts y WHERE y.feature = x.feature))"""


def rules_sql(size: int, extra: str = "", features=FEATURES) -> str:
    """Every rule by brute force: each row against each combination of thresholds, grouped by the sides."""
    value = {f: f for f in features}
    parts = []
    from itertools import combinations

    for combo in combinations(sorted(features), size):
        keys = ", ".join(
            f"'{f}' AS feature_{k}, CASE WHEN {value[f]} > t{k}.t THEN '>' ELSE '<=' END AS op_{k}, t{k}.t AS threshold_{k}" for k, f in enumerate(combo, 1)
        )
        source = "its " + " ".join(f"JOIN th t{k} ON t{k}.feature = '{f}'" for k, f in enumerate(combo, 1))
        parts.append(f"SELECT {keys}, count(*) AS n, sum(label) AS positives, sum(disputed) AS amount, sum(payment) AS payment FROM {source} GROUP BY ALL")
    return f"""
rules{extra} AS (SELECT *, CAST(positives AS DOUBLE) / n AS rate FROM ({' UNION ALL '.join(parts)}))"""


def _keys_sql(size: int) -> str:
    return ", ".join(f"feature_{k}, op_{k}, {sql_rd(f'threshold_{k}', 4)} AS threshold_{k}" for k in range(1, size + 1))


_COUNTS = "CAST(n AS BIGINT) AS n, CAST(positives AS BIGINT) AS positives"


def flat(found, size: int, *more):
    """Conditions as plain columns, for comparison."""
    parts = []
    for k in range(1, size + 1):
        c = mining.condition(k)
        parts += [c["feature"].alias(f"feature_{k}"), c["op"].alias(f"op_{k}"), rd(c["threshold"], 4).alias(f"threshold_{k}")]
    return found.select(*parts, *more)


def thresholds_of(rows, quantiles: int, features=FEATURES):
    return binning.indicator_thresholds(rows, binning.quantile_edges(rows, features, quantiles))


def mined(r, size: int, quantiles: int):
    rows = items(r)
    return mining.rules(rows, thresholds_of(rows, quantiles), mining.label_measures("label", "disputed", "payment"), size)


@query("I1", "G1", oracle=f"""
,{LABELLED},{edges_sql(10)}
SELECT feature, {sql_rd('left_edge', 4)} AS left_edge, CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS positives, {sql_rd('min(value)', 4)} AS lowest, {sql_rd('max(value)', 4)} AS highest FROM binned GROUP BY 1, binned.left_edge
""")
def quantile_bins(r):
    rows = items(r)
    binned = binning.with_bins(rows, binning.quantile_edges(rows, FEATURES, 10))
    long = binned.select("label", F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}_quantile").alias("left_edge"), F.col(f).alias("v")) for f in FEATURES])))
    found = long.groupBy("feature", "left_edge").agg(F.count("*").alias("n"), F.sum("label").alias("positives"), F.min("v").alias("lowest"), F.max("v").alias("highest"))
    return found.select("feature", "n", "positives", *rds(["left_edge", "lowest", "highest"], 4))


@query("I2", oracle=f"""
,{LABELLED},{edges_sql(10)}
SELECT t.feature, {sql_rd('t.t', 4)} AS threshold, CAST(sum(CASE WHEN l.value > t.t THEN 1 ELSE 0 END) AS BIGINT) AS above FROM th t JOIN long l ON l.feature = t.feature GROUP BY 1, t.t
""")
def indicator_counts(r):
    rows = items(r)
    long = binning.indicators(rows, thresholds_of(rows, 10), [])
    return long.groupBy("feature", "threshold").agg(F.sum("value").alias("above")).withColumn("threshold", rd("threshold", 4))


@query("I3", oracle=f"""
, e AS (SELECT quantile_cont(o_totalprice, {_shares(10)}) AS es FROM orders)
SELECT o_orderkey, {' || '.join(f"CASE WHEN o_totalprice > es[{i}] THEN '1' ELSE '0' END" for i in range(1, 10))} AS flags FROM orders, e
""")
def quantile_flags(r):
    rows = r.table("orders")
    edges = binning.exact_quantiles(rows, ["o_totalprice"], [i / 10 for i in range(11)])
    flagged = binning.quantile_flags(rows, edges)
    return flagged.select("o_orderkey", F.concat(*[F.col(f"o_totalprice_quantile_{i}").cast("string") for i in range(1, 10)]).alias("flags"))


@query("I4", oracle=f"""
,{LABELLED}, k AS (SELECT l_linenumber || l_linestatus AS v, sum(label) AS positives, count(*) AS n FROM its GROUP BY 1 HAVING sum(label) >= 400)
SELECT v AS mode, CAST(positives AS BIGINT) AS positives, CAST(n AS BIGINT) AS n FROM k
""")
def supported_values(r):
    rows = items(r).withColumn("mode", F.concat(F.col("l_linenumber"), F.col("l_linestatus")))
    return binning.supported_values(rows, "mode", "label", at_least=400)


@query("I5", oracle="""
SELECT o_orderkey, """ + ", ".join(f"CASE WHEN o_orderstatus = '{v}' THEN 1 ELSE 0 END AS o_orderstatus_{v}" for v in "FOP") + " FROM orders\n")
def one_hot_status(r):
    rows = r.table("orders")
    hot = binning.one_hot(rows, "o_orderstatus", binning.distinct_values(rows, "o_orderstatus"))
    return hot.select("o_orderkey", *[f"o_orderstatus_{v}" for v in "FOP"])


@query("I6", oracle=f"""
, e AS (SELECT list_sort(list_distinct([round_even(x, 1) for x in quantile_cont(o_totalprice, {_shares(5)})])) AS es FROM orders),
b AS (SELECT es[1 + len(list_filter(es[2:len(es) - 1], lambda x: x < o_totalprice))] AS left_edge, o_totalprice FROM orders, e WHERE o_totalprice BETWEEN es[1] AND es[len(es)])
SELECT {sql_rd('left_edge', 1)} AS left_edge, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY b.left_edge
""")
def rounded_bins(r):
    binned, _ = binning.rounded_bins(r.table("orders"), ["o_totalprice"])
    known = binned.filter(F.col("o_totalprice_bin").isNotNull())
    return known.groupBy(F.col("o_totalprice_quantile").alias("left_edge")).agg(F.count("*").alias("n"))


_PIVOT = f"""
,{LABELLED},
e AS (SELECT list_sort(list_distinct(quantile_cont(l_quantity, {_shares(4)}))) AS ye, list_sort(list_distinct(quantile_cont(l_discount, {_shares(5)}))) AS xe FROM its),
b AS (SELECT 1 + len(list_filter(ye[2:len(ye) - 1], lambda v: v < l_quantity)) AS y, 1 + len(list_filter(xe[2:len(xe) - 1], lambda v: v < l_discount)) AS x, ye, xe, label FROM its, e)
SELECT printf('%.2f-%.2f', ye[y], ye[y + 1]) AS l_quantity_range, printf('%.2f-%.2f', xe[x], xe[x + 1]) AS l_discount_range, {{}} AS value FROM b GROUP BY 1, 2
"""


def _pivot(r, how):
    table = binning.quantile_pivot(items(r), "l_discount", "l_quantity", "label", 5, 4, how)
    ranges = [c for c in table.columns if c != "l_quantity_range"]
    return table.unpivot(["l_quantity_range"], [F.col(f"`{c}`") for c in ranges], "l_discount_range", "value")


@query("I7", oracle=_PIVOT.format(sql_rd("avg(label)")))
def quantile_pivot_rate(r):
    return _pivot(r, F.avg).withColumn("value", rd("value"))


@query("I7", oracle=_PIVOT.format("CAST(sum(label) AS BIGINT)"))
def quantile_pivot_sum(r):
    return _pivot(r, F.sum)


@query("J1", "J2", "G1", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}
SELECT {_keys_sql(1)}, {_COUNTS}, {sql_rd('rate')} AS rate, {sql_rd('amount', 2)} AS amount, {sql_rd('amount / (SELECT sum(disputed) FROM its)')} AS amount_share FROM rules
""")
def univariate_rules(r):
    total = items(r).agg(F.sum("disputed").alias("t")).scalar()
    found = mined(r, 1, 10).withColumn("amount_share", m.ratio(F.col("amount"), total))
    return flat(found, 1, "n", "positives", rd("rate").alias("rate"), rd("amount", 2).alias("amount"), rd("amount_share").alias("amount_share"))


@query("J1", oracle=f"""
,{LABELLED},{edges_sql(130)},{rules_sql(1)}
SELECT {_keys_sql(1)}, {_COUNTS}, {sql_rd('rate')} AS rate FROM rules
""")
def univariate_rules_fine(r):
    return flat(mined(r, 1, 130), 1, "n", "positives", rd("rate").alias("rate"))


_CANDIDATES = "cand AS (SELECT * FROM rules WHERE positives >= 20 AND rate >= 1.32 * (SELECT avg(rate) FROM rules))"


@query("J3", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}, {_CANDIDATES}
SELECT {_keys_sql(1)}, {_COUNTS} FROM cand
""")
def candidate_indicators(r):
    return flat(mining.candidates(mined(r, 1, 10), 20), 1, "n", "positives")


@query("J4", "G2", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}, {_CANDIDATES}, c AS (SELECT DISTINCT feature_1 AS f, threshold_1 AS t FROM cand)
SELECT a.f AS feature_1, {sql_rd('a.t', 4)} AS threshold_1, b.f AS feature_2, {sql_rd('b.t', 4)} AS threshold_2 FROM c a JOIN c b ON a.f < b.f
""")
def candidate_pairs(r):
    indicators = mining.columns_of(mining.candidates(mined(r, 1, 10), 20))
    return mining.candidate_pairs(indicators, FEATURES).select("feature_1", "feature_2", *rds(["threshold_1", "threshold_2"], 4))


@query("J5", "J6", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(2)}
SELECT {_keys_sql(2)}, {_COUNTS}, {sql_rd('rate')} AS rate, {sql_rd('amount', 2)} AS amount, {sql_rd('payment', 2)} AS payment FROM rules WHERE positives >= 10 AND rate >= 0.06
""")
def pair_rules(r):
    found = mining.supported(mined(r, 2, 10), 10, rate=0.06)
    return flat(found, 2, "n", "positives", rd("rate").alias("rate"), *rds(["amount", "payment"], 2))


@query("J6", "J4", "F2", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}, {_CANDIDATES}, c AS (SELECT DISTINCT feature_1 AS f, threshold_1 AS t FROM cand),{rules_sql(2, '_2')}
SELECT {_keys_sql(2)}, {_COUNTS} FROM rules_2 WHERE positives >= 15 AND (feature_1, threshold_1) IN (SELECT (f, t) FROM c) AND (feature_2, threshold_2) IN (SELECT (f, t) FROM c)
""")
def pair_rules_of_candidates(r):
    indicators = mining.columns_of(mining.candidates(mined(r, 1, 10), 20))
    found = mining.restricted(mining.supported(mined(r, 2, 10), 15), indicators, 2)
    return flat(mining.ranked(found, "rate", "n"), 2, "n", "positives")


@query("J7", oracle=f"""
,{LABELLED},{edges_sql(5)},{rules_sql(3)}
SELECT {_keys_sql(3)}, {_COUNTS}, {sql_rd('rate')} AS rate, {sql_rd('amount', 2)} AS amount FROM rules WHERE positives >= 15 AND n >= 30
""")
def triple_rules(r):
    found = mining.supported(mined(r, 3, 5), 15, n=30)
    return flat(found, 3, "n", "positives", rd("rate").alias("rate"), rd("amount", 2).alias("amount"))


_GOOD = "good AS (SELECT * FROM rules_2 WHERE positives >= 26 AND rate >= 0.0738)"
_USED = "used AS (SELECT DISTINCT feature_1 AS f, threshold_1 AS t FROM good UNION SELECT DISTINCT feature_2, threshold_2 FROM good)"


@query("J8", "G2", oracle=f"""
,{LABELLED},{edges_sql(5)},{rules_sql(2, '_2')}, {_GOOD}, {_USED},{rules_sql(3, '_3')}
SELECT {_keys_sql(3)}, {_COUNTS}, {sql_rd('rate')} AS rate FROM rules_3 WHERE positives >= 10 AND rate >= 0.09
  AND {' AND '.join(f'(feature_{k}, threshold_{k}) IN (SELECT (f, t) FROM used)' for k in (1, 2, 3))}
""")
def triple_rules_of_good_pairs(r):
    good = mining.supported(mined(r, 2, 5), 26, rate=0.0738)
    found = mining.restricted(mining.supported(mined(r, 3, 5), 10, rate=0.09), mining.columns_of(good), 3)
    return flat(found, 3, "n", "positives", rd("rate").alias("rate"))


def _pair_in(a: int, b: int) -> str:
    return f"(feature_{a}, threshold_{a}, feature_{b}, threshold_{b}) IN (SELECT (feature_1, threshold_1, feature_2, threshold_2) FROM good)"


@query("J9", oracle=f"""
,{LABELLED},{edges_sql(5)},{rules_sql(2, '_2')}, good AS (SELECT * FROM rules_2 WHERE positives >= 500 AND rate >= 0.2),{rules_sql(3, '_3')}
SELECT {_keys_sql(3)}, {_COUNTS} FROM rules_3 WHERE positives >= 10 AND {_pair_in(1, 2)} AND {_pair_in(1, 3)} AND {_pair_in(2, 3)}
""")
def triples_with_good_pairs(r):
    good = mining.supported(mined(r, 2, 5), 500, rate=0.2)
    return flat(mining.with_good_pairs(mining.supported(mined(r, 3, 5), 10), good), 3, "n", "positives")


@query("J10", oracle=f"""
,{LABELLED}, w AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber % 4 END AS a, CASE WHEN l_linenumber % 3 < 2 THEN l_linenumber % 3 END AS b, CASE WHEN l_linenumber > 2 THEN 0 END AS c, label FROM its),
g AS (SELECT list_filter([CASE WHEN a IS NOT NULL THEN 'a_' || a END, CASE WHEN b IS NOT NULL THEN 'b_' || b END, CASE WHEN c IS NOT NULL THEN 'c_' || c END], lambda x: x IS NOT NULL) AS used, count(*) AS n, sum(label) AS positives FROM w GROUP BY a, b, c)
SELECT used[1] AS column_1, used[2] AS column_2, CAST(n AS BIGINT) AS n, CAST(positives AS BIGINT) AS positives FROM g WHERE len(used) >= 2
""")
def compacted_rules(r):
    n = F.col("l_linenumber")
    flags = {"a": F.when(n % 2 == 0, n % 4), "b": F.when(n % 3 < 2, n % 3), "c": F.when(n > 2, 0)}
    wide = items(r).withColumns(flags).groupBy("a", "b", "c").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))
    return mining.compacted(wide, ["a", "b", "c"], ["n", "positives"], 2)


@query("J11", "J12", "H33", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(2)}
SELECT {_keys_sql(2)}, {sql_rd('amount / (SELECT sum(disputed) FROM its)')} AS amount_share, {sql_rd('amount / payment * 1.15')} AS pseudo_dispute_rate,
  {sql_rd('rate / (SELECT avg(label) FROM its)')} AS lift, {sql_rd('1.645 * sqrt(rate * (1 - rate) / n)', 3)} AS error_margin FROM rules WHERE positives >= 300
""")
def rule_measures(r):
    totals = items(r).agg(F.sum("disputed").alias("total_amount"), F.avg("label").alias("base_rate"))
    found = mining.with_rule_measures(mining.supported(mined(r, 2, 10), 300), totals)
    found = found.withColumn("error_margin", m.error_margin(F.col("rate"), F.col("n")))
    return flat(found, 2, *rds(["amount_share", "pseudo_dispute_rate", "lift"]), "error_margin")


_GRID = "feature_1 = 'l_discount' AND feature_2 = 'l_quantity' AND op_1 = '>' AND op_2 = '>'"


@query("J13", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(2)}
SELECT {sql_rd('threshold_1', 4)} AS threshold_1, {sql_rd('threshold_2', 4)} AS threshold_2, {sql_rd('avg(rate)')} AS rate FROM rules WHERE {_GRID} GROUP BY rules.threshold_1, rules.threshold_2
""")
def threshold_grid(r):
    long = mining.threshold_grid(mined(r, 2, 10), "l_discount", "l_quantity")
    return long.select(*rds(["threshold_1", "threshold_2"], 4), rd("rate").alias("rate"))


_GROUPS = range(1, 8)


def _by_group(q: int) -> str:
    features = ["l_discount", "l_quantity"]
    parts = []
    edges = " UNION ALL ".join(
        f"SELECT l_linenumber AS g, '{f}' AS feature, list_sort(list_distinct(quantile_cont({f}, {_shares(q)}))) AS es FROM its GROUP BY 1" for f in features
    )
    long = " UNION ALL ".join(f"SELECT l_linenumber AS g, '{f}' AS feature, {f} AS value, label FROM its" for f in features)
    parts.append(f"""
edges AS ({edges}), long AS ({long}),
binned AS (SELECT l.*, e.es[1 + len(list_filter(e.es[2:len(e.es) - 1], lambda x: x < l.value))] AS left_edge FROM long l JOIN edges e ON l.feature = e.feature AND l.g = e.g),
lefts AS (SELECT DISTINCT g, feature, left_edge FROM binned),
th AS (SELECT g, feature, left_edge AS t FROM lefts x WHERE left_edge < (SELECT max(left_edge) FROM lefts y WHERE y.feature = x.feature AND y.g = x.g))""")
    return parts[0]


@query("J14", oracle=f"""
,{LABELLED},{_by_group(4)}
SELECT th.g AS l_linenumber, th.feature AS feature_1, CASE WHEN value > t THEN '>' ELSE '<=' END AS op_1, {sql_rd('t', 4)} AS threshold_1, CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS positives
FROM th JOIN long ON th.g = long.g AND th.feature = long.feature GROUP BY 1, 2, 3, t
""")
def univariate_rules_by_group(r):
    found = mining.rules_by_group(items(r), ["l_discount", "l_quantity"], "l_linenumber", 4, mining.label_measures("label"))
    return flat(found, 1, "l_linenumber", "n", "positives")


@query("J15", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}
SELECT {_keys_sql(1)}, {_COUNTS} FROM rules WHERE contains(feature_1, 'quantity') AND op_1 = '>'
""")
def rule_slice(r):
    return flat(mining.slice_of(mined(r, 1, 10), "quantity", ">"), 1, "n", "positives")


_ORDER = "rate DESC, n DESC, feature_1, op_1, threshold_1, feature_2, op_2, threshold_2"


@query("F1", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(2)}
SELECT {_keys_sql(2)}, {_COUNTS} FROM (SELECT * FROM rules WHERE positives >= 30 ORDER BY {_ORDER} LIMIT 40)
""")
def top_rules(r):
    return flat(mining.top(mined(r, 2, 10), 30, 40), 2, "n", "positives")


@query("F3", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}
SELECT {_keys_sql(1)}, {_COUNTS} FROM (SELECT * FROM rules ORDER BY rate, n, feature_1 DESC, op_1 DESC, threshold_1 DESC LIMIT 10)
""")
def bottom_rules(r):
    return flat(mining.bottom(mined(r, 1, 10), 10), 1, "n", "positives")


@query("F4", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}, d AS (SELECT *, dense_rank() OVER (ORDER BY n) AS dr FROM rules)
SELECT {_keys_sql(1)}, {_COUNTS} FROM d WHERE (dr - 1) % 3 = 0
""")
def every_third_value(r):
    return flat(mining.every_nth_value(mined(r, 1, 10), "n"), 1, "n", "positives")


@query("E20", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}, d AS (SELECT *, row_number() OVER (PARTITION BY feature_1 ORDER BY rate DESC, n DESC, op_1, threshold_1) AS position FROM rules)
SELECT {_keys_sql(1)}, CAST(position AS INTEGER) AS position FROM d WHERE position <= 3
""")
def best_rules_per_feature(r):
    from riskrules.operators.matching import best_per_group

    found = mined(r, 1, 10).withColumn("feature", mining.condition(1)["feature"])
    return flat(best_per_group(found, "feature", [F.desc("rate"), F.desc("n"), F.col("conditions")]), 1, "position")


