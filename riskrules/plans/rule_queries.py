"""Rule sets on data, and evaluation of scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskrules.operators import binning, evaluation, matching, mining, splits, trees
from riskrules.plans.feature_queries import hour_features
from riskrules.plans.mining_queries import FEATURES, LABELLED, edges_sql, flat, items, mined, rules_sql, thresholds_of
from riskrules.plans.registry import query, rd, rds, sql_rd
from riskrules.plans.rollup_queries import HOURS_SQL

CUTOFF = "1998-06-01"

_TRAIN = f"""
,{LABELLED.replace('its AS', 'all_its AS')}, its AS (SELECT * FROM all_its WHERE l_shipdate < TIMESTAMP '{CUTOFF}'),{edges_sql(10)},{rules_sql(2)},
picked AS (SELECT *, row_number() OVER (ORDER BY rate DESC, n DESC, feature_1, op_1, threshold_1, feature_2, op_2, threshold_2) AS rule_id FROM rules
  WHERE positives >= 30 QUALIFY rule_id <= 12)"""


def _value(alias: str, k: int) -> str:
    return "CASE " + " ".join(f"WHEN {alias}.feature_{k} = '{f}' THEN d.{f}" for f in FEATURES) + " END"


def _met(alias: str = "p") -> str:
    return " AND ".join(
        f"CASE WHEN {alias}.op_{k} = '>' THEN {_value(alias, k)} > {alias}.threshold_{k} ELSE {_value(alias, k)} <= {alias}.threshold_{k} END" for k in (1, 2)
    )


def trained(r):
    """Train and test line items, and the best pair rules of the train part on the driver."""
    train, test = splits.before_and_from(items(r), "l_shipdate", CUTOFF)
    found = mining.rules(train, thresholds_of(train, 10), mining.label_measures("label", "disputed", "payment"), 2)
    best = mining.top(found, 30, 12)
    return train, test, matching.to_driver(best, [F.desc("rate"), F.desc("n"), "conditions"])


@query("K1", "K5", "L21", oracle=f"""{_TRAIN},
hit AS (SELECT d.*, EXISTS (SELECT 1 FROM picked p WHERE {_met()}) AS met FROM all_its d)
SELECT CASE WHEN l_shipdate < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS table_name, CAST(count(*) AS BIGINT) AS n, {sql_rd('avg(label)')} AS rate,
  CAST(count(*) FILTER (WHERE met) AS BIGINT) AS hit_n, CAST(sum(label) FILTER (WHERE met) AS BIGINT) AS hit_positives, {sql_rd('avg(label) FILTER (WHERE met)')} AS hit_rate,
  {sql_rd('(avg(label) FILTER (WHERE met)) / avg(label)')} AS lift FROM hit GROUP BY 1
""")
def rule_set_on_new_data(r):
    train, test, rules = trained(r)
    found = matching.rule_set_rates({"train": train, "test": test}, matching.any_rule(rules), "label")
    return found.select("table_name", "n", "hit_n", "hit_positives", *rds(["rate", "hit_rate", "lift"]))


@query("K1", "K3", oracle=f"""{_TRAIN}
SELECT p.rule_id, CAST(count(d.label) AS BIGINT) AS n, CAST(coalesce(sum(d.label), 0) AS BIGINT) AS positives, {sql_rd('avg(d.label)')} AS rate
FROM picked p LEFT JOIN all_its d ON d.l_shipdate >= TIMESTAMP '{CUTOFF}' AND {_met()} GROUP BY 1
""")
def rules_on_test_rows(r):
    _, test, rules = trained(r)
    found = matching.per_rule(test, rules, "label")
    return found.select(F.col("rule_id").cast("long").alias("rule_id"), "n", "positives", rd("rate").alias("rate"))


# Rules as they are written down by hand; the last column is a rate and no condition.
_TEXTS = [
    (1, "l_quantity > 30", "l_discount >= 0.05", "0.25"),
    (2, "l_tax <= 0.02", "l_quantity > 45", "0.31"),
    (3, "l_extendedprice < 2000", None, "0.02"),
    (4, "l_discount == 0.1", "l_quantity > 20", "0.4"),
]
_TEXT_SQL = {
    1: "l_quantity > 30 AND l_discount >= 0.05",
    2: "l_tax <= 0.02 AND l_quantity > 45",
    3: "l_extendedprice < 2000",
    4: "l_discount = 0.1 AND l_quantity > 20",
}


@query("K2", oracle=f"""
,{LABELLED}
""" + " UNION ALL ".join(f"SELECT {i} AS rule_id, CAST(count(*) AS BIGINT) AS n, CAST(coalesce(sum(label), 0) AS BIGINT) AS positives FROM its WHERE {c}" for i, c in _TEXT_SQL.items()))
def text_rules(r):
    written = r.spark.createDataFrame(_TEXTS, "rule_number int, c1 string, c2 string, c3 string")
    rules = matching.to_driver(matching.from_text(written, ["c1", "c2", "c3"]), ["rule_number"])
    return matching.per_rule(items(r), rules, "label").select("rule_id", "n", "positives")


_WIDE = [(30.0, 0.05, None), (None, 0.08, 60000.0), (45.0, None, None), (10.0, 0.02, 90000.0)]


@query("K3", oracle=f"""
,{LABELLED}, w(rule_id, q, d, p) AS (VALUES {', '.join(f"({i}, {', '.join('NULL' if x is None else repr(x) for x in row)})" for i, row in enumerate(_WIDE, 1))})
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS positives, {sql_rd('avg(label)')} AS rate FROM its
WHERE EXISTS (SELECT 1 FROM w WHERE (q IS NULL OR l_quantity > q) AND (d IS NULL OR l_discount > d) AND (p IS NULL OR l_extendedprice > p))
""")
def wide_rules(r):
    columns = ["l_quantity", "l_discount", "l_extendedprice"]
    written = r.spark.createDataFrame([(i, *row) for i, row in enumerate(_WIDE)], "i int, " + ", ".join(f"{c} double" for c in columns))
    rules = matching.to_driver(matching.from_wide(written, columns), ["i"])
    hit = matching.rule_hits(items(r), rules).filter(F.size("rule_ids") > 0)
    return hit.agg(F.count("*").alias("n"), F.sum("label").alias("positives"), rd(F.avg("label")).alias("rate"))


_MATRIX = {"many_positive": "avg(label) >= 0.07", "high_price": "avg(l_extendedprice) >= 52500", "many_rows": "count(*) >= 4300"}


@query("K4", oracle=f"""
,{LABELLED}, g AS (SELECT l_linenumber || l_linestatus AS key, {', '.join(f'{s} AS {n}' for n, s in _MATRIX.items())} FROM its GROUP BY 1),
t AS (SELECT key, list_filter([{', '.join(f"CASE WHEN {n} THEN '{n}' END" for n in _MATRIX)}], lambda x: x IS NOT NULL) AS used FROM g)
SELECT coalesce(string_agg('(' || array_to_string(used, ' & ') || ')', ' | ' ORDER BY key) FILTER (WHERE len(used) > 0), 'False') AS condition_text FROM t
""")
def condition_matrix_text(r):
    matrix = items(r).groupBy(F.concat("l_linenumber", "l_linestatus").alias("key")).agg(*[F.expr(s).alias(n) for n, s in _MATRIX.items()])
    return matching.union_text(matching.matrix_text(matrix, list(_MATRIX), "key"), "key")


@query("K6", oracle=f"""
,{LABELLED}
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(label - 1) AS BIGINT) AS minus_negatives, {sql_rd('avg(label)')} AS rate
FROM its WHERE l_linestatus = 'F' AND l_quantity > 24.5 AND l_extendedprice > 8415.855
""")
def hand_rule(r):
    predicate = (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 24.5) & (F.col("l_extendedprice") > 8415.855)
    return matching.check(items(r), predicate, "label").withColumn("rate", rd("rate"))


_COVER = "ORDER BY rate DESC, n DESC, feature_1, op_1, threshold_1 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query("K7", "E19", oracle=f"""
,{LABELLED},{edges_sql(10)},{rules_sql(1)}
SELECT feature_1, op_1, {sql_rd('threshold_1', 4)} AS threshold_1, {sql_rd('CAST(n AS DOUBLE) / (SELECT sum(n) FROM rules)')} AS payers_covered,
  {sql_rd(f'CAST(sum(n) OVER ({_COVER}) AS DOUBLE) / (SELECT sum(n) FROM rules)', 4)} AS payers_covered_to_point,
  {sql_rd('CAST(positives AS DOUBLE) / (SELECT sum(positives) FROM rules)', 5)} AS disputes_covered,
  {sql_rd(f'CAST(sum(positives) OVER ({_COVER}) AS DOUBLE) / (SELECT sum(positives) FROM rules)', 3)} AS disputes_covered_to_point FROM rules
""")
def rule_coverage(r):
    found = matching.coverage(mined(r, 1, 10), [F.desc("rate"), F.desc("n"), F.col("conditions")])
    return flat(found, 1, rd("payers_covered").alias("payers_covered"), "payers_covered_to_point", "disputes_covered", "disputes_covered_to_point")


@query("K8", oracle=f""",{HOURS_SQL}, x AS (SELECT account_id, max(pay_amount) AS top FROM pay GROUP BY 1), j AS (SELECT * FROM ph LEFT JOIN wh USING (account_id) JOIN x USING (account_id))
SELECT CAST(count(*) AS BIGINT) AS rows_checked, CAST(count(*) FILTER (WHERE sum_withdrawns_within_24_hours > sum_payments_within_24_hours) AS BIGINT) AS withdrawn_above_paid,
  CAST(count(*) FILTER (WHERE sum_payments_within_24_hours > sum_payments_within_168_hours) AS BIGINT) AS day_above_week,
  CAST(count(*) FILTER (WHERE sum_payments_within_168_hours < 0) AS BIGINT) AS negative_week, CAST(count(*) FILTER (WHERE top / nullif(sum_payments_within_168_hours, 0) > 1) AS BIGINT) AS share_above_one FROM j
""")
def payment_data_checks(r):
    biggest = r.payments.groupBy("account_id").agg(F.max("pay_amount").alias("top"))
    wide = hour_features(r).join(biggest, "account_id")
    day, week = F.col("sum_payments_within_24_hours"), F.col("sum_payments_within_168_hours")
    checks = {
        "withdrawn_above_paid": F.col("sum_withdrawns_within_24_hours") > day,
        "day_above_week": day > week,
        "negative_week": week < 0,
        "share_above_one": F.try_divide("top", week) > 1,
    }
    return matching.data_checks(wide, checks)


@query("K8", oracle="""
, b AS (SELECT account_id, sum(coin_change) AS coin, sum(money_change) AS money FROM currency GROUP BY 1)
SELECT account_id FROM b WHERE coin >= 0 AND money >= 0
""")
def accounts_without_negatives(r):
    sums = r.currency_changes.groupBy("account_id").agg(F.sum("coin_change").alias("coin"), F.sum("money_change").alias("money"))
    return matching.non_negative(sums, ["coin", "money"]).select("account_id")


@query("L4", oracle=f"""
,{LABELLED},{edges_sql(4)},{rules_sql(1, '_1')},{rules_sql(2, '_2')},
nodes AS (SELECT feature_1, op_1, threshold_1, NULL AS feature_2, NULL AS op_2, NULL AS threshold_2, n, positives FROM rules_1
  UNION ALL SELECT feature_1, op_1, threshold_1, feature_2, op_2, threshold_2, n, positives FROM rules_2),
f AS (SELECT *, n >= 20000 OR positives >= 1500 AS meets FROM nodes),
g AS (SELECT *, feature_2 IS NULL AND EXISTS (SELECT 1 FROM f b WHERE b.meets AND b.feature_2 IS NOT NULL AND b.feature_1 = f.feature_1 AND b.op_1 = f.op_1 AND b.threshold_1 = f.threshold_1) AS children_meet FROM f)
SELECT feature_1, op_1, {sql_rd('threshold_1', 4)} AS threshold_1, feature_2, op_2, {sql_rd('threshold_2', 4)} AS threshold_2, CAST(n AS BIGINT) AS n,
  CASE WHEN NOT meets AND children_meet THEN 'Parent' ELSE 'Leaf' END AS node_type, meets AND NOT children_meet AS final FROM g
""")
def pruned_rule_tree(r):
    # One-condition rules are the parents of the two-condition rules that start with them.
    nodes = mined(r, 1, 4).unionByName(mined(r, 2, 4))
    return flat(trees.pruned(nodes, rows=20000, positives=1500), 2, "n", "node_type", "final")


# --- scores --------------------------------------------------------------------------------

SCORES = f"""
{LABELLED}, sc AS (
  SELECT 'blend' AS model, label, {sql_rd('0.6 * l_quantity / 50 + 4 * l_discount', 3)} AS score FROM its
  UNION ALL SELECT 'price', label, {sql_rd('l_extendedprice / 200000', 2)} FROM its),
bys AS (SELECT model, score, count(*) AS n, sum(label) AS p FROM sc GROUP BY 1, 2)"""


def score_table(r):
    rows = items(r).select(
        "label", rd(0.6 * F.col("l_quantity") / 50 + 4 * F.col("l_discount"), 3).alias("blend"), rd(F.col("l_extendedprice") / 200000, 2).alias("price")
    )
    return rows.unpivot(["label"], ["blend", "price"], "model", "score")


@query("L14", oracle=f"""
,{SCORES}, c AS (SELECT *, coalesce(sum(n - p) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM bys),
a AS (SELECT model, sum(p * (below + (n - p) / 2.0)) / (sum(p) * sum(n - p)) AS auc FROM c GROUP BY 1),
k AS (SELECT model, count(*) AS n, count(*) FILTER (WHERE score > 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score > 0.5 AND label = 0) AS fp,
    count(*) FILTER (WHERE score <= 0.5 AND label = 1) AS fn, avg((score - label) * (score - label)) AS brier,
    avg(-CASE WHEN label = 1 THEN ln(least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) ELSE ln(1 - least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) END) AS log_loss FROM sc GROUP BY 1)
SELECT k.model, {sql_rd('(n - fp - fn) * 1.0 / n')} AS accuracy, {sql_rd('coalesce(tp * 1.0 / nullif(tp + fp, 0), 0)')} AS precision, {sql_rd('coalesce(tp * 1.0 / nullif(tp + fn, 0), 0)')} AS recall,
  {sql_rd('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1, {sql_rd('brier')} AS brier, {sql_rd('log_loss')} AS log_loss, {sql_rd('auc')} AS auc FROM k JOIN a ON k.model = a.model
""")
def score_metrics(r):
    return evaluation.metrics(score_table(r)).select("model", *rds(["accuracy", "precision", "recall", "f1", "brier", "log_loss", "auc"]))


@query("L15", oracle=f"""
,{SCORES}
SELECT model, CAST({' + '.join(f'CASE WHEN score > {i / 12!r}e0 THEN 1 ELSE 0 END' for i in range(1, 12))} AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n,
  {sql_rd('avg(score)')} AS mean_score, {sql_rd('avg(label)')} AS share_positive FROM sc GROUP BY 1, 2
""")
def calibration_curve(r):
    return evaluation.calibration_curve(score_table(r), 12).select("model", "bin", "n", *rds(["mean_score", "share_positive"]))


@query("L16", oracle=f"""
,{SCORES}, c AS (SELECT model, score, sum(p) OVER w AS tp, sum(n - p) OVER w AS fp, sum(p) OVER (PARTITION BY model) AS ap, sum(n - p) OVER (PARTITION BY model) AS an FROM bys
  WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT model, score AS threshold, {sql_rd('fp * 1.0 / an')} AS fpr, {sql_rd('tp * 1.0 / ap')} AS tpr, {sql_rd('1 - tp * 1.0 / ap')} AS fnr FROM c
""")
def roc_points(r):
    return evaluation.roc_points(score_table(r)).select("model", "threshold", *rds(["fpr", "tpr", "fnr"]))


@query("L17", oracle=f"""
,{SCORES}, th AS (SELECT unnest([{', '.join(f'{0.9 * i / 99!r}e0' for i in range(100))}]) AS t), m AS (SELECT model, count(*) AS total FROM sc GROUP BY 1)
SELECT m.model, {sql_rd('t')} AS threshold, {sql_rd('100.0 * coalesce(sum(n) FILTER (WHERE score > t), 0) / max(total)')} AS flagged_percent, CAST(coalesce(sum(p) FILTER (WHERE score > t), 0) AS BIGINT) AS true_flagged
FROM m JOIN bys ON m.model = bys.model CROSS JOIN th GROUP BY 1, th.t
""")
def threshold_sweep(r):
    return evaluation.threshold_sweep(score_table(r)).select("model", "true_flagged", *rds(["threshold", "flagged_percent"]))


def _quantiles(shares) -> str:
    return "[" + ", ".join(f"{s!r}e0" for s in shares) + "]"


@query("L18", oracle=f"""
,{SCORES}, q AS (SELECT model, unnest(quantile_cont(score, {_quantiles([i / 50 for i in range(51)])})) AS t, generate_subscripts({_quantiles([i / 50 for i in range(51)])}, 1) - 1 AS i FROM sc GROUP BY model)
SELECT q.model, CAST(q.i AS INTEGER) AS i, {sql_rd('q.t')} AS threshold, {sql_rd('100.0 * sum(n) FILTER (WHERE score >= t) / sum(n)')} AS percent_above, {sql_rd('100.0 * coalesce(sum(p) FILTER (WHERE score >= t), 0) / sum(p)')} AS percent_true_above
FROM q JOIN bys ON q.model = bys.model GROUP BY 1, q.i, q.t
""")
def gains_curve(r):
    return evaluation.gains(score_table(r)).select("model", "i", *rds(["threshold", "percent_above", "percent_true_above"]))


@query("L18", oracle=f"""
,{SCORES}
SELECT model, {sql_rd('100.0 * count(*) FILTER (WHERE score >= 0.4) / count(*)')} AS percent_above, {sql_rd('100.0 * sum(label) FILTER (WHERE score >= 0.4) / sum(label)')} AS percent_true_above FROM sc GROUP BY 1
""")
def share_above_threshold(r):
    return evaluation.share_above(score_table(r), 0.4).select("model", *rds(["percent_above", "percent_true_above"]))


@query("L19", oracle=f"""
,{SCORES}, q AS (SELECT model, unnest(quantile_cont(score, {_quantiles([i / 100 for i in range(1, 101)])})) AS lo, generate_subscripts({_quantiles([i / 100 for i in range(1, 101)])}, 1) AS band FROM sc GROUP BY model),
b AS (SELECT *, lead(lo, 1, 100) OVER (PARTITION BY model ORDER BY band) AS hi FROM q)
SELECT b.model, CAST(band AS INTEGER) AS band, {sql_rd('lo')} AS lower, CAST(coalesce(sum(n) FILTER (WHERE score >= lo AND score < hi), 0) AS BIGINT) AS n,
  {sql_rd('sum(p) FILTER (WHERE score >= lo AND score < hi) * 1.0 / sum(n) FILTER (WHERE score >= lo AND score < hi)')} AS rate, {sql_rd('coalesce(sum(p) FILTER (WHERE score >= lo), 0) * 1.0 / sum(p)')} AS positives_covered
FROM b JOIN bys ON b.model = bys.model GROUP BY 1, b.band, b.lo, b.hi
""")
def percentile_bands(r):
    return evaluation.percentile_bands(score_table(r)).select("model", "band", "n", *rds(["lower", "rate", "positives_covered"]))


@query("L20", oracle=f"""
,{SCORES}, h AS (SELECT model, CASE WHEN score BETWEEN 0.05 AND 0.5 THEN least(CAST(floor((score - 0.05e0) * 10 / (0.5e0 - 0.05e0)) AS INTEGER), 9) END AS bin, count(*) AS n FROM sc GROUP BY 1, 2),
s AS (SELECT *, n * 1.0 / sum(n) OVER (PARTITION BY model) AS share FROM h)
SELECT model, bin, CAST(n AS BIGINT) AS n, {sql_rd('share')} AS share FROM s WHERE bin IS NOT NULL
""")
def score_histogram(r):
    return evaluation.score_histogram(score_table(r), 0.05, 0.5, 10).withColumn("share", rd("share"))


@query("L23", oracle=f"""
, s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, {sql_rd('o_totalprice / 1000000', 4)} AS a, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) / 10.0 END AS b FROM orders)
SELECT 'best_two' AS model, o_orderkey AS row_id, label, {sql_rd('a + coalesce(b, 0)', 4)} AS score FROM s
""")
def summed_scores(r):
    rows = r.table("orders").select(
        F.col("o_orderkey").alias("row_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"), rd(F.col("o_totalprice") / 1000000, 4).alias("a"),
        F.when(F.col("o_orderkey") % 3 != 0, F.substring("o_orderpriority", 1, 1).cast("int") / 10).alias("b"),
    )
    long = rows.unpivot(["row_id", "label"], ["a", "b"], "model", "score").filter(F.col("score").isNotNull())
    return evaluation.summed_scores(long, ["a", "b"]).withColumn("score", rd("score", 4))


@query("L24", oracle=f"""
,{LABELLED}, g AS (SELECT l_linenumber, l_linestatus, avg(label) AS p, avg(l_discount) AS q FROM its GROUP BY 1, 2)
SELECT array_to_string(list_filter([CASE WHEN l_linenumber % 2 = 0 THEN 'even ' || l_linenumber END, CASE WHEN l_linenumber > 3 THEN 'status ' || l_linestatus END], lambda x: x IS NOT NULL), ', ') AS breakdown,
  {sql_rd('greatest(CASE WHEN l_linenumber % 2 = 0 THEN p ELSE 0 END, CASE WHEN l_linenumber > 3 THEN q ELSE 0 END)')} AS proportion FROM g
""")
def one_proportion(r):
    groups = items(r).groupBy("l_linenumber", "l_linestatus").agg(F.avg("label").alias("p"), F.avg("l_discount").alias("q"))
    n = F.col("l_linenumber")
    wide = groups.select(
        F.when(n % 2 == 0, F.concat(F.lit("even "), n)).alias("breakdown_1"), F.when(n > 3, F.concat(F.lit("status "), F.col("l_linestatus"))).alias("breakdown_2"),
        F.when(n % 2 == 0, F.col("p")).alias("proportion_1"), F.when(n > 3, F.col("q")).alias("proportion_2"),
    )
    merged = evaluation.one_proportion(wide, ["breakdown_1", "breakdown_2"], ["proportion_1", "proportion_2"])
    return merged.withColumn("proportion", rd("proportion"))


@query("L13", "I8", oracle=f"""
,{LABELLED}, e AS (SELECT l_linenumber AS g, list_sort(list_distinct(quantile_cont(l_quantity, {_quantiles([i / 5 for i in range(6)])}))) AS es FROM its GROUP BY 1),
x AS (SELECT g, len(list_filter(es[2:len(es) - 1], lambda v: v < l_quantity)) AS code, label FROM its JOIN e ON e.g = its.l_linenumber)
SELECT CAST(g AS INTEGER) AS l_linenumber, {sql_rd('regr_slope(label, code)')} AS slope, {sql_rd('regr_intercept(label, code)')} AS intercept, CAST(count(*) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS residual_slope FROM x GROUP BY g
""")
def linear_fit_per_group(r):
    coded = binning.codes_by_group(items(r), ["l_quantity"], "l_linenumber", 5)
    found = evaluation.linear_fit(coded, "l_quantity_code", "label", "l_linenumber")
    return found.select("l_linenumber", "n", *rds(["slope", "intercept"]), F.abs(rd("residual_slope")).alias("residual_slope"))


