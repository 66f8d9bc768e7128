"""Fitted models over line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskrules.functions.timeunits import day_number
from riskrules.operators import binning, evaluation, forests, models, trees
from riskrules.operators.bayes import GaussianBayes
from riskrules.plans.mining_queries import FEATURES, LABELLED, items
from riskrules.plans.registry import query, rd, rds, sql_rd
from riskrules.session import cut

_METRICS = ["accuracy", "precision", "recall", "f1", "brier", "log_loss", "auc"]


def _rows(r):
    """Line items with a row number, a hash of their content to draw by, and a validation block by ship date."""
    rows = items(r).withColumn("draw", F.xxhash64(*r.table("lineitem").columns))
    blocked = binning.time_blocks(rows.withColumn("day", day_number(F.col("l_shipdate"))), "day", 3)
    return cut(blocked.select(F.monotonically_increasing_id().alias("row_id"), "draw", "block", "label", *FEATURES))


def _binned(rows, bins):
    return forests.binned(rows, FEATURES, "row_id", "label", "block", bins, F.col("draw"))


def _metrics(scored):
    return evaluation.metrics(scored).select("model", *rds(_METRICS, 4))


_ENTROPY = "(CASE WHEN {p} > 0 THEN -({p}) * ln(({p}) * 1.0 / ({n})) ELSE 0 END + CASE WHEN {n} - ({p}) > 0 THEN -({n} - ({p})) * ln(({n} - ({p})) * 1.0 / ({n})) ELSE 0 END)"


def _first_split() -> str:
    left, right, whole = (_ENTROPY.format(n=n, p=p) for n, p in (("ln", "lp"), ("(an - ln)", "(ap - lp)"), ("an", "ap")))
    shares = "[" + ", ".join(f"{i / 128!r}e0" for i in range(129)) + "]"
    edges = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, unnest(list_sort(list_distinct(quantile_cont({c}, {shares})))) AS t, max({c}) AS top FROM its" for i, c in enumerate(FEATURES))
    long = " UNION ALL ".join(f"SELECT l_linenumber AS g, {i} AS f, {c} AS v, label FROM its" for i, c in enumerate(FEATURES))
    return f"""
,{LABELLED}, e AS ({edges}), th AS (SELECT f, feature, t FROM e WHERE t < top), long AS ({long}),
tot AS (SELECT l_linenumber AS g, count(*) AS an, sum(label) AS ap FROM its GROUP BY 1),
c AS (SELECT g, th.f, feature, t, count(*) FILTER (WHERE v <= t) AS ln, coalesce(sum(label) FILTER (WHERE v <= t), 0) AS lp FROM th JOIN long ON th.f = long.f GROUP BY 1, 2, 3, 4),
r AS (SELECT c.*, an, ap, round({whole} - {left} - {right}, 9) AS gain FROM c JOIN tot USING (g) WHERE ln >= 100 AND an - ln >= 100),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY g ORDER BY gain DESC, f, t) = 1)
SELECT CAST(g AS INTEGER) AS l_linenumber, feature || ' <= ' || printf('%.3f', t) AS condition_1, CAST(ln AS BIGINT) AS n, CAST(lp AS BIGINT) AS positives FROM b
UNION ALL SELECT CAST(g AS INTEGER), feature || ' > ' || printf('%.3f', t), CAST(an - ln AS BIGINT), CAST(ap - lp AS BIGINT) FROM b
"""


@query("L1", "L2", oracle=_first_split())
def first_split_by_day(r):
    found = trees.leaf_rules(items(r), FEATURES, "label", by=["l_linenumber"], depth=1, leaf_size=100)
    return trees.rule_columns(found, 1).select("l_linenumber", "condition_1", "n", "positives")


@query("L1", "L2")
def tree_rules_by_day(r):
    found = trees.by_segment(items(r), FEATURES, "label", by=["l_linestatus", "l_linenumber"], depth=5, leaf_size=100)
    return trees.rule_columns(found.filter("is_leaf").drop("is_leaf"), 5)


def _segment_trees_sql(depth: int, leaf: int, bins: int) -> str:
    """Trees of all segments by brute force, every node with the quantile edges of its own rows."""
    shares = "[" + ", ".join(f"{i / bins!r}e0" for i in range(bins + 1)) + "]"
    value = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(FEATURES)) + " END"
    left, right, whole = (_ENTROPY.format(n=n, p=p) for n, p in (("ln", "lp"), ("(an - ln)", "(ap - lp)"), ("an", "ap")))
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(FEATURES)) + " END"
    out = f", n0 AS MATERIALIZED (SELECT l_linestatus AS u, {', '.join(FEATURES)}, label, 1 AS node, '' AS path FROM its)"
    for d in range(depth):
        out += f""", v{d} AS (SELECT u, node, f, {value} AS v, label FROM n{d}, (SELECT unnest(range({len(FEATURES)})) AS f) WHERE node >= {2**d}),
e{d} AS (SELECT u, node, f, list_sort(list_distinct(quantile_cont(v, {shares}))) AS es, count(*) AS an, sum(label) AS ap FROM v{d} GROUP BY ALL),
t{d} AS (SELECT u, node, f, unnest(es[1:len(es) - 1]) AS t, an, ap FROM e{d}), h{d} AS (SELECT u, node, f, v, count(*) AS n, sum(label) AS p FROM v{d} GROUP BY ALL),
c{d} AS (SELECT t.u, t.node, t.f, t, an, ap, sum(n) AS ln, sum(p) AS lp FROM t{d} t JOIN h{d} h ON t.u = h.u AND t.node = h.node AND t.f = h.f AND h.v <= t.t GROUP BY ALL),
s{d} AS (SELECT u, node, f, t FROM (SELECT *, round({whole} - {left} - {right}, 9) AS g FROM c{d} WHERE ln >= {leaf} AND an - ln >= {leaf}) WHERE g > 0 QUALIFY row_number() OVER (PARTITION BY u, node ORDER BY g DESC, f, t) = 1),
n{d + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (node, path), CASE WHEN f IS NULL THEN n.node WHEN {value} <= t THEN 2 * n.node ELSE 2 * n.node + 1 END AS node,
  CASE WHEN f IS NULL THEN path ELSE path || '; ' || {names} || CASE WHEN {value} <= t THEN ' <= ' ELSE ' > ' END || printf('%.3f', t) END AS path FROM n{d} n LEFT JOIN s{d} s ON n.u = s.u AND n.node = s.node)"""
    return f",{LABELLED}{out} SELECT u AS l_linestatus, CAST(node AS INTEGER) AS node_id, substr(path, 3) AS rule, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM n{depth} GROUP BY ALL"


@query("L1", "L2", oracle=_segment_trees_sql(2, 150, 128))
def tree_rules_by_segment(r):
    found = trees.by_segment(items(r), FEATURES, "label", by=["l_linestatus"], depth=2, leaf_size=150, local_rows=20_000)
    texts = F.transform("conditions", lambda c: F.concat_ws(" ", c["feature"], c["op"], F.format_string("%.3f", c["threshold"])))
    return found.filter("is_leaf").select("l_linestatus", "node_id", F.concat_ws("; ", texts).alias("rule"), "n", "positives")


@query("L3", "L4")
def tree_node_metrics(r):
    rows = items(r)
    nodes = trees.grow(rows, FEATURES, "label", depth=4, leaf_size=150)
    return trees.rule_columns(trees.pruned(trees.node_metrics(nodes, rows, "label")), 4)


@query("L5")
def grid_scores(r):
    rows = _rows(r)
    tree_points = models.grid_scores(_binned(rows, 128), ["gini", "entropy", "log_loss"], [4, 5, 6, 7], [200])
    forest_points = models.grid_scores(_binned(rows, 32), ["gini"], [10, 11], [10, 20, 30], forest_trees=100, take=2)
    return models.mean_grid_scores(tree_points.unionByName(forest_points))


def _impurity(criterion: str, n: str, p: str) -> str:
    return _ENTROPY.format(n=n, p=p) if criterion == "entropy" else f"CASE WHEN {n} > 0 THEN 2.0 * ({p}) * (({n}) - ({p})) / ({n}) ELSE 0 END"


def _grown_sql(units: str, criteria: dict[str, str], depth: int, leaf: int, bins: int) -> str:
    """Trees by brute force: ``units`` gives (u, row, label, w) and features of every row of every tree, ``u``
    naming its criterion by the key of ``criteria`` that it begins with. Ends with the nodes ``n{depth}``."""
    shares = "[" + ", ".join(f"{i / bins!r}e0" for i in range(bins + 1)) + "]"
    edges = " UNION ALL ".join(f"SELECT {i} AS f, unnest(list_sort(list_distinct(quantile_cont({c}, {shares})))) AS t, max({c}) AS top FROM its" for i, c in enumerate(FEATURES))
    value = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(FEATURES)) + " END"
    gain = "CASE " + " ".join(
        f"WHEN starts_with(u, '{k}') THEN {_impurity(c, 'an', 'ap')} - ({_impurity(c, 'ln', 'lp')}) - ({_impurity(c, '(an - ln)', '(ap - lp)')})" for k, c in criteria.items()
    ) + " END"
    out = f", th AS MATERIALIZED (SELECT f, t FROM ({edges}) WHERE t < top), n0 AS MATERIALIZED (SELECT *, 1 AS node FROM ({units}))"
    for level in range(depth):
        out += f""", h{level} AS (SELECT u, node, f, {value} AS v, sum(w) AS n, sum(w * label) AS p FROM n{level}, (SELECT DISTINCT f FROM th) WHERE w > 0 GROUP BY ALL),
c{level} AS (SELECT u, node, h.f, t, sum(n) FILTER (WHERE v <= t) AS ln, coalesce(sum(p) FILTER (WHERE v <= t), 0) AS lp, sum(n) AS an, sum(p) AS ap FROM h{level} h JOIN th ON h.f = th.f GROUP BY ALL),
s{level} AS (SELECT u, node, f, t FROM (SELECT *, round({gain}, 9) AS g FROM c{level} WHERE ln >= {leaf} AND an - ln >= {leaf}) WHERE g > 0 QUALIFY row_number() OVER (PARTITION BY u, node ORDER BY g DESC, f, t) = 1),
n{level + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN s.f IS NULL OR n.node < {2 ** level} THEN n.node WHEN {value.replace("CASE f", "CASE s.f")} <= s.t THEN 2 * n.node ELSE 2 * n.node + 1 END AS node)
  FROM n{level} n LEFT JOIN s{level} s ON n.u = s.u AND n.node = s.node)"""
    return out


def _out_of_block_sql() -> str:
    blocks = "list_sort(list_distinct(quantile_cont(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)), [0.0, 1/3.0, 2/3.0, 1.0])))"
    units = f"SELECT c || ' ' || k AS u, label, {', '.join(FEATURES)}, k = block AS held, CASE WHEN k = block THEN 0 ELSE 1 END AS w FROM blk, (SELECT unnest(['gini', 'entropy']) AS c), (SELECT unnest([0, 1, 2]) AS k)"
    return f"""
,{LABELLED}, eb AS (SELECT {blocks} AS e FROM its),
blk AS (SELECT its.*, len(list_filter(e[2:len(e) - 1], lambda x: x < date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)))) AS block FROM its, eb)
{_grown_sql(units, {"gini": "gini", "entropy": "entropy"}, 2, 200, 32)},
leaf AS (SELECT u, node, sum(w * label) / CAST(sum(w) AS DOUBLE) AS score FROM n2 GROUP BY 1, 2)
SELECT split_part(u, ' ', 1) AS criterion, CAST(split_part(u, ' ', 2) AS INTEGER) AS block, {sql_rd("score")} AS score, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives
FROM n2 JOIN leaf USING (u, node) WHERE held GROUP BY 1, 2, 3"""


@query("L5", "L12", oracle=_out_of_block_sql())
def out_of_block_trees(r):
    grown = [forests.Growth("gini", 200, (2,)), forests.Growth("entropy", 200, (2,))]
    scored = forests.out_of_block(_binned(_rows(r), 32), grown)
    named = scored.select(F.split_part("model", F.lit(" "), F.lit(1)).alias("criterion"), "block", rd("score").alias("score"), "label")
    return named.groupBy("criterion", "block", "score").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("positives"))


def _scored(r):
    rows = _rows(r)
    forest = forests.out_of_block(_binned(rows, 32), [forests.Growth("gini", 20, (10,))], trees=100, take=2)
    tree = forests.out_of_block(_binned(rows, 128), [forests.Growth("log_loss", 100, (5,))])
    return forest.withColumn("model", F.lit("forest")).unionByName(tree.withColumn("model", F.lit("tree")))


@query("L6", "L12")
def out_of_block_scores(r):
    return _metrics(_scored(r))


@query("L6", "L12", oracle=f"""
,{LABELLED}, eb AS (SELECT list_sort(list_distinct(quantile_cont(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)), [0.0, 1/3.0, 2/3.0, 1.0]))) AS e FROM its),
blk AS (SELECT its.*, len(list_filter(e[2:len(e) - 1], lambda x: x < date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)))) AS block FROM its, eb)
SELECT m AS model, CAST(block AS INTEGER) AS block, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, true AS mean_is_near, true AS finds_most FROM blk, (SELECT unnest(['forest', 'tree']) AS m) GROUP BY ALL
""")
def scores_by_block(r):
    """Rows and positives per model and block; whether the mean score is within a tenth of the share of
    positives, and whether scores above that share hold at least nine tenths of the positives."""
    scored = _scored(r)
    share = scored.groupBy("model", "block").agg(F.avg("label").alias("share"))
    found = scored.join(share, ["model", "block"]).groupBy("model", "block").agg(
        F.count("*").alias("n"),
        F.sum("label").cast("long").alias("positives"),
        (F.abs(F.avg("score") - F.first("share")) <= 0.1 * F.first("share")).alias("mean_is_near"),
        (F.sum(F.when(F.col("score") > F.col("share"), F.col("label"))) >= 0.9 * F.sum("label")).alias("finds_most"),
    )
    return found


def _parted(r):
    """Training and test rows: the last block is the test."""
    rows = _rows(r)
    return rows.filter("block < 2"), rows.filter("block = 2")


@query("L7", "L10")
def single_model_scores(r):
    train, test = (models.assembled(x, FEATURES, "row_id", "label", "block") for x in _parted(r))
    train = cut(train)
    chosen = {"logistic": models.tuned_logistic(train.count()), "svm": models.scaled_svm()}
    scored = [models.scores(e.fit(train), test, n) for n, e in chosen.items()]
    return evaluation.auc(scored[0].unionByName(scored[1])).select("model", *rds(["auc"], 4))


def _bayes_sql() -> str:
    moments = ", ".join(f"avg({f}) AS m{i}, var_pop({f}) AS v{i}" for i, f in enumerate(FEATURES))
    extra = f"(SELECT 1e-9 * greatest({', '.join(f'var_pop({f})' for f in FEATURES)}) FROM train)"
    terms = " ".join(f"- 0.5 * ln(2 * pi() * (v{i} + x)) - ({f} - m{i}) * ({f} - m{i}) / (2 * (v{i} + x))" for i, f in enumerate(FEATURES))
    return f"""
,{LABELLED}, eb AS (SELECT list_sort(list_distinct(quantile_cont(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)), [0.0, 1/3.0, 2/3.0, 1.0]))) AS e FROM its),
blk AS (SELECT its.*, row_number() OVER () AS i, len(list_filter(e[2:len(e) - 1], lambda x: x < date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)))) AS block FROM its, eb),
train AS (SELECT * FROM blk WHERE block < 2), fit AS (SELECT label AS y, count(*) / CAST((SELECT count(*) FROM train) AS DOUBLE) AS share, {extra} AS x, {moments} FROM train GROUP BY 1),
j AS (SELECT i, label, y, ln(share) {terms} AS j FROM blk, fit WHERE block = 2),
s AS (SELECT i, any_value(label) AS label, 1 / (1 + exp(max(j) FILTER (WHERE y = 0) - max(j) FILTER (WHERE y = 1))) AS score FROM j GROUP BY 1)
SELECT CAST(floor(score * 20 + 1e-9) AS BIGINT) AS band, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, {sql_rd("avg(score)", 5)} AS mean_score FROM s GROUP BY 1"""


@query("L8", oracle=_bayes_sql())
def bayes_scores(r):
    train, test = _parted(r)
    scored = test.select("label", GaussianBayes.fitted(train, FEATURES, "label").score().alias("score"))
    band = F.floor(F.col("score") * 20 + 1e-9).alias("band")
    return scored.groupBy(band).agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("positives"), rd(F.avg("score"), 5).alias("mean_score"))


@query("L9")
def calibrated_bayes(r):
    train, test = _parted(r)
    both = [models.calibrated_bayes(train, test, FEATURES, f"bayes_{m}", m) for m in ("isotonic", "sigmoid")]
    return _metrics(both[0].unionByName(both[1]))


@query("L11")
def stacked_forests(r):
    rows = _rows(r).withColumn("is_test", F.col("block") == 2)
    bases = [forests.Growth("gini", 6, (30,)), forests.Growth("gini", 30, (30,))]  # the published ones have no limit of depth
    return _metrics(models.stacked_scores(rows, FEATURES, bases, models.tuned_logistic, folds=5, trees=100, take=2))
