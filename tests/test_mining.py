"""Bins, lattices, rule application, trees and models on planted data."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskrules.operators import binning, evaluation, forests, matching, mining, models, trees
from riskrules.operators.bayes import GaussianBayes
from riskrules.operators.matching import Rule


@pytest.fixture(scope="module")
def planted_rows():
    """Base rate 0.02; 0.8 where x > 7 and y > 3. One value of x holds a third of the rows."""
    rng = random.Random(11)
    rows = []
    for i in range(6000):
        x = 2.0 if rng.random() < 0.33 else rng.uniform(0, 10)
        y = rng.uniform(0, 10)
        z = None if rng.random() < 0.05 else (float("nan") if rng.random() < 0.05 else rng.uniform(-5, 5))
        hit = rng.random() < (0.8 if x > 7 and y > 3 else 0.02)
        rows.append((i, x, y, z, int(hit), round(rng.uniform(1, 100), 2), i % 3))
    return rows


@pytest.fixture(scope="module")
def planted(spark, planted_rows):
    return spark.createDataFrame(planted_rows, "id long, x double, y double, z double, label int, amount double, block int").repartition(8).cache()


@pytest.mark.parametrize("limit", [10**9, 500, 40])
def test_quantiles_are_numpy_quantiles(planted, planted_rows, limit):
    shares = [0.0, 0.01, 0.2, 0.5, 0.77, 1.0]
    got = binning.exact_quantiles(planted, ["x", "y", "z"], shares, slot_rows=limit)
    for k, c in enumerate("xyz", 1):
        known = [r[k] for r in planted_rows if r[k] is not None and r[k] == r[k]]
        assert got[c] == pytest.approx(list(np.quantile(known, shares)), abs=1e-12)


def test_quantiles_by_group(planted, planted_rows):
    got = binning.exact_quantiles(planted, ["y"], [0.25, 0.5], by="block", slot_rows=100)
    for b in range(3):
        assert got[b]["y"] == pytest.approx(list(np.quantile([r[2] for r in planted_rows if r[6] == b], [0.25, 0.5])))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "a double")
    assert binning.exact_quantiles(empty, ["a"], [0.5]) == {"a": []}


def test_bins_are_those_of_qcut(planted, planted_rows):
    edges = binning.quantile_edges(planted, ["x"], 10)
    frame = pd.DataFrame({"x": [r[1] for r in planted_rows]})
    labels, bins = pd.qcut(frame["x"], 10, retbins=True, duplicates="drop", labels=False)
    assert edges["x"] == pytest.approx(list(bins))
    got = {r["id"]: r["x_bin"] for r in binning.with_bins(planted, edges).select("id", "x_bin").collect()}
    assert [got[i] for i in range(len(planted_rows))] == list(labels)


def test_edge_counts_of_special_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.0,), (-0.0,), (1.0,), (float("inf"),), (float("-inf"),)], "v double")
    got = [r[0] for r in binning.edge_counts(df, {"v": [0.0, 1.0]}).select("v_above").collect()]
    assert got == [0, 0, 0, 0, 1, 2, 0]


def test_new_values_have_no_bin(spark):
    df = spark.createDataFrame([(5.0,), (11.0,), (0.0,)], "v double")
    got = [tuple(r) for r in binning.with_bins(df, {"v": [0.0, 5.0, 10.0]}).select("v_bin", "v_quantile").collect()]
    assert got == [(0, 0.0), (None, None), (0, 0.0)]


def test_supported_patterns_encode_new_data(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), (None, 1)], "p string, y int")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, p string")
    kept = binning.supported_values(old, "p", "y", at_least=2)
    assert [tuple(r) for r in binning.pattern_indicators(new, "p", kept, "pay", ["id"]).collect()] == [(1, "pay_a")]
    assert [r["p"] for r in binning.supported_values(old, "p", "y", exactly=0).collect()] == ["b"]


def met(row, conditions):
    value = {"x": row[1], "y": row[2], "z": row[3]}
    for c in conditions:
        v = value[c["feature"]]
        above = v is not None and v == v and v > c["threshold"]
        if above != (c["op"] == ">"):
            return False
    return True


@pytest.mark.parametrize("size", [1, 2, 3])
def test_rules_count_what_a_filter_counts(planted, planted_rows, size):
    thresholds = binning.indicator_thresholds(planted, binning.quantile_edges(planted, ["x", "y", "z"], 4))
    found = mining.rules(planted, thresholds, mining.label_measures("label", "amount"), size).collect()
    assert len({str(r["conditions"]) for r in found}) == len(found)
    for r in random.Random(size).sample(found, min(30, len(found))):
        rows = [p for p in planted_rows if met(p, r["conditions"])]
        assert (r["n"], r["positives"]) == (len(rows), sum(p[4] for p in rows))
        assert r["amount"] == pytest.approx(sum(p[5] for p in rows))


def test_four_sides_add_up(planted, planted_rows):
    thresholds = {"x": [3.0, 7.0], "y": [3.0]}
    found = mining.rules(planted, thresholds, mining.label_measures("label"), 2)
    sums = found.groupBy(F.transform("conditions", lambda c: c["threshold"]).alias("t")).agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in sums} == {len(planted_rows)} and len(sums) == 2


def test_the_planted_rule_ranks_first(planted):
    thresholds = {"x": [1.0, 5.0, 7.0, 9.0], "y": [1.0, 3.0, 8.0], "z": [0.0]}
    found = mining.rules(planted, thresholds, mining.label_measures("label"), 2)
    best = mining.top(found, 400, 1).first()
    assert [tuple(c) for c in best["conditions"]] == [("x", ">", 7.0), ("y", ">", 3.0)]
    assert 0.75 < best["rate"] < 0.85


def test_rule_tables_as_text_and_matrix(planted):
    found = mining.rules(planted, {"x": [3.0, 7.0], "y": [3.0]}, mining.label_measures("label"), 2)
    texts = {(r["column_1"], r["column_2"]) for r in mining.as_columns(found, 2, 1).collect()}
    assert ("x > 7.0", "y <= 3.0") in texts and len(texts) == 8
    long = mining.threshold_grid(found, "x", "y", value="n")
    matrix = mining.grid_matrix(long, [3.0], "n").orderBy("threshold_1").collect()
    assert [r["threshold_1"] for r in matrix] == [3.0, 7.0] and matrix[0]["3.0"] > matrix[1]["3.0"]


def test_rules_by_group(planted, planted_rows):
    found = mining.rules_by_group(planted, ["x", "z"], "block", 4, mining.label_measures("label")).collect()
    assert {r["block"] for r in found} == {0, 1, 2}
    for r in found:
        rows = [p for p in planted_rows if p[6] == r["block"] and met(p, r["conditions"])]
        assert (r["n"], r["positives"]) == (len(rows), sum(p[4] for p in rows))


def test_rules_applied_either_way(planted, planted_rows):
    rules = [Rule(1, (("x", ">", 7.0), ("y", ">", 3.0))), Rule(2, (("z", "<=", 0.0),), maturity=1), Rule(3, (("y", "==", 99.0),))]
    def day(row):
        return row[6]

    masks = {
        1: [r[1] > 7 and r[2] > 3 for r in planted_rows],
        2: [r[3] is not None and r[3] == r[3] and r[3] <= 0 and day(r) == 1 for r in planted_rows],
        3: [False for _ in planted_rows],
    }
    any_hit = planted.filter(matching.any_rule(rules, "block")).count()
    assert any_hit == sum(a or b for a, b in zip(masks[1], masks[2], strict=True))
    for per_pass in (1, 2000):
        got = {r["rule_id"]: (r["n"], r["positives"]) for r in matching.per_rule(planted, rules, "label", "block", per_pass).collect()}
        assert got == {k: (sum(m), sum(r[4] for r, hit in zip(planted_rows, m) if hit)) for k, m in masks.items()}


def test_many_rules_in_one_pass(planted, planted_rows):
    rules = [Rule(i, (("x", ">", i / 100), ("y", "<=", 5.0))) for i in range(1000)]
    got = {r["rule_id"]: r["n"] for r in matching.per_rule(planted, rules, "label").collect()}
    for i in (0, 500, 999):
        assert got.get(i, 0) == sum(r[1] > i / 100 and r[2] <= 5 for r in planted_rows)


def test_rules_with_too_many_cells_are_tested_row_by_row(planted, monkeypatch):
    rules = [Rule(i, (("x", ">=", float(i)), ("y", "<", 5.0 + i / 10))) for i in range(8)]
    rules.append(Rule(99, (("x", ">", 1.0), ("y", ">", 1.0), ("z", "<=", 1.0), ("amount", "<", 50.0))))
    by_cells = sorted(map(tuple, matching.per_rule(planted, rules, "label").collect()))
    monkeypatch.setattr(matching, "MAX_CELL_TESTS", 10)
    assert sorted(map(tuple, matching.per_rule(planted, rules, "label").collect())) == by_cells and len(by_cells) == 9


def test_one_answer_at_every_size(spark):
    """Groups without values, infinities and fractional days, in slots of three rows and of all."""
    inf, nan = float("inf"), float("nan")
    rows = [(g, float(i % 7), 3.0 + (i % 3) / 10, i % 2) for g in "ab" for i in range(40)]
    rows += [("a", inf, 3.0, 1), ("a", -inf, 3.0, 1), ("b", nan, 3.0, 0), ("c", None, 3.0, 0), ("c", nan, 3.5, 1), ("d", inf, 3.0, 1)]
    df = spark.createDataFrame(rows, "g string, x double, day double, label int")
    found = [binning.exact_quantiles(df, ["x"], [0.0, 0.3, 0.5, 1.0], by="g", slot_rows=n) for n in (3, 100_000)]
    assert found[0] == found[1] and found[0].keys() == set("abcd")
    assert found[0]["c"] == found[0]["d"] == {"x": []}
    assert found[0]["a"]["x"] == pytest.approx(list(np.quantile([i % 7 for i in range(40)], [0.0, 0.3, 0.5, 1.0])))
    whole = [binning.exact_quantiles(df, ["x"], [0.5], slot_rows=n) for n in (3, 100_000)]
    assert whole[0] == whole[1] == {"x": [3.0]}
    rules = [Rule(1, (("x", ">", 1.0),), maturity=3), Rule(2, (("x", ">", 99.0),), maturity=9), Rule(3, (("x", ">", 1.0),))]
    short = sorted(map(tuple, matching.per_rule(df, rules, "label", "day").collect()))
    assert [r[0] for r in short] == [1, 2, 3] and short[1] == (2, 0, 0, None)
    day = [r for r in rows if r[2] == 3.0 and r[1] is not None and r[1] == r[1] and r[1] > 1]
    assert short[0][1] == len(day)


def test_rule_texts(spark):
    df = spark.createDataFrame([("a > 5", None, "0.25"), ("b <= 1e3", "a == 2", "7 rows here x")], "c1 string, c2 string, c3 string")
    got = [[tuple(c) for c in r["conditions"]] for r in matching.from_text(df, ["c1", "c2", "c3"]).collect()]
    assert got == [[("a", ">", 5.0)], [("b", "<=", 1000.0), ("a", "==", 2.0)]]


def test_condition_matrix(spark):
    df = spark.createDataFrame([(1, True, False, True), (2, False, False, None), (3, False, True, True)], "k int, a boolean, b boolean, c boolean")
    texts = matching.matrix_text(df, ["a", "b", "c"], "k")
    assert matching.union_text(texts, "k").first()[0] == "(a & c) | (b & c)"
    assert matching.union_text(texts.filter("k = 2"), "k").first()[0] == "False"


def brute_split(values, labels, leaf):
    def ent(y):
        p = np.mean(y) if len(y) else 0
        return 0 if p in (0, 1) else -len(y) * (p * np.log(p) + (1 - p) * np.log(1 - p))

    best = (0, None)
    for t in np.unique(values)[:-1]:
        left, right = labels[values <= t], labels[values > t]
        if len(left) >= leaf and len(right) >= leaf:
            gain = ent(labels) - ent(left) - ent(right)
            if gain > best[0] + 1e-9:
                best = (gain, t)
    return best


def test_tree_splits_where_entropy_says(spark):
    rng = np.random.default_rng(4)
    v = rng.integers(0, 30, 800).astype(float)
    y = (rng.random(800) < np.where(v > 17, 0.3, 0.05)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"v": v, "label": y}))
    root, low, high = trees.grow(df, ["v"], "label", depth=1, leaf_size=40, bins=1000)
    _, t = brute_split(v, y, 40)
    assert (root.n, root.positives) == (800, y.sum())
    ((feature, op, limit),) = low.conditions
    assert (feature, op, high.conditions) == ("v", "<=", (("v", ">", limit),)) and t <= limit < t + 1
    assert (low.n, low.positives, high.n) == ((v <= t).sum(), y[v <= t].sum(), (v > t).sum())


def test_tree_finds_the_planted_rule_in_every_group(planted):
    found = trees.leaf_rules(planted, ["x", "y", "z"], "label", by=["block"], depth=3, leaf_size=40)
    best = {}
    for r in found.collect():
        if r["rate"] > best.get(r["block"], (0,))[0]:
            best[r["block"]] = (r["rate"], {c["feature"] for c in r["conditions"]}, r["conditions"])
    assert set(best) == {0, 1, 2}
    for rate, features, conditions in best.values():
        assert rate > 0.7 and {"x", "y"} <= features
        bound = max(c["threshold"] for c in conditions if c["feature"] == "x" and c["op"] == ">")
        assert 6.5 < bound < 8.5


def test_node_metrics_are_filter_counts(planted, planted_rows):
    nodes = trees.grow(planted, ["x", "y"], "label", depth=4, leaf_size=30)
    for r in trees.node_metrics(nodes, planted, "label").collect():
        rows = [p for p in planted_rows if met(p, r["conditions"])]
        assert (r["n"], r["positives"]) == (len(rows), sum(p[4] for p in rows))
    at = {x.node_id: x for x in nodes}
    for x in nodes:
        if not x.is_leaf:
            assert x.n == at[2 * x.node_id].n + at[2 * x.node_id + 1].n


def test_pruning_flags(spark):
    def c(*features):
        return [(f, ">", 1.0) for f in features]

    rows = [(c(), 1000, 50), (c("a"), 100, 12), (c("a", "b"), 80, 2), (c("c"), 10, 1), (c("d"), 5, 1), (c("d", "e"), 0, 0), (c("g"), 9, 0), (c("g", "h"), 7, 11)]
    df = spark.createDataFrame(rows, "conditions array<struct<feature:string,op:string,threshold:double>>, n long, positives long")
    got = {"/".join(x["feature"] for x in r["conditions"]): (r["meets"], r["children_meet"], r["node_type"], r["final"]) for r in trees.pruned(df).collect()}
    assert got == {
        "": (True, True, "Leaf", False),
        "a": (True, False, "Leaf", True),
        "a/b": (False, False, "Leaf", False),
        "c": (False, False, "Leaf", False),
        "d": (False, False, "Leaf", False),
        "g": (False, True, "Parent", False),
        "g/h": (True, False, "Leaf", True),
    }


def test_calibration_brings_scores_to_rates(planted):
    data = planted.withColumnRenamed("id", "row_id").withColumn("draw", F.col("row_id"))
    train, test = data.filter("block < 2"), data.filter("block = 2")
    bayes = GaussianBayes.fitted(train, ["x", "y"], "label")
    raw = test.select(F.lit("raw").alias("model"), bayes.score().alias("score"), "label")
    brier = {"raw": evaluation.metrics(raw).first()["brier"]}
    for method in ("isotonic", "sigmoid"):
        scored = models.calibrated_bayes(train, test, ["x", "y"], method, method)
        assert scored.count() == test.count() and scored.filter("score < 0 or score > 1").count() == 0
        brier[method] = evaluation.metrics(scored).first()["brier"]
    assert brier["isotonic"] < brier["raw"] and brier["sigmoid"] < brier["raw"] + 0.01


def test_bayes_of_one_class_or_gaps(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 0), (3.0, None)], "x double, label int")
    assert [r[0] for r in df.select(GaussianBayes.fitted(df, ["x"], "label").score()).distinct().collect()] == [1.0]
    same = spark.createDataFrame([(1.0, 1), (1.0, 0), (1.0, 0)], "x double, label int").withColumn("z", F.rand(1))
    assert same.select(GaussianBayes.fitted(same, ["x", "z"], "label").score().alias("s")).filter("s BETWEEN 0 AND 1").count() == 3
    assert all(r[0] == pytest.approx(1 / 3) for r in same.select(GaussianBayes.fitted(same, ["x"], "label").score()).collect())


def test_grid(planted):
    table = forests.binned(planted, ["x", "y"], "id", "label", "block", 64)
    means = models.mean_grid_scores(models.grid_scores(table, ["gini", "log_loss"], [2, 3], [40])).collect()
    assert {r["iteration"] for r in means} == {f"{c} - {d} - 40" for c in ("gini", "log_loss") for d in (2, 3)}
    assert all(a["accuracy"] >= b["accuracy"] for a, b in zip(means, means[1:]))
    both = models.grid_scores(table, ["entropy", "log_loss"], [2], [40]).collect()
    by = {(r["iteration"].split()[0], r["test_at"]): (r["accuracy"], r["precision"]) for r in both}
    assert len(by) == 6 and all(by["entropy", b] == by["log_loss", b] for b in range(3))


def test_stack(planted):
    rows = planted.withColumnRenamed("id", "row_id").withColumns({"draw": F.col("row_id"), "is_test": F.col("block") == 2})
    bases = [forests.Growth("gini", 5, (6,)), forests.Growth("gini", 50, (4,))]
    stacked = models.stacked_scores(rows, ["x", "y"], bases, lambda n: models.logistic(), folds=2, trees=5)
    assert stacked.count() == rows.filter("is_test").count() and evaluation.auc(stacked).first()["auc"] > 0.8


def test_auc_with_ties(spark):
    rows = [("m", 0.5, 1), ("m", 0.5, 0), ("m", 0.9, 1), ("m", 0.1, 0), ("m", 0.9, 0)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    wins = sum((p > q) + 0.5 * (p == q) for _, p, y in rows if y for _, q, z in rows if not z)
    assert evaluation.auc(df).first()["auc"] == pytest.approx(wins / 6)


def test_gains_are_monotone(planted):
    scores = planted.select(F.lit("m").alias("model"), (F.col("x") / 10).alias("score"), "label")
    points = [(r["percent_above"], r["percent_true_above"]) for r in evaluation.gains(scores).orderBy("i").collect()]
    assert points[0] == (100.0, 100.0)
    assert all(a[0] >= b[0] and a[1] >= b[1] for a, b in zip(points, points[1:]))
