"""Metrics and curves from a score table with columns model, score, label.

Scores are first counted per distinct value; running counts over scores go through slots of the
score (see ``operators.ordered``), so no model's scores are ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.functions.measures import ratio
from riskrules.operators.binning import edge_counts
from riskrules.operators.ordered import Running, running
from riskrules.operators.quantiles import quantile_table
from riskrules.session import small


def score_slot(score: Column, parts: int = 256) -> Column:
    """Slot of a score, monotone in it: even in log-odds, as rare events crowd scores near zero.

    Margins outside [0, 1] lie in slots of their own beyond both ends.
    """
    far = 1_000_000
    odds = F.floor(F.log2(score / (1 - score)) * parts)
    below = -F.floor(F.log2(1 - score) * parts) - far
    above = F.floor(F.log2(score) * parts) + far
    return F.when(score <= 0, below).when(score >= 1, above).otherwise(odds)


def by_score(scores: DataFrame) -> DataFrame:
    """Rows and positives per model and distinct score."""
    return scores.groupBy("model", "score").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))


def _ordered(counted: DataFrame, measures: dict[str, Running]) -> DataFrame:
    return running(counted, ["model"], ["score"], measures, slot=score_slot(F.col("score")))


def auc(scores: DataFrame) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    counted = by_score(scores).withColumn("negatives", F.col("n") - F.col("positives"))
    below = _ordered(counted, {"neg_below": Running("sum", F.col("negatives"), with_current=False)})
    wins = F.col("positives") * (F.coalesce("neg_below", F.lit(0)) + F.col("negatives") / 2)
    sums = below.groupBy("model").agg(F.sum(wins).alias("w"), F.sum("positives").alias("p"), F.sum("negatives").alias("q"))
    return sums.select("model", ratio(F.col("w"), F.col("p") * F.col("q")).alias("auc"))


def metrics(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1, Brier score, log loss and AUC per model.

    A score above the threshold is a positive prediction. Ratios without a base are 0, scores are
    kept off 0 and 1 for the logarithm by one rounding unit.
    """
    p, y = F.col("score"), F.col("label")
    called = p > threshold
    eps = 2.220446049250313e-16
    safe = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    counts = scores.groupBy("model").agg(
        F.count("*").alias("n"),
        F.count_if(called & (y == 1)).alias("tp"),
        F.count_if(called & (y == 0)).alias("fp"),
        F.count_if(~called & (y == 1)).alias("fn"),
        F.avg((p - y) * (p - y)).alias("brier"),
        F.avg(-F.when(y == 1, F.ln(safe)).otherwise(F.ln(1 - safe))).alias("log_loss"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    def zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    table = counts.select(
        "model",
        ((F.col("n") - fp - fn) / F.col("n")).alias("accuracy"),
        zero(ratio(tp, tp + fp)).alias("precision"),
        zero(ratio(tp, tp + fn)).alias("recall"),
        zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        "brier",
        "log_loss",
    )
    return table.join(auc(scores), "model")


def calibration_curve(scores: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and share of positives in equal-width bins of [0, 1]; bins are right-closed."""
    inner = [i / bins for i in range(1, bins)]
    placed = edge_counts(scores, {"score": inner}, suffix="_bin").withColumnRenamed("score_bin", "bin")
    return placed.groupBy("model", "bin").agg(
        F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.avg("label").alias("share_positive")
    )


def roc_points(scores: DataFrame) -> DataFrame:
    """False and true positive rate, and miss rate, with the threshold at each distinct score.

    True positive rate over false positive rate is the ROC curve, miss rate over it the DET curve.
    """
    counted = by_score(scores).withColumn("negatives", F.col("n") - F.col("positives"))
    p, q = F.col("positives"), F.col("negatives")
    sums = {
        "tp": Running("sum", p, forward=True),
        "fp": Running("sum", q, forward=True),
        "p_below": Running("sum", p, with_current=False),
        "q_below": Running("sum", q, with_current=False),
    }
    placed = _ordered(counted, sums)
    # What lies at or above and what lies below make the whole: no join with totals.
    all_p = F.col("tp") + F.coalesce("p_below", F.lit(0))
    all_q = F.col("fp") + F.coalesce("q_below", F.lit(0))
    tpr = ratio(F.col("tp"), all_p)
    return placed.select("model", F.col("score").alias("threshold"), ratio(F.col("fp"), all_q).alias("fpr"), tpr.alias("tpr"), (1 - tpr).alias("fnr"))


def threshold_sweep(scores: DataFrame, steps: int = 100, highest: float = 0.9) -> DataFrame:
    """Share of rows and number of positives above each of evenly spaced thresholds from 0."""
    limits = [highest * i / (steps - 1) for i in range(steps)]
    placed = edge_counts(scores, {"score": limits}, suffix="_above")
    cells = placed.groupBy("model", "score_above").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))
    # At most steps + 1 cells per model from here on.
    models = cells.groupBy("model").agg(F.sum("n").alias("all_n"))
    line = models.select("model", "all_n", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("score_above"))
    full = line.join(cells, ["model", "score_above"], "left").na.fill(0, ["n", "positives"])
    above = Window.partitionBy("model").orderBy(F.desc("score_above")).rowsBetween(Window.unboundedPreceding, 0)
    numbers = F.array(*[F.lit(x) for x in limits])
    return full.select(
        "model",
        F.get(numbers, F.col("score_above") - 1).alias("threshold"),
        (F.sum("n").over(above) / F.col("all_n") * 100).alias("flagged_percent"),
        F.sum("positives").over(above).alias("true_flagged"),
    )


def _at_or_above(scores: DataFrame, limits: DataFrame, count: int) -> DataFrame:
    """Rows and positives with a score at or above each of ``count`` limits (model, i, threshold)."""
    table = limits.groupBy("model").agg(F.array_sort(F.collect_list("threshold")).alias("_limits"))
    counted = by_score(scores).join(small(table, count), "model")
    reached = F.size(F.filter("_limits", lambda t: t <= F.col("score")))
    cells = counted.groupBy("model", reached.alias("reached")).agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    totals = Window.partitionBy("model")
    # ``reached`` limits lie at or below the score: limit i is met by all cells with reached >= i.
    met = Window.partitionBy("model").orderBy(F.desc("reached"), F.desc("is_cell")).rowsBetween(Window.unboundedPreceding, 0)
    ordered = limits.withColumn("reached", F.row_number().over(Window.partitionBy("model").orderBy("threshold", "i")))
    both = cells.select("model", "reached", F.lit(1).alias("is_cell"), F.lit(None).cast("int").alias("i"), F.lit(None).cast("double").alias("threshold"), "n", "positives").unionByName(
        ordered.select("model", "reached", F.lit(0).alias("is_cell"), "i", "threshold", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("positives"))
    )
    summed = both.select(
        "*",
        F.sum("n").over(met).alias("met_n"),
        F.sum("positives").over(met).alias("met_positives"),
        F.sum("n").over(totals).alias("all_n"),
        F.sum("positives").over(totals).alias("all_positives"),
    )
    return summed.filter(F.col("is_cell") == 0)


def _limits(scores: DataFrame, probabilities: Sequence[float]) -> tuple[DataFrame, int]:
    found = quantile_table(scores, ["score"], probabilities, ["model"])
    return found.select("model", F.posexplode("values").alias("i", "threshold")), found.count() * len(probabilities)


def gains(scores: DataFrame, points: int = 51) -> DataFrame:
    """Percent of rows and of positives at or above evenly spaced score quantiles. An action for the quantiles."""
    limits = _limits(scores, [i / (points - 1) for i in range(points)])
    return _at_or_above(scores, *limits).select(
        "model",
        "i",
        "threshold",
        (F.col("met_n") / F.col("all_n") * 100).alias("percent_above"),
        F.coalesce(ratio(F.col("met_positives") * 100, F.col("all_positives")), F.lit(0.0)).alias("percent_true_above"),
    )


def share_above(scores: DataFrame, threshold: float) -> DataFrame:
    """The two gains shares at one threshold."""
    met = F.col("score") >= threshold
    counts = scores.groupBy("model").agg(
        (F.count_if(met) / F.count("*") * 100).alias("percent_above"),
        ratio(F.sum(F.when(met, F.col("label")).otherwise(0)) * 100, F.sum("label")).alias("share"),
    )
    return counts.select("model", "percent_above", F.coalesce("share", F.lit(0.0)).alias("percent_true_above"))


def percentile_bands(scores: DataFrame, bands: int = 100) -> DataFrame:
    """Rate of positives per band between score percentiles, and the share of positives above.

    Band ``i`` runs from percentile ``i`` to the next, the last to the top; scores below the first
    percentile are in no band, as published. An action for the percentiles.
    """
    limits = _limits(scores, [i / bands for i in range(1, bands + 1)])
    sums = _at_or_above(scores, *limits).withColumns({"band": F.col("i") + 1})
    line = Window.partitionBy("model").orderBy("band")
    n = F.col("met_n") - F.coalesce(F.lead("met_n").over(line), F.lit(0))
    hits = F.col("met_positives") - F.coalesce(F.lead("met_positives").over(line), F.lit(0))
    return sums.select(
        "model",
        "band",
        F.col("threshold").alias("lower"),
        n.alias("n"),
        ratio(hits, n).alias("rate"),
        ratio(F.col("met_positives"), F.col("all_positives")).alias("positives_covered"),
    )


def score_histogram(scores: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """Counts and shares of scores in equal bins of a range; bins are left-closed, the last closed.

    Scores outside the range are in no bin but count in the share's base.
    """
    inside = F.col("score").between(low, high)
    place = F.least(F.floor((F.col("score") - low) * bins / (high - low)), F.lit(bins - 1)).cast("int")
    cells = scores.groupBy("model", F.when(inside, place).alias("bin")).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("model"))
    return cells.withColumn("share", share).filter(F.col("bin").isNotNull())


def summed_scores(scores: DataFrame, models: Sequence[str], row: str = "row_id", name: str = "best_two") -> DataFrame:
    """A model whose score is the sum of other models' scores of the same row; missing ones add 0."""
    some = scores.filter(F.col("model").isin(list(models)))
    return some.groupBy(row, "label").agg(F.sum("score").alias("score")).select(F.lit(name).alias("model"), row, "label", "score")


def one_proportion(wide: DataFrame, texts: Sequence[str], shares: Sequence[str]) -> DataFrame:
    """Sparse text and share columns merged to one of each (texts joined, the largest share), best first."""
    largest = F.greatest(*[F.coalesce(F.col(c), F.lit(0.0)) for c in shares]) if len(shares) > 1 else F.coalesce(F.col(shares[0]), F.lit(0.0))
    rest = [c for c in wide.columns if c not in (*texts, *shares)]
    merged = wide.select(*rest, F.concat_ws(", ", *texts).alias("breakdown"), largest.alias("proportion"))
    return merged.orderBy(F.desc("proportion"), "breakdown")


def linear_fit(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group, unknown ``x`` as 0, and the slope left in its residual."""
    known = df.withColumn("_x", F.coalesce(F.col(x).cast("double"), F.lit(0.0))).withColumn("_y", F.col(y).cast("double"))
    fit = known.groupBy(by).agg(
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.count("*").alias("n"),
        F.covar_pop("_y", "_x").alias("_cov"),
        F.var_pop("_x").alias("_var"),
    )
    # The residual's slope is (cov(y, x) - slope var(x)) / var(x): the same sums give it.
    rest = ratio(F.col("_cov") - F.col("slope") * F.col("_var"), F.col("_var"))
    return fit.select(by, "slope", "intercept", "n", rest.alias("residual_slope"))
