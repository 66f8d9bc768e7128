"""Scored models: validation by time block, calibration, stacking and the grids around them.

Scores come in long form with columns model, row id, block, label and score. Trees and forests of all
blocks grow together (``forests``); Bayes is a closed form (``bayes``); linear models are Spark ML
estimators on ``features``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrules.functions.measures import fill_gaps
from riskrules.operators import forests
from riskrules.operators.bayes import GaussianBayes
from riskrules.operators.logistic import TunedLogistic
from riskrules.operators.trees import CRITERIA
from riskrules.session import cut


def assembled(df: DataFrame, features: Sequence[str], row_id: str, label: str, block: str | None = None) -> DataFrame:
    """Row id, label, block and the feature vector with unknown values as 0."""
    filled = fill_gaps(df, features)
    vector = VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)
    blocks = F.col(block).cast("int") if block else F.lit(0)
    return vector.select(F.col(row_id).alias("row_id"), F.col(label).cast("double").alias("label"), blocks.alias("block"), "features")


def logistic(penalty: float = 0.0, rounds: int = 100) -> LogisticRegression:
    return LogisticRegression(regParam=penalty, maxIter=rounds)


# Inverse penalties of the published grid: ten from 1e-4 to 1e4, evenly on the log scale.
STRENGTHS = tuple(10 ** (-4 + 8 * i / 9) for i in range(10))


def tuned_logistic(rows: int, strengths: Sequence[float] = STRENGTHS, folds: int = 2, rounds: int = 100, seed: int = 42) -> TunedLogistic:
    """Logistic regression with its penalty chosen by cross-validation on the area under the ROC curve.

    Strengths weigh the summed loss of ``rows`` training rows; Spark weighs the penalty against the mean loss.
    """
    return TunedLogistic(tuple(1 / (c * max(rows, 1)) for c in strengths), folds, rounds, seed)


def scaled_svm(penalty: float = 0.01, rounds: int = 1_000) -> Pipeline:
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return Pipeline(stages=[scaler, LinearSVC(featuresCol="scaled", regParam=penalty, maxIter=rounds)])


def score_of(scored: DataFrame) -> Column:
    """Probability of the positive class; the margin or the predicted share for models without."""
    for column in ("probability", "rawPrediction"):
        if column in scored.columns:
            return F.coalesce(F.get(vector_to_array(F.col(column)), 1), F.lit(0.0))
    return F.col("prediction")


def scores(model, data: DataFrame, name: str) -> DataFrame:
    scored = model.transform(data)
    return scored.select(F.lit(name).alias("model"), "row_id", "block", "label", score_of(scored).alias("score"))


def grid_scores(table: DataFrame, criteria: Sequence[str], depths: Sequence[int], leaf_sizes: Sequence[int], forest_trees: int | None = None, take: int | None = None) -> DataFrame:
    """Accuracy and precision per grid point and left-out block of a table of ``forests.binned``.

    Entropy and log loss split alike, so they share their trees; depths share the levels above them.
    """
    if unknown := set(criteria) - set(CRITERIA):
        raise ValueError(f"criteria {sorted(unknown)}")
    grown = dict.fromkeys("entropy" if c == "log_loss" else c for c in criteria)
    growths = [forests.Growth(c, s, tuple(sorted(depths))) for c in grown for s in leaf_sizes]
    called = F.col("score") > 0.5
    hit = called & (F.col("label") == 1)
    scored = forests.out_of_block(table, growths, forest_trees, take)
    per_block = scored.groupBy(F.col("model").alias("iteration"), F.col("block").alias("test_at")).agg(
        F.avg((called.cast("double") == F.col("label")).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(F.count_if(hit).cast("double"), F.count_if(called)), F.lit(0.0)).alias("precision"),
    )
    if "log_loss" not in criteria:
        return per_block
    named = [c for c in criteria if c in ("entropy", "log_loss")]
    twice = F.when(F.col("iteration").startswith("entropy"), F.array(*[F.lit(c) for c in named])).otherwise(F.array(F.lit("")))
    renamed = F.when(F.col("_as") != "", F.concat("_as", F.expr("substring(iteration, 8)"))).otherwise(F.col("iteration"))
    return per_block.withColumn("_as", F.explode(twice)).withColumn("iteration", renamed).drop("_as")


def mean_grid_scores(per_block: DataFrame) -> DataFrame:
    means = per_block.groupBy("iteration").agg(F.avg("accuracy").alias("accuracy"), F.avg("precision").alias("precision"))
    return means.orderBy(F.desc("accuracy"), "iteration")


def fold_of(folds: int, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64("draw", F.lit(seed)), F.lit(folds)).cast("int")


def _calibrator(method: str, held_out: DataFrame):
    # One row per distinct score: the isotonic fit ends on the driver, so it gets counts, not rows.
    points = held_out.groupBy("score").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    if method == "isotonic":
        return IsotonicRegression(featuresCol="score", labelCol="label", weightCol="weight").fit(points)
    both = held_out.groupBy("score", "label").agg(F.count("*").cast("double").alias("weight"))
    vector = VectorAssembler(inputCols=["score"], outputCol="features").transform(both)
    return LogisticRegression(weightCol="weight").fit(vector)


def _calibrated(method: str, model, scored: DataFrame) -> DataFrame:
    if method == "isotonic":
        return model.transform(scored).withColumn("score", F.col("prediction")).drop("prediction")
    vector = VectorAssembler(inputCols=["score"], outputCol="features").transform(scored)
    return model.transform(vector).withColumn("score", F.get(vector_to_array("probability"), 1)).select(*scored.columns)


def calibrated_bayes(train: DataFrame, test: DataFrame, features: Sequence[str], name: str, method: str = "isotonic", folds: int = 2) -> DataFrame:
    """Test scores of calibrated naive Bayes: per fold, fit on the rest and calibrate on the fold; average.

    ``method`` is ``isotonic`` or ``sigmoid``. All calibrators are applied to the same test row, one after
    another. Tables have ``row_id``, ``block``, ``label``, ``draw`` (folds go by it) and the features.
    """
    train = cut(train.withColumn("fold", fold_of(folds)))
    out, kept = test, [F.lit(name).alias("model"), "row_id", "block", F.col("label").cast("double").alias("label")]
    columns = list(out.columns)
    for k in range(folds):
        base = GaussianBayes.fitted(train.filter(F.col("fold") != k), features, "label")
        held_out = train.filter(F.col("fold") == k).select(F.col("label").cast("double").alias("label"), base.score().alias("score"))
        ready = out.select(*columns, *[f"_s{j}" for j in range(k)], base.score().alias("score"))
        out = _calibrated(method, _calibrator(method, held_out), ready).withColumnRenamed("score", f"_s{k}")
    mean = sum([F.col(f"_s{k}") for k in range(1, folds)], F.col("_s0")) / folds
    return out.select(*kept, mean.alias("score"))


def stacked_scores(
    rows: DataFrame, features: Sequence[str], bases: Sequence[forests.Growth], final, name: str = "stacking", folds: int = 5, trees: int = 100, take: int | None = None, bins: int = 32
) -> DataFrame:
    """Test scores of a stack of forests: ``final(rows)`` on their out-of-fold scores and the features.

    ``rows`` has ``row_id``, ``block``, ``label``, ``draw``, the features and ``is_test``. Training rows are
    scored by forests without their fold, test rows by forests grown on all training rows: all of them grow
    in one go.
    """
    placed = cut(rows.withColumn("_fold", F.when(~F.col("is_test"), fold_of(folds))))
    table = forests.binned(placed, features, "row_id", "label", "_fold", bins, F.col("draw"))
    names = [n for g in bases for n in g.names]
    scored = forests.out_of_block(table, bases, trees, take).groupBy("row_id").pivot("model", names).agg(F.first("score"))
    scored = scored.select("row_id", *[F.col(f"`{n}`").alias(f"_base{i}") for i, n in enumerate(names)])
    inputs = [*[f"_base{i}" for i in range(len(names))], *features]
    whole = fill_gaps(placed, list(features)).join(scored, "row_id")
    whole = VectorAssembler(inputCols=inputs, outputCol="features").transform(whole)
    ready = cut(whole.select("row_id", F.col("block").cast("int").alias("block"), F.col("label").cast("double").alias("label"), "is_test", "features"))
    train = ready.filter(~F.col("is_test"))
    return scores(final(train.count()).fit(train), ready.filter("is_test").drop("is_test"), name)
