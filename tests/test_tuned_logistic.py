"""The grid of folds and penalties against Spark ML's fits one by one, and in how many passes it is found."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskrules.operators import logistic, models


def made(spark, rows=600, positives=True):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(rows, 3)) * [1.0, 50.0, 0.0] + [0.0, 900.0, 4.0]  # the last does not vary
    y = (rng.random(rows) < 1 / (1 + np.exp(1 - x[:, 0] - (x[:, 1] - 900) / 40))) * float(positives)
    return spark.createDataFrame([(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["row_id", "label", "features"]).coalesce(1)


def exact_area(score, label):
    over = score[label == 1][:, None] - score[label == 0][None]
    return ((over > 0) + (over == 0) / 2).mean()


def test_grid_equals_single_fits(spark, monkeypatch):
    passes, sums = [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda *a: passes.append(1) or sums(*a))
    train, penalties = made(spark), (10.0, 0.1, 1e-3, 1e-9)
    found = logistic.TunedLogistic(penalties, folds=2, seed=3).areas(train)
    assert len(passes) <= 15  # for eight models
    parted = train.withColumn("fold", F.least(F.floor(F.rand(3) * 2), F.lit(1)))
    for k in range(2):
        held = parted.filter(F.col("fold") == k).drop("fold")
        for i, penalty in enumerate(penalties):
            one = LogisticRegression(regParam=penalty, tol=1e-10).fit(parted.filter(F.col("fold") != k).drop("fold"))
            rows = one.transform(held).collect()
            area = exact_area(np.array([r.rawPrediction[1] for r in rows]), np.array([r.label for r in rows]))
            assert abs(found[k, i] - area) < 2e-4


def test_model_of_the_best_penalty(spark):
    train = made(spark)
    estimator = models.tuned_logistic(600)
    assert isinstance(estimator, logistic.TunedLogistic) and len(estimator.penalties) == 10
    model = estimator.fit(train)
    best = estimator.penalties[int(estimator.areas(train).mean(axis=0).argmax())]
    assert model.getRegParam() == best and model.coefficients[2] == 0
    assert model.transform(train).filter("prediction = label").count() > 400


def test_odd_labels(spark):
    assert (logistic.TunedLogistic((1.0, 0.1)).areas(made(spark, positives=False)) == 0.5).all()
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        logistic.TunedLogistic((1.0,)).areas(made(spark).withColumn("label", F.lit(None).cast("double")))


def test_rows_travel_in_blocks(spark, monkeypatch):
    """A pass gets blocks of rows, not rows; blocks of any size give the same areas."""
    train, got, sums = made(spark, 5_000), [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda blocks, *a: got.append(blocks.count()) or sums(blocks, *a))
    found = []
    for size, files in ((8_192, 64), (600, 2)):
        monkeypatch.setattr(logistic, "BLOCK_ROWS", size)
        monkeypatch.setattr(logistic, "FILE_BLOCKS", files)
        got.clear()
        found.append(logistic.TunedLogistic((1.0, 1e-3), folds=3, seed=3).areas(train))
        assert got and set(got) == {-(-5_000 // size)}
    assert np.allclose(*found, rtol=1e-9)
