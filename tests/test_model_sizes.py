"""The registered model queries ask for the published grids and model sizes; nothing is grown here."""

from itertools import product

import pytest

from riskrules.operators import forests, models
from riskrules.plans.catalog import REGISTRY


def test_whole_grids(spark, folder, monkeypatch):
    asked = []

    def record(table, growths, trees=None, take=None, **more):
        names = [n for g in growths for n in g.names]
        asked.extend((n, trees) for n in names)
        return spark.createDataFrame([(n, 1, 0, 0.0, 0.0) for n in names], "model string, row_id long, block int, label double, score double")

    monkeypatch.setattr(forests, "out_of_block", record)
    found = {r.iteration for r in REGISTRY["grid_scores"](spark, folder).collect()}
    of_trees = {f"{c} - {d} - 200" for c, d in product(("gini", "entropy", "log_loss"), (4, 5, 6, 7))}
    of_forests = {f"gini - {d} - {s}" for d, s in product((10, 11), (10, 20, 30))}
    assert found == of_trees | of_forests
    assert {n for n, trees in asked if trees == 100} == of_forests and {n for n, trees in asked if trees is None} == {n for n in of_trees if "log_loss" not in n}


class Seen(Exception):
    pass


def test_size_of_the_stack(spark, folder, monkeypatch):
    seen = {}

    def stop(rows, features, bases, final, **named):
        seen.update(named, bases=bases, final=final)
        raise Seen

    monkeypatch.setattr(models, "stacked_scores", stop)
    with pytest.raises(Seen):
        REGISTRY["stacked_forests"](spark, folder)
    assert [(g.leaf_size, g.depths) for g in seen["bases"]] == [(6, (30,)), (30, (30,))]
    assert seen["folds"] == 5 and seen["trees"] == 100 and seen["final"] is models.tuned_logistic and len(models.STRENGTHS) == 10
