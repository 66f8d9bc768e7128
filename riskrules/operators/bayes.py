"""Gaussian naive Bayes in closed form: class counts, means and variances from one grouped pass."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMOOTHING = 1e-9  # of the largest variance of a feature, added to all variances


@dataclass(frozen=True)
class GaussianBayes:
    """Shares of the classes, and per class and feature the mean and variance."""

    features: tuple[str, ...]
    share: dict[int, float]
    mean: dict[int, tuple[float, ...]]
    variance: dict[int, tuple[float, ...]]

    @classmethod
    def fitted(cls, df: DataFrame, features: Sequence[str], label: str) -> GaussianBayes:
        """An action: a row per class comes back. Rows without a label or with an unknown feature are left out."""
        known = df.select(F.col(label).cast("int").alias("_y"), *[F.col(f).cast("double").alias(f) for f in features]).dropna()
        moments = [g(f).alias(f"{n}_{f}") for f in features for n, g in (("m", F.avg), ("v", F.var_pop))]
        rows = {r["_y"]: r for r in known.groupBy("_y").agg(F.count("*").alias("n"), *moments).collect()}
        whole = known.agg(*[F.var_pop(f).alias(f) for f in features]).first()
        total = sum(r["n"] for r in rows.values())
        extra = SMOOTHING * max([whole[f] or 0.0 for f in features], default=0.0)
        return cls(
            tuple(features),
            {c: r["n"] / total for c, r in rows.items()},
            {c: tuple(r[f"m_{f}"] for f in features) for c, r in rows.items()},
            {c: tuple(r[f"v_{f}"] + extra for f in features) for c, r in rows.items()},
        )

    def score(self) -> Column:
        """Probability of class 1; a class that was not seen has none."""
        if 1 not in self.share or 0 not in self.share:
            return F.lit(float(1 in self.share))

        def joint(c: int) -> Column:
            out = F.lit(math.log(self.share[c]))
            for f, m, v in zip(self.features, self.mean[c], self.variance[c]):
                if v == 0:  # no feature varies at all
                    continue
                out = out - F.lit(0.5 * math.log(2 * math.pi * v)) - F.pow(F.col(f) - m, 2) / F.lit(2 * v)
            return out

        return 1 / (1 + F.exp(joint(0) - joint(1)))
