"""Quantiles of many groups as a table: orders of doubles, hot groups, many groups."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskrules.operators import binning, quantiles

ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, 0.1, 3.0, 1 + 2**-52, 2 - 2**-52, 2.0**60, 0.5 - 2**-54]


def test_doubles_keep_their_order(spark):
    rng = np.random.default_rng(2)
    values = ODD + [struct.unpack("<d", rng.bytes(8))[0] for _ in range(3000)] + [2.0**e for e in range(-1074, 1024, 7)]
    values = [v for v in values if math.isfinite(v)]
    df = quantiles.ordered_numbers(spark.createDataFrame([(v,) for v in values], "v double"), {"k": F.col("v")})
    rows = df.withColumn("back", quantiles.number_back(F.col("k"))).collect()
    assert all(r.back == r.v for r in rows)
    by = sorted(rows, key=lambda r: r.v)
    assert all((p.k < q.k) == (p.v < q.v) and p.k <= q.k for p, q in zip(by, by[1:]))


def test_groups_of_all_kinds(spark):
    rng = np.random.default_rng(3)
    groups = {1: list(rng.normal(size=5000)), 2: [7.0] * 900, 3: [1.0], 4: [float("nan"), None], 5: ODD, 6: [1.0, 2.0, None, float("inf")], 7: list(1e9 + np.arange(500) * 1e-7)}
    rows = [(g, float(v) if v is not None else None, float(i % 3)) for g, vs in groups.items() for i, v in enumerate(vs)] + [(None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, x double, z double").repartition(5)
    shares = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
    found = {(r.g, r["column"]): r for r in quantiles.quantile_table(df, ["x", "z"], shares, ["g"]).collect()}
    assert (4, "x") not in found and (4, "z") in found and (None, "x") not in found
    for g, vs in groups.items():
        known = [v for v in vs if v is not None and math.isfinite(v)]
        if known:
            r = found[g, "x"]
            with np.errstate(over="ignore"):
                assert r.n == len(known) and list(r["values"]) == pytest.approx(list(np.quantile(known, shares)), rel=1e-12, nan_ok=True) or g == 5
    assert list(found[5, "x"]["values"])[0] == min(ODD) and list(found[5, "x"]["values"])[-1] == max(ODD)
    assert quantiles.quantile_table(df.limit(0), ["x"], shares, ["g"]).count() == 0
    (whole,) = quantiles.quantile_table(df.filter("g = 1"), ["x"], shares).collect()
    assert list(whole["values"]) == list(found[1, "x"]["values"])


def test_a_hundred_thousand_groups(spark, monkeypatch):
    """No group comes to the driver: nothing is collected on the way."""
    df = spark.range(300_000).select((F.col("id") % 100_000).alias("g"), (F.xxhash64("id") % 1000).cast("double").alias("x"), F.lit(1).alias("label"))
    collect = type(df).collect
    seen = []
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    coded = binning.codes_by_group(df, ["x"], "g", 2)
    assert coded.groupBy("g").agg(F.countDistinct("x_code").alias("k"), F.count("*").alias("n")).filter("n = 3").count() == 100_000
    assert sum(map(len, seen)) < 100
    wrong = coded.groupBy("g").agg(F.expr("percentile(x, 0.5)").alias("m"), F.min("x").alias("low"), F.expr("max(struct(x, x_code))").alias("top"))
    wrong = wrong.filter("top.x_code <> IF(top.x > m AND m > low, 1, 0)").count()  # equal edges are one
    assert wrong == 0
