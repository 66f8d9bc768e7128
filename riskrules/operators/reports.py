"""Summary tables over panels, profiles and rule inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrules.functions.measures import ratio
from riskrules.operators.binning import exact_quantiles


def daily_rate(df: DataFrame, time: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean label per calendar day of ``time``, optionally by further columns."""
    return df.groupBy(F.to_date(time).alias("day"), *by).agg(F.avg(label).alias("rate"))


def mean_by(df: DataFrame, label: str, measure: str, where: Column | None = None) -> DataFrame:
    kept = df if where is None else df.filter(where)
    return kept.groupBy(label).agg(F.avg(measure).alias(f"mean_{measure}"))


def dispute_shares(rates: DataFrame) -> DataFrame:
    """Shares of accounts with any, and with only, disputed payments, by number of payments. One pass."""
    n, r = F.col("valid_payments"), F.col("dispute_rate")
    out = [F.count("*").alias("accounts"), F.count_if(r > 0).alias("disputers"), F.avg((r > 0).cast("int")).alias("any_all")]
    for name, test in (("one", n == 1), ("over_one", n > 1), ("over_two", n > 2)):
        out.append(F.avg(F.when(test, (r > 0).cast("int"))).alias(f"any_{name}"))
        out.append(F.avg(F.when(test, (r == 1).cast("int"))).alias(f"every_{name}"))
    return rates.agg(*out)


def rate_and_share(df: DataFrame, key: str, label: str) -> DataFrame:
    """Positives, rate and share of all positives per value of a key."""
    groups = df.groupBy(key).agg(F.sum(label).alias("positives"), F.avg(label).alias("rate"))
    total = df.agg(F.sum(label).alias("t")).scalar()
    return groups.withColumn("share", ratio(F.col("positives"), total))


def rate_index(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rate per value of a key, over the mean of these rates."""
    groups = df.groupBy(key).agg(F.avg(label).alias("rate"))
    mean = groups.agg(F.avg("rate").alias("m")).scalar()
    return groups.withColumn("rate_index", ratio(F.col("rate"), mean))


def quantile_table(df: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """One row per share, one column per input column. An action."""
    found = exact_quantiles(df, columns, shares)
    rows = [(float(p), *[float(found[c][i]) for c in columns]) for i, p in enumerate(shares)]
    return df.sparkSession.createDataFrame(rows, ", ".join(["quantile double", *[f"{c} double" for c in columns]]))


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 0) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def strong_groups(df: DataFrame, keys: Sequence[str], label: str, at_least: int = 10) -> DataFrame:
    """Groups with enough rows and a rate not below the mean of the groups' rates."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(label).alias("positives"), F.avg(label).alias("rate"))
    mean = groups.agg(F.avg("rate").alias("m")).scalar()
    return groups.filter((F.col("n") >= at_least) & (F.col("rate") >= mean))


def case_metrics(df: DataFrame, cases: Mapping[str, Column], label: str) -> DataFrame:
    """Mean label, rows and positives per named case; a row may be in several cases. One pass."""
    names = F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in cases.items()]), lambda x: x.isNotNull())
    hit = df.select(F.col(label).alias("_y"), F.explode(names).alias("case_name"))
    return hit.groupBy("case_name").agg(F.avg("_y").alias("rate"), F.count("*").alias("n"), F.sum("_y").alias("positives"))


def block_rates(df: DataFrame, block: str, label: str) -> DataFrame:
    return df.groupBy(block).agg(F.count("*").alias("n"), F.avg(label).alias("rate"))


def profile_ratios(profile: DataFrame, order: Sequence[Column], measures: Sequence[str]) -> DataFrame:
    """Every measure over that of the first row in the order given, which is found without ordering the others."""
    first = profile.orderBy(*order).limit(1).select(F.struct(*measures).alias("first")).scalar()
    return profile.withColumns({f"{m}_ratio": ratio(F.col(m), first[m]) for m in measures})
