"""Joins with one row per account hold no sort of the events."""

from pyspark.sql import functions as F

from riskrules.operators import joins, rollups


def test_events_are_not_sorted_for_joins_with_accounts(spark):
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3_600)
    users = spark.range(5).select(F.col("id").alias("account_id"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("register_time"), F.lit("b").alias("bundle_id"))
    payments = spark.range(200).select((F.col("id") % 4).alias("account_id"), stamp.alias("event_time"), F.lit(2.0).alias("pay_amount"))
    spent = rollups.spend_horizons(payments, users).drop("register_time")
    both = joins.assembled([spent, rollups.ad_horizons(payments.withColumnRenamed("pay_amount", "revenue"), users)])
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 5 and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    found = {r.account_id: (r.p1, r.cp1, r.ad28) for r in both.collect()}
    assert set(found) == set(range(5)) and found[4] == (0.0, 0.0, 0.0)
    # Account 1 pays at hours 1, 5, 9, ..., 197; up to one complete day counts what is under 48 hours.
    assert found[1] == (24.0, 12.0, 100.0)
