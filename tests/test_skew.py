"""One account holds most rows: its part of a join is split, and no plan falls back to a product."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from riskrules.operators import joins, ordered, sequences, sessions
from riskrules.plans.catalog import REGISTRY

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def eager_splitting(spark):
    """Settings under which local data is large: no broadcast, tiny partitions, early splits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_events(spark, rows=60_000, hot_share=3):
    """Every third row belongs to account 0, the others to a thousand accounts."""
    account = F.when(F.col("id") % hot_share == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1)
    time = F.timestamp_add("SECOND", (F.col("id") * 37 % 2_000_000).cast("int"), F.lit(T0))
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("event_id"), account.alias("account_id"), time.alias("event_time"), (F.col("id") % 97).cast("double").alias("value"), F.rand(1).alias("noise")
    )


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_account_is_split_in_the_join_before_an_aggregate(spark, eager_splitting):
    events = hot_events(spark)
    users = spark.range(0, 1001, 1, 4).select(F.col("id").alias("account_id"), F.lit(T0 - dt.timedelta(days=1)).alias("register_time"))
    days = joins.after_registration(events, users).groupBy("account_id", "matuirity_day").agg(F.sum("value").alias("v"), F.max("noise"))
    total = sum(r["v"] for r in days.collect())
    assert total == events.agg(F.sum("value")).first()[0]
    assert "skew=true" in final_plan(days)


def hot_hour(spark, rows=60_000):
    """A third of all rows in one account, one session and one hour, a quarter of those in one instant."""
    df = hot_events(spark, rows)
    hot, at = F.col("account_id") == 0, F.when(F.col("id") % 4 == 0, F.lit(0)).otherwise(F.col("id") % 3600)
    df = df.withColumn("id", F.col("event_id"))
    time = F.when(hot, F.timestamp_add("SECOND", at.cast("int"), F.lit(T0))).otherwise(F.col("event_time"))
    return df.withColumns({"event_time": time, "session_id": F.lit(1), "spin_id": F.col("event_id"), "win_amount": F.col("value"), "bet_money": F.lit(50.0)}).drop("id", "noise")


def test_ranges_of_a_hot_hour_are_even(spark):
    placed = ordered.in_ranges(hot_hour(spark), ["account_id", "session_id"], ["event_time", "spin_id"])
    sizes = [r["count"] for r in placed.groupBy(ordered.SLOT).count().collect()]
    assert len(sizes) > 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    bounds = placed.groupBy(ordered.SLOT).agg(F.min(F.struct("account_id", "event_time", "spin_id")).alias("a"), F.max(F.struct("account_id", "event_time", "spin_id")).alias("b"))
    lines = bounds.orderBy(ordered.SLOT).collect()
    assert all(tuple(p.b) < tuple(q.a) for p, q in zip(lines, lines[1:]))


def test_tasks_of_a_hot_hour_are_even(spark, eager_splitting):
    """Behind the shuffle to (keys, range) no task has more than twice the mean rows."""
    placed = ordered.in_ranges(hot_hour(spark), ["account_id"], ["event_time", "spin_id"])
    tasks = [r["count"] for r in placed.repartition(8, "account_id", ordered.SLOT).groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 2 * sum(tasks) / 8


def test_losses_of_a_hot_hour(spark):
    rounds = hot_hour(spark, 6_000)
    found = {r.spin_id: r for r in sessions.session_losses(rounds).collect()}
    by = {}
    for r in sorted(rounds.collect(), key=lambda r: (r.account_id, r.event_time, r.spin_id)):
        by.setdefault(r.account_id, []).append(r)
    for history in by.values():
        loss, size, value = None, 0, 0.0
        nets = [r.win_amount - r.bet_money for r in history]
        for i, (r, net) in enumerate(zip(history, nets)):
            loss = r.event_time if net <= 0 else loss
            # A win counts once a loss of an earlier time lies before it.
            if loss is not None and r.event_time > loss:
                size, value = size + 1, value + net
            got = found[r.spin_id]
            assert got.last_loss == loss and got.win_streak_size == size and got.win_streak_value == pytest.approx(value)
            assert got.subsequent_profit == (None if i == len(nets) - 1 else pytest.approx(sum(nets[i + 1 :]), abs=1e-6))


def test_density_of_a_hot_hour(spark):
    df = hot_hour(spark).select("account_id", "event_time")
    widths = (2, 60)
    found = {r["account_id"]: r for r in sequences.payment_density(df, widths).collect()}
    by = {}
    for r in df.collect():
        by.setdefault(r.account_id, []).append(r.event_time.timestamp())
    assert found.keys() == by.keys()
    for account, times in by.items():
        times.sort()
        for w in widths:
            low, want = 0, 0
            for high, t in enumerate(times):
                while t - times[low] > 60 * w:
                    low += 1
                want = max(want, high - low + 1)
            assert found[account][f"max_num_payments_{w}_minutes"] == want


def test_running_sums_down_a_whole_table(spark):
    """In ranges of the order, many equal values included; nulls add nothing."""
    rows = [(i, 7 if i % 3 else i % 50, None if i % 11 == 0 else i % 5) for i in range(5_000)]
    df = spark.createDataFrame(rows, "id int, v int, x int").repartition(7)
    found = ordered.running_over_all(df, [F.desc("v"), F.asc("id")], {"upto": F.col("x"), "row": F.lit(1)})
    assert found.columns == ["id", "v", "x", "upto", "row"]
    upto, want = None, {}
    for n, (i, _, x) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        upto = x if upto is None else upto + (x or 0)
        want[i] = (upto, n)
    assert {r.id: (r.upto, r.row) for r in found.collect()} == want
    assert ordered.running_over_all(df.limit(0), [F.col("id")], {"upto": F.col("x")}).count() == 0


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.oracle and "L" not in {c[0] for c in q.covers}))
def test_no_products_and_no_global_windows(spark, folder, eager_splitting, name):
    plan = REGISTRY[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for window in re.findall(r"Window \[.*?\], \[(.*?)\]", plan):
        # Ordered as a whole are only totals of parts or ranges.
        assert window or "_part" in plan or "_slot" in plan, "a window over the whole table"
