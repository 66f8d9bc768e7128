"""Frames, labels and fan-out of the user-day panel on planted accounts."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from riskrules.operators import panel, rollups

REG = dt.datetime(2024, 1, 1, 12)
AS_OF = "2024-12-01"


def at(days=0, **more):
    return REG + dt.timedelta(days=days, **more)


def world(spark, payments, disputes=(), plays=(), applied=(), tickets=()):
    pay = [(i, 1, t, a, "m", True) for i, (t, a) in enumerate(payments)]
    return SimpleNamespace(
        users=spark.createDataFrame([(1, REG, "b")], "account_id long, register_time timestamp, bundle_id string"),
        payments=spark.createDataFrame(pay, "pay_id long, account_id long, event_time timestamp, pay_amount double, payment_type string, is_true boolean"),
        disputes=spark.createDataFrame([(p, 1, t, "fraud") for p, t in disputes], "pay_id long, account_id long, dispute_time timestamp, kind string"),
        plays=spark.createDataFrame(
            [(i, 1, t, 0.0, b, w, 1, 1) for i, (t, b, w) in enumerate(plays)],
            "spin_id long, account_id long, event_time timestamp, bet_chips double, bet_money double, win_amount double, machine_id int, session_id int",
        ),
        withdrawals_applied=spark.createDataFrame([(i, 1, t, a, 1.0) for i, (t, a) in enumerate(applied)], "withdraw_id long, account_id long, event_time timestamp, amount double, withdraw_fee double"),
        withdrawals_paid=spark.createDataFrame([], "withdraw_id long, account_id long, event_time timestamp, amount double, withdraw_fee double"),
        tickets=spark.createDataFrame([(1, t) for t in tickets], "account_id long, event_time timestamp"),
    )


def days_of(spark, roles):
    return {r["matuirity_day"]: r for r in panel.user_day_panel(roles, AS_OF).collect()}


def test_spine_has_only_days_that_occur(spark):
    roles = world(spark, [(at(0, hours=1), 5.0), (at(6, hours=1), 7.0)])
    assert sorted(days_of(spark, roles)) == [0, 6]


def test_trailing_frames_hold_one_day_more_than_their_name(spark):
    payments = [(at(d, hours=1), 10.0 if d in (0, 7, 14) else 0.0) for d in range(20)]
    rows = days_of(spark, world(spark, payments))
    assert rows[7]["spent_last_7d"] == 20.0 and rows[8]["spent_last_7d"] == 10.0
    assert rows[14]["spent_last_14d"] == 30.0
    df = spark.createDataFrame([(1, d, 10.0 if d in (0, 7) else 0.0) for d in range(9)], "account_id long, matuirity_day int, spent double")
    exact = df.withColumn("x", panel.trailing(F.col("spent"), 7, exact=True)).collect()
    assert {r["matuirity_day"]: r["x"] for r in exact}[7] == 10.0


def test_opening_average_grows_with_the_row(spark):
    df = spark.createDataFrame([(1, d, float(d)) for d in range(20)], "account_id long, matuirity_day int, spent double")
    got = {r["matuirity_day"]: (r["a"], r["b"]) for r in df.withColumns({"a": panel.opening_average(F.col("spent"), 13), "b": panel.opening_average(F.col("spent"), 13, fixed=14)}).collect()}
    assert got[0] == (6.5, 6.5)
    assert got[3] == (8.0, 6.5)


@pytest.mark.parametrize(
    "wait, past, new",
    [(dt.timedelta(minutes=-1), 1, 0), (dt.timedelta(0), 0, 1), (dt.timedelta(days=30), 0, 1), (dt.timedelta(days=30, minutes=1), 0, 0)],
)
def test_label_edges(spark, wait, past, new):
    end_of_day_0 = at(1)
    roles = world(spark, [(at(0, hours=1), 5.0)], disputes=[(0, end_of_day_0 + wait)])
    row = days_of(spark, roles)[0]
    assert (row["past_disputer"], row["new_disputer_30d"]) == (past, new)


def test_withdrawals_do_not_multiply_with_payments(spark):
    roles = world(spark, [(at(0, hours=1), 5.0), (at(0, hours=2), 5.0)], applied=[(at(0, hours=3), 21.0)])
    row = days_of(spark, roles)[0]
    assert (row["withdrawn_attempted_ammount_to_date"], row["withdrawn_attempt_to_date"], row["minutes_to_withdraw_since_first_payment"]) == (20.0, 1, 120)


def test_histories_keep_idle_days(spark):
    roles = world(spark, [(at(0, hours=1), 5.0), (at(1, hours=1), 0.0), (at(2, hours=1), 9.0)], plays=[(at(0, hours=2), 60.0, 1.0), (at(2, hours=2), 5.0, 0.0)], tickets=[at(1, hours=3), at(1, hours=3)])
    row = days_of(spark, roles)[2]
    assert row["daily_payment_history_binary"] == [1, 0, 1]
    assert row["daily_spent_history_count"] == [5.0, 0.0, 9.0]
    assert (row["retention_sequence"], row["games_sequence"]) == ([1, 0, 1], [1, 0, 1])
    assert (row["days_betting_money_sequence"], row["days_50_usd_bet_money_sequence"]) == ([1, 0, 1], [1, 0, 0])
    assert (row["contacts_to_date"], row["pay_matuirity"], row["minutes_to_pay_since_first_game"]) == (1, 2, -60)


def test_outcome_window_must_be_closed(spark):
    roles = world(spark, [(at(d, hours=1), 1.0) for d in range(5)])
    kept = sorted(r["matuirity_day"] for r in panel.user_day_panel(roles, "2024-02-03").collect())
    assert kept == [0, 1, 2]


def test_early_days_do_not_depend_on_the_cut(spark):
    payments = [(at(d, hours=1), float(d + 1)) for d in range(3, 40)]
    roles = world(spark, payments, disputes=[(20, at(25))], plays=[(at(d, hours=3), 1.0 + d, 0.5) for d in (4, 30)])
    whole = {d: r for d, r in days_of(spark, roles).items() if d <= 6}
    early = {r["matuirity_day"]: r for r in panel.user_day_panel(roles, AS_OF, last_day=6).collect()}
    assert early == whole and whole[3]["daily_spent_first_14d"] == pytest.approx(sum(range(4, 18)) / 14)


def test_horizons_beyond_the_join_stop_growing(spark):
    roles = world(spark, [(at(10), 1.0), (at(89), 2.0), (at(120), 4.0)])
    row = rollups.spend_horizons(roles.payments, roles.users).first()
    assert (row["p7"], row["p14"], row["p91"], row["p133"], row["cp7"]) == (0.0, 1.0, 3.0, 3.0, 0.0)


def test_last_row_of_running_sums_is_the_total(spark):
    payments = [(at(d, hours=1), float(d + 1)) for d in range(12)]
    rows = days_of(spark, world(spark, payments))
    assert rows[11]["spent_to_date"] == sum(a for _, a in payments)
    assert rows[11]["payments_to_date"] == 12
