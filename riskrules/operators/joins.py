"""Joins between events, users, payments and disputes.

Every join here is an equality on a key with the time condition as a residual. The event side is
always the streamed side of an inner join, so that a hot account's partition can be split. The side with
one row per account is hashed within its partition: events are not sorted, and a task that joins several
tables holds no sort buffers of each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.functions.timeunits import add_days, add_minutes, complete_units, maturity_day

WEEK_MINUTES = 7 * 24 * 60


def hashed(table: DataFrame) -> DataFrame:
    """A table with one row per key, to be hashed in each partition of a join and never sorted or broadcast."""
    return table.hint("shuffle_hash")


def after_registration(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events of known users that happen strictly after registration, with the day of life."""
    joined = events.join(hashed(users), "account_id").filter(F.col("event_time") > F.col("register_time"))
    return joined.withColumn("matuirity_day", maturity_day(F.col("register_time"), F.col("event_time")))


def with_disputes(payments: DataFrame, disputes: DataFrame, same_account: bool = True) -> DataFrame:
    """Payments with the time of their dispute, null when there is none.

    With ``same_account=False`` the dispute is found by payment id alone, and so may have been
    filed by another account.
    """
    if same_account:
        return payments.join(disputes.select("pay_id", "account_id", "dispute_time"), ["pay_id", "account_id"], "left")
    return payments.join(disputes.select("pay_id", "dispute_time"), "pay_id", "left")


def having_events(users: DataFrame, events: DataFrame) -> DataFrame:
    """Users with at least one event. The distinct accounts are built before the join."""
    return users.join(events.select("account_id").distinct(), "account_id", "left_semi")


def in_first_week(events: DataFrame, payers: DataFrame, minutes: int = WEEK_MINUTES) -> DataFrame:
    """Events in the closed interval from the first payment to ``minutes`` later."""
    window = payers.select("account_id", "first_pay_time")
    inside = F.col("event_time").between(F.col("first_pay_time"), add_minutes(F.col("first_pay_time"), minutes))
    return events.join(window, "account_id").filter(inside)


def keep_all(payers: DataFrame, measures: DataFrame, key: str = "account_id") -> DataFrame:
    """Every payer with its measures; payers without activity keep nulls."""
    return payers.join(hashed(measures), key, "left")


def within_horizon(events: DataFrame, users: DataFrame, days: int, unit: str = "DAY") -> DataFrame:
    """Events after registration and at most ``days`` complete days later."""
    age = complete_units(unit, F.col("register_time"), F.col("event_time"))
    limit = days if unit == "DAY" else days * 1440
    joined = events.join(hashed(users), "account_id")
    return joined.filter((F.col("event_time") > F.col("register_time")) & (age <= limit))


def withdrawals(applied: DataFrame, paid: DataFrame, same_account: bool = True) -> DataFrame:
    """Withdrawal applications with the payout that followed, if any."""
    asked = applied.select(
        "withdraw_id", "account_id", F.col("event_time").alias("apply_time"), (F.col("amount") - F.col("withdraw_fee")).alias("apply_amount")
    )
    done = paid.select(
        "withdraw_id",
        "account_id",
        F.col("event_time").alias("paid_time"),
        (F.col("amount") - F.col("withdraw_fee")).alias("paid_net_amount"),
        F.col("amount").alias("paid_amount"),
    )
    if same_account:
        return asked.join(done, ["withdraw_id", "account_id"], "left")
    return asked.join(done.drop("account_id"), "withdraw_id", "left")


def assembled(tables: Sequence[DataFrame], key: str = "account_id", how: str = "left") -> DataFrame:
    """Feature tables side by side on their key; all tables are unique on it."""
    return reduce(lambda a, b: a.join(hashed(b), key, how), tables)


def maturity_spine(users: DataFrame, days: DataFrame, as_of: str, outcome_days: int = 30) -> DataFrame:
    """One row per user and day of life, for days whose outcome window had closed at ``as_of``.

    ``days`` holds the days of life that occur in the data (column ``matuirity_day``). Each user
    is expanded only to the days that are over, so the product with all days never exists.
    """
    closed = F.datediff(F.lit(as_of).cast("date"), F.to_date("register_time")) - (outcome_days + 1)
    spine = users.filter(closed >= 0).withColumn("matuirity_day", F.explode(F.sequence(F.lit(0), closed)))
    # Distinct days of life: at most one row per calendar day covered by the log, so it is broadcast.
    known = days.select("matuirity_day").filter(F.col("matuirity_day").isNotNull()).distinct()
    return spine.join(F.broadcast(known), "matuirity_day", "left_semi")


def outcome_closed(panel: DataFrame, as_of: str, outcome_days: int = 30) -> DataFrame:
    """Panel rows whose outcome window ends before ``as_of``."""
    end = add_days(F.to_date("register_time").cast("timestamp"), F.col("matuirity_day") + outcome_days)
    return panel.filter(end < F.lit(as_of).cast("timestamp"))


def session_pairs(plays: DataFrame, results: DataFrame) -> DataFrame:
    """What the product of plays and results of a session adds up to, without building it.

    Every play of a session meets every result of it: counts multiply, sums over plays repeat once
    per result, and the extreme play-to-result times come from the extreme times of both sides.
    """
    keys = ["account_id", "session_id"]
    left = plays.groupBy(*keys).agg(
        F.count("*").alias("plays"),
        F.min("event_time").alias("first_play"),
        F.max("event_time").alias("last_play"),
        F.sum(F.col("win_amount") - F.col("bet_money")).alias("net"),
    )
    right = results.groupBy(*keys).agg(
        F.count("*").alias("results"), F.min("event_time").alias("first_result"), F.max("event_time").alias("last_result")
    )
    return left.join(right, keys).select(
        *keys,
        (F.col("plays") * F.col("results")).alias("pairs"),
        complete_units("SECOND", F.col("first_play"), F.col("last_result")).alias("longest_seconds"),
        complete_units("SECOND", F.col("last_play"), F.col("first_result")).alias("shortest_seconds"),
        (F.col("net") * F.col("results")).alias("net_over_pairs"),
    )
