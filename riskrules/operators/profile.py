"""Payer profile: measures of the first week after the first payment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrules.functions.measures import exceeds, finite, ratio, rounded
from riskrules.functions.timeunits import add_days, at_night, complete_units
from riskrules.operators.joins import WEEK_MINUTES, in_first_week, with_disputes
from riskrules.operators.sessions import session_losses
from riskrules.session import cut

DAY_37 = 37 * 24 * 60


def _age() -> Column:
    return complete_units("MINUTE", F.col("first_pay_time"), F.col("event_time"))


def first_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy("account_id").agg(F.min("event_time").alias("first_pay_time"))


def undisputed_at_first(paid: DataFrame, days: int = 7) -> DataFrame:
    """Payments without a dispute, or disputed more than ``days`` after the first payment."""
    late = F.col("first_pay_time") < add_days(F.col("dispute_time"), -days)
    return paid.filter(late | F.col("dispute_time").isNull())


def payers(payments: DataFrame, users: DataFrame, disputes: DataFrame, as_of: str) -> DataFrame:
    """Payments after registration with first payment, bundle and dispute, cohort filters applied.

    The first payment is taken over all payments of the account, before any other filter.
    """
    known = payments.join(users, "account_id").filter(F.col("event_time") > F.col("register_time"))
    started = known.join(first_payments(payments), "account_id").filter(F.col("first_pay_time") < add_days(F.lit(as_of).cast("timestamp"), -37))
    return undisputed_at_first(with_disputes(started, disputes))


def payment_measures(paid: DataFrame, disputes: DataFrame) -> DataFrame:
    """Spend, disputes and payment methods per payer.

    ``disputable_payment`` is what was paid until the account's first dispute, or until day 37
    when there is none.
    """
    amount, week = F.col("pay_amount").cast("double"), _age() <= WEEK_MINUTES
    disputed = complete_units("MINUTE", F.col("first_pay_time"), F.col("dispute_time")) <= DAY_37
    zero = F.lit(0.0)
    first_dispute = disputes.groupBy("account_id").agg(F.min("dispute_time").alias("first_dispute_time"))
    rows = paid.join(first_dispute, "account_id", "left")
    in_week = F.when(week, amount).otherwise(zero)
    until = F.when(F.col("first_dispute_time").isNotNull(), F.col("event_time") <= F.col("first_dispute_time")).otherwise(_age() <= DAY_37)
    sums = rows.groupBy("account_id", "first_pay_time", "bundle_id").agg(
        F.sum(in_week).alias("payment_d7"),
        F.sum(F.when(disputed, 1).otherwise(0)).alias("disputes_d30"),
        F.sum(F.when(disputed, amount).otherwise(zero)).alias("disputed_d30"),
        F.sum(F.when(until, amount).otherwise(zero)).alias("disputable_payment"),
        # Payment methods are a short list, so the set stays small.
        F.array_sort(F.collect_set(F.when(week, F.col("payment_type")))).alias("payment_methods_sequence"),
        F.stddev_samp(in_week).alias("payment_impulsiveness_score"),
    )
    return sums.withColumns(
        {"monetary_consumption_score": F.col("payment_d7"), "payment_methods_score": F.size("payment_methods_sequence")}
    )


def play_measures(plays: DataFrame, paid: DataFrame) -> DataFrame:
    """Machines, days and night share of the first week, and the growth of bets in the second."""
    rows = plays.join(paid.select("account_id", "first_pay_time"), "account_id")
    week, bet = _age() <= WEEK_MINUTES, F.col("bet_money")
    next_week = _age().between(WEEK_MINUTES, 2 * WEEK_MINUTES)
    # One row per account, machine and day holds both distinct counts: neither explodes.
    fine = rows.groupBy("account_id", "machine_id", F.to_date("event_time").alias("day")).agg(
        F.max(week).alias("week"),
        F.count_if(week).alias("plays"),
        F.count_if(week & at_night(F.col("event_time"))).alias("night"),
        F.sum(F.when(next_week, bet).otherwise(0.0)).alias("later"),
        F.sum(F.when(week, bet)).alias("first"),
    )
    sums = [F.sum(c).alias(c) for c in ("plays", "night", "later", "first")]
    machines = fine.groupBy("account_id", "machine_id").agg(F.max("week").alias("week"), *sums)
    per_account = machines.groupBy("account_id").agg(F.count_if(F.col("week") & F.col("machine_id").isNotNull()).alias("game_types"), *sums)
    days = fine.filter("week").select("account_id", "day").distinct().groupBy("account_id").agg(F.count("day").alias("days_played_score"))
    growth = rounded(ratio(F.col("later"), F.col("first")), 1)
    return per_account.join(days, "account_id", "left").select(
        "account_id",
        "game_types",
        F.coalesce("days_played_score", F.lit(0)).alias("days_played_score"),
        ratio(F.col("night"), F.col("plays")).alias("nightly_play"),
        finite(growth).alias("increasing_tolerance"),
    )


def session_measures(plays: DataFrame, results: DataFrame, paid: DataFrame) -> DataFrame:
    """Long sessions and losses of winnings among sessions with a result in the first week."""
    week_results = in_first_week(results, paid.select("account_id", "first_pay_time"))
    ends = week_results.groupBy("account_id", "session_id").agg(F.max("event_time").alias("last_result"))
    rounds = plays.join(ends, ["account_id", "session_id"])
    scored = session_losses(rounds)
    lost = exceeds(F.col("relative_loss"), 0.5)
    big = F.col("net_win") > 10
    per_session = scored.groupBy("account_id", "session_id").agg(
        complete_units("SECOND", F.min("event_time"), F.max("last_result")).alias("longest"),
        F.max(lost).alias("lost"),
        F.count_if(lost & big).alias("big_lost"),
        F.count_if(big).alias("big"),
    )
    return per_session.groupBy("account_id").agg(
        *[F.count_if(F.col("longest") > m * 60).alias(f"long_sessions_ps_score_{m}") for m in (180, 210, 240)],
        F.count_if(F.col("lost")).alias("losses_of_winning"),
        F.count("*").alias("cases"),
        ratio(F.sum("big_lost"), F.sum("big")).alias("losses_of_winning_score"),
    )


def withdrew(applied: DataFrame, paid: DataFrame) -> DataFrame:
    """1 when anything was withdrawn in the first week."""
    rows = in_first_week(applied, paid.select("account_id", "first_pay_time"))
    flag = F.when(F.sum("amount") > 0, 1).otherwise(0)
    return rows.groupBy("account_id").agg(flag.alias("user_withdrawed"))


def bet_volatility(plays: DataFrame, paid: DataFrame) -> DataFrame:
    rows = in_first_week(plays, paid.select("account_id", "first_pay_time"))
    spread = F.stddev_samp(F.when(F.col("bet_money") > 0, F.col("bet_money")))
    return rows.groupBy("account_id").agg(rounded(ratio(spread, F.sum("bet_money")), 2).alias("fluctuating_wagers"))


def time_played(starts: DataFrame, results: DataFrame, paid: DataFrame) -> DataFrame:
    """Seconds between the first and last event of a session, summed over sessions."""
    columns = ["account_id", "session_id", "event_time"]
    rows = in_first_week(starts.select(columns).unionByName(results.select(columns)), paid.select("account_id", "first_pay_time"))
    sessions = rows.groupBy("account_id", "session_id").agg(
        complete_units("SECOND", F.min("event_time"), F.max("event_time")).alias("playtime")
    )
    return sessions.groupBy("account_id").agg(F.sum("playtime").alias("time_comsumption"))


def payer_profile(roles, as_of: str) -> DataFrame:
    """One row per payer with every measure; payers without activity are kept."""
    paid = payers(roles.payments.filter(F.col("is_true").isNull() | F.col("is_true")), roles.users, roles.disputes, as_of)
    # One row per payer; every part below joins its events with this table.
    profile = cut(payment_measures(paid, roles.disputes))
    for part in (
        play_measures(roles.bets, profile),
        session_measures(roles.plays, roles.results, profile),
        withdrew(roles.withdrawals_applied, profile),
        bet_volatility(roles.bets, profile),
        time_played(roles.starts, roles.results, profile),
    ):
        profile = profile.join(part, "account_id", "left")
    zeros = ["game_types", "days_played_score", "losses_of_winning", "cases", "user_withdrawed"]
    return profile.na.fill(0, zeros + [f"long_sessions_ps_score_{m}" for m in (180, 210, 240)])


