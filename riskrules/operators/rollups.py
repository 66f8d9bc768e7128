"""Daily and horizon rollups per account.

Counts of distinct ids are taken in two steps: first one row per id with the facts needed, then
the rollup. The first step pre-aggregates on the mapper and spreads a hot account over its ids,
and no column is expanded once per distinct count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrules.functions import timeunits as tu
from riskrules.operators.joins import after_registration, keep_all, with_disputes, within_horizon, withdrawals

DAY_KEYS = ["account_id", "matuirity_day"]


def daily_activity(plays: DataFrame, users: DataFrame) -> DataFrame:
    """Rounds played per account and day of life."""
    rounds = after_registration(plays, users)
    per_spin = rounds.groupBy(*DAY_KEYS, "spin_id").agg(
        F.max("bundle_id").alias("bundle_id"),
        F.min("event_time").alias("first"),
        F.max("event_time").alias("last"),
        F.max(F.col("bet_chips") > 0).alias("on_chips"),
        F.max(F.col("bet_money") > 0).alias("on_money"),
        F.max((F.col("bet_money") > 0) & (F.col("win_amount") > 0)).alias("won"),
        F.sum("bet_money").alias("bet"),
        F.max("bet_money").alias("top_bet"),
        F.sum(F.when(F.col("bet_money") > 0, F.col("win_amount")).otherwise(0.0)).alias("win"),
        *[
            F.sum(F.when(tu.local_time_bucket(F.col("event_time")) == q, 1).otherwise(0)).alias(f"quarter_{q}")
            for q in range(4)
        ],
    )
    return per_spin.groupBy(*DAY_KEYS).agg(
        F.max("bundle_id").alias("bundle_id"),
        F.min("first").alias("first_game"),
        F.count("spin_id").alias("games_played"),
        F.count_if(F.col("on_chips") & F.col("spin_id").isNotNull()).alias("chip_games"),
        F.count_if(F.col("on_money") & F.col("spin_id").isNotNull()).alias("money_games"),
        F.count_if(F.col("won") & F.col("spin_id").isNotNull()).alias("money_games_wins"),
        F.min("first").alias("started_playing"),
        F.max("last").alias("finished_playing"),
        F.sum("bet").alias("bet_money"),
        F.max("top_bet").alias("max_bet"),
        F.sum("win").alias("money_win"),
        F.sum("quarter_0").alias("games_before_6"),
        F.sum("quarter_1").alias("games_6_to_12"),
        F.sum("quarter_2").alias("games_12_to_18"),
        F.sum("quarter_3").alias("games_after_18"),
    )


def daily_payments(registered: DataFrame, disputes: DataFrame) -> DataFrame:
    """Payments after registration per account and day of life, with their disputes."""
    paid = with_disputes(registered, disputes)
    time, positive = F.col("event_time"), F.col("pay_amount") > 0
    def count(test: Column) -> Column:
        return F.sum(F.when(test, 1).otherwise(0))

    return paid.groupBy(*DAY_KEYS).agg(
        count(positive).alias("new_payments"),
        F.sum(F.when(F.col("dispute_time").isNull(), 0.0).otherwise(F.col("pay_amount"))).alias("disputed_payments"),
        F.coalesce(F.sum("pay_amount"), F.lit(0.0)).alias("spent"),
        F.min(time).alias("first_pay_time"),
        F.min("dispute_time").alias("first_dispute_time"),
        F.coalesce(F.max("pay_amount"), F.lit(0.0)).alias("highest_payment"),
        F.max(F.hour(time)).alias("last_payment_time"),
        count(tu.in_working_hours(time) & positive).alias("payments_working_hours"),
        count(tu.in_waking_hours(time) & positive).alias("payments_sleeptime"),
        count(tu.on_weekend(time) & positive).alias("payments_weekend"),
    )


def daily_withdrawals(applied: DataFrame, paid: DataFrame, users: DataFrame) -> DataFrame:
    """Withdrawal attempts per account and day of life.

    ``users`` is unique per account, so an amount counts once however many payments there are.
    """
    asked = withdrawals(applied, paid).withColumn("event_time", F.col("apply_time"))
    per_time = after_registration(asked, users).groupBy(*DAY_KEYS, "apply_time").agg(F.sum("apply_amount").alias("amount"))
    return per_time.groupBy(*DAY_KEYS).agg(
        F.min("apply_time").alias("first_withdrawn_attempt"),
        F.count("apply_time").alias("count_withdraw_apply"),
        F.sum("amount").alias("total_withdrawn_applied"),
    )


def daily_tickets(tickets: DataFrame, users: DataFrame) -> DataFrame:
    """Customer-service contacts per account and day of life."""
    per_time = after_registration(tickets, users).groupBy(*DAY_KEYS, "event_time").agg(F.lit(1).alias("seen"))
    return per_time.groupBy(*DAY_KEYS).agg(
        F.count("event_time").alias("customer_service_interactions"), F.max("event_time").alias("last_customer_service_interaction")
    )


def dispute_rates(payments: DataFrame, users: DataFrame, disputes: DataFrame) -> DataFrame:
    """Share of disputed payments and number of payments per account.

    A payment counts as the average over its disputes, hence the aggregate per payment first. The
    dispute is found by payment id alone.
    """
    paid = with_disputes(after_registration(payments, users), disputes, same_account=False)
    per_payment = paid.groupBy("account_id", "register_time", "pay_id", "event_time").agg(
        F.avg(F.when(F.col("dispute_time").isNotNull(), 1.0).otherwise(0.0)).alias("is_disputed")
    )
    return per_payment.groupBy("account_id", "register_time").agg(
        F.avg("is_disputed").alias("dispute_rate"), F.count("*").alias("valid_payments")
    )


# The horizons of the published feature tables, as (column, unit, limit).
SPEND_HORIZONS = [(f"p{d}", "DAY", d) for d in (1, 2, 3, 4, 5, 6, 7, 14, 28, 35, 42, 49, 56, 91, 133)] + [("ph1", "HOUR", 1), ("ph6", "HOUR", 6)]
COUNT_HORIZONS = [("cp1", "DAY", 1), ("cp3", "DAY", 3), ("cp7", "DAY", 7)]
WITHDRAWAL_HORIZONS = [(f"w{d}", "DAY", d) for d in (1, 3, *range(7, 29))]
GAME_HORIZONS = [(f"games_played_d{d}", "DAY", d) for d in range(1, 8)] + [("games_played_h1", "HOUR", 1)]
AD_HORIZONS = [(f"ad{d}", "DAY", d) for d in (1, 2, 3, 4, 5, 6, 7, 28)]
CURRENCY_DAYS = (1, 3, 7)

Horizon = tuple[str, str, int]


def horizon_sums(horizons: Sequence[Horizon], value: Column, time: str = "event_time") -> list[Column]:
    """One sum per horizon, all in the same aggregate."""
    age = {u: tu.complete_units(u, F.col("register_time"), F.col(time)) for _, u, _ in horizons}
    zero = F.lit(0).cast("double")
    return [F.sum(F.when(age[unit] <= limit, value).otherwise(zero)).alias(name) for name, unit, limit in horizons]


def _zero_filled(df: DataFrame, horizons: Sequence[Horizon]) -> DataFrame:
    return df.na.fill(0, [name for name, _, _ in horizons])


def spend_horizons(payments: DataFrame, users: DataFrame, join_days: int = 90) -> DataFrame:
    """Amount and number of payments up to each horizon, for every user.

    Payments later than ``join_days`` never join, so horizons beyond it stop growing there.
    """
    rows = within_horizon(payments, users, join_days)
    one = F.lit(1).cast("double")
    sums = rows.groupBy("account_id").agg(*horizon_sums(SPEND_HORIZONS, F.col("pay_amount")), *horizon_sums(COUNT_HORIZONS, one))
    return _zero_filled(keep_all(users.select("account_id", "register_time"), sums), SPEND_HORIZONS + COUNT_HORIZONS)


def withdrawal_horizons(applied: DataFrame, paid: DataFrame, users: DataFrame, join_days: int = 30) -> DataFrame:
    """Amount paid out up to each horizon; payouts before ``join_days`` after registration."""
    # The account is the applicant's; the payout is found by id alone.
    done = withdrawals(applied, paid, same_account=False).select("account_id", F.col("paid_time").alias("event_time"), F.col("paid_amount").alias("amount"))
    rows = done.join(users, "account_id").filter(
        (F.col("event_time") > F.col("register_time")) & (F.col("event_time") < tu.add_days(F.col("register_time"), join_days))
    )
    sums = rows.groupBy("account_id").agg(*horizon_sums(WITHDRAWAL_HORIZONS, F.col("amount")))
    return _zero_filled(keep_all(users.select("account_id"), sums), WITHDRAWAL_HORIZONS)


def game_horizons(starts: DataFrame, users: DataFrame, join_days: int = 30) -> DataFrame:
    """Distinct games up to each horizon: a game counts from its first start on."""
    first = within_horizon(starts, users, join_days).groupBy("account_id", "register_time", "game_id").agg(F.min("event_time").alias("event_time"))
    known = F.when(F.col("game_id").isNotNull(), 1.0).otherwise(0.0)
    sums = first.groupBy("account_id").agg(*horizon_sums(GAME_HORIZONS, known))
    return _zero_filled(keep_all(users.select("account_id"), sums), GAME_HORIZONS)


def currency_horizons(changes: DataFrame, users: DataFrame) -> DataFrame:
    """Balance of every currency 1, 3 and 7 days (in minutes) after registration."""
    rows = changes.join(users, "account_id").filter(F.col("event_time") > F.col("register_time"))
    horizons = {c: [(f"{c}_status_d{d}", "MINUTE", d * 1440) for d in CURRENCY_DAYS] for c in ("coin", "bonus", "money")}
    sums = [col for c, hs in horizons.items() for col in horizon_sums(hs, F.col(f"{c}_change"))]
    names = [h for hs in horizons.values() for h in hs]
    return _zero_filled(keep_all(users.select("account_id"), rows.groupBy("account_id").agg(*sums)), names)


def ad_horizons(ads: DataFrame, users: DataFrame, join_days: int = 30) -> DataFrame:
    rows = within_horizon(ads, users, join_days)
    sums = rows.groupBy("account_id").agg(*horizon_sums(AD_HORIZONS, F.col("revenue")))
    return _zero_filled(keep_all(users.select("account_id"), sums), AD_HORIZONS)


def hour_windows(
    events: DataFrame, starts: DataFrame, value: str, prefix: str, hours: Sequence[float] = (0.25, 0.5, 1, 6, 24, 48, 72, 96, 168)
) -> DataFrame:
    """Amount up to each number of hours after ``first_pay_time``, from event rows."""
    rows = events.join(starts.select("account_id", "first_pay_time"), "account_id")
    age = F.unix_micros("event_time") - F.unix_micros("first_pay_time")
    sums = [
        F.sum(F.when(age <= F.lit(int(h * 3_600_000_000)), F.col(value)).otherwise(F.lit(0.0))).alias(f"{prefix}_within_{h:g}_hours") for h in hours
    ]
    return rows.groupBy("account_id").agg(*sums)


def revenue_curve(payments: DataFrame, last_day: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Average revenue per payer active on each day since the payer's first payment."""
    first = payments.groupBy("account_id").agg(F.min("event_time").alias("first_pay_time"))
    days = payments.join(first, "account_id").withColumn(
        "days_since_first_payment", F.datediff(F.to_date("event_time"), F.to_date("first_pay_time"))
    )
    per_payer = days.filter(F.col("days_since_first_payment") <= last_day).groupBy(*by, "account_id", "days_since_first_payment")
    revenue = per_payer.agg(F.sum("pay_amount").alias("revenue"))
    return revenue.groupBy(*by, "days_since_first_payment").agg(F.avg("revenue").alias("average_total_net_revenue"), F.count("*").alias("payers"))


def sums_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Several measures of the same groups in one pass, instead of one group-by each and merges."""
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
