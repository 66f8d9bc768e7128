"""The user-day panel: spine, daily facts, running features and outcome labels.

Everything after the rollups has the grain account x day of life, so no account can have more
rows than there are days; all windows share one exchange on the account.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.functions import timeunits as tu
from riskrules.functions.measures import rounded
from riskrules.operators.joins import after_registration, maturity_spine
from riskrules.operators.rollups import daily_activity, daily_payments, daily_tickets, daily_withdrawals
from riskrules.session import cut

OUTCOME_MINUTES = 30 * 24 * 60
# Days after its own that a row's features read at most.
LONGEST_LOOK_AHEAD = 13


def payment_days(registered: DataFrame, disputes: DataFrame, as_of: str) -> DataFrame:
    """Spine with the day's payments; days without payments are there with zeros.

    ``registered`` holds the payments after registration with their day of life.
    """
    spine = maturity_spine(payers_of(registered), registered, as_of)
    facts = daily_payments(registered, disputes)
    counts = ["new_payments", "payments_working_hours", "payments_sleeptime", "payments_weekend"]
    return spine.join(facts, ["account_id", "matuirity_day"], "left").na.fill(0, counts + ["spent", "highest_payment", "disputed_payments"])


def payers_of(registered_payments: DataFrame) -> DataFrame:
    """The accounts with a payment after registration, one row each."""
    return registered_payments.select("account_id", "register_time", "bundle_id").distinct()


def base_panel(roles, as_of: str) -> DataFrame:
    """Spine with the four daily fact tables, all unique on (account, day)."""
    key = ["account_id", "matuirity_day"]
    # Five parts of the plan start from these payments: they are joined with the users once.
    registered = cut(after_registration(roles.payments, roles.users))
    base = payment_days(registered, roles.disputes, as_of)
    payers = payers_of(registered)
    activity = daily_activity(roles.plays, payers).withColumnRenamed("bundle_id", "played_bundle")
    moved = daily_withdrawals(roles.withdrawals_applied, roles.withdrawals_paid, payers)
    contacts = daily_tickets(roles.tickets, payers)
    return base.join(activity, key, "left").join(moved, key, "left").join(contacts, key, "left")


def _account() -> Window:
    return Window.partitionBy("account_id")


def _by_day() -> Window:
    return Window.partitionBy("account_id").orderBy("matuirity_day")


def to_date(value: Column, how=F.sum) -> Column:
    return how(value).over(_by_day().rowsBetween(Window.unboundedPreceding, 0))


def trailing(value: Column, days: int, how=F.sum, exact: bool = False) -> Column:
    """Last days including today. As published the frame is ``days`` rows before and today, one
    day more than the name says; ``exact`` takes ``days`` days."""
    return how(value).over(_by_day().rowsBetween(-(days - 1) if exact else -days, 0))


def opening_average(value: Column, ahead: int, fixed: int | None = None) -> Column:
    """Average from the first day to ``ahead`` days after today, as published.

    With ``fixed`` the average is over the first ``fixed`` days instead, whatever today is.
    """
    if fixed is not None:
        return rounded(F.avg(F.when(F.col("matuirity_day") < fixed, value)).over(_account()), 2)
    return rounded(F.avg(value).over(_by_day().rowsBetween(Window.unboundedPreceding, ahead)), 2)


def history(value: Column) -> Column:
    """Array of the daily values up to today. Nulls must be gone: collect_list drops them."""
    return F.collect_list(value).over(_by_day().rowsBetween(Window.unboundedPreceding, 0))


def _flag(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def payment_features() -> dict[str, Column]:
    n, spent = F.col("new_payments"), F.col("spent")
    out = {"payments_to_date": to_date(n), "spent_to_date": to_date(spent)}
    for d in (14, 7, 3):
        out[f"payments_last_{d}d"] = trailing(n, d)
        out[f"spent_last_{d}d"] = trailing(spent, d)
    out["daily_spent_to_date"] = rounded(to_date(spent, F.avg), 2)
    out["daily_spent_last_7_d"] = rounded(trailing(spent, 7, F.avg), 2)
    for label, ahead in ((14, LONGEST_LOOK_AHEAD), (7, 7), (1, 0)):
        out[f"daily_spent_first_{label}d"] = opening_average(spent, ahead)
    out["max_daily_spent"] = to_date(spent, F.max)
    out["max_payment"] = to_date(F.col("highest_payment"), F.max)
    out["daily_payment_history_binary"] = history(_flag(n > 0))
    out["daily_payment_history_count"] = history(n)
    out["daily_spent_history_count"] = history(spent)
    return out


def activity_features() -> dict[str, Column]:
    games, money, bet, win = (F.col(c) for c in ("games_played", "money_games", "bet_money", "money_win"))
    out = {"games_to_date": to_date(games), "money_games_to_date": to_date(money)}
    for d in (14, 7):
        out[f"games_last_{d}d"] = trailing(games, d)
        out[f"money_games_last_{d}d"] = trailing(money, d)
        out[f"bet_money_last_{d}d"] = rounded(trailing(bet, d), 1)
        out[f"win_amount_last_{d}d"] = rounded(trailing(win, d), 2)
    out["max_games_daily_games"] = to_date(games, F.max)
    for label, ahead in ((14, LONGEST_LOOK_AHEAD), (7, 7), (1, 0)):
        out[f"daily_games_first_{label}d"] = opening_average(games, ahead)
    out["retention_sequence"] = history(_flag(games > 0))
    out["games_sequence"] = history(F.coalesce(games, F.lit(0)))
    out["days_betting_money_sequence"] = history(_flag(bet > 0))
    out["days_50_usd_bet_money_sequence"] = history(_flag(bet > 50))
    out["bet_money_to_date"] = rounded(to_date(bet), 1)
    out["win_amount_to_date"] = rounded(to_date(win), 2)
    out["max_bet_to_date"] = to_date(F.col("max_bet"), F.max)
    for part in ("before_6", "6_to_12", "12_to_18", "after_18"):
        out[f"local_time_{part}"] = F.coalesce(to_date(F.col(f"games_{part}")), F.lit(0))
    return out


def contact_features() -> dict[str, Column]:
    seen = F.coalesce("customer_service_interactions", F.lit(0))
    return {
        "last_contact_to_date": to_date(F.col("last_customer_service_interaction"), F.max),
        "contacts_to_date": to_date(seen),
    }


def withdrawal_features() -> dict[str, Column]:
    return {
        "withdrawn_attempted_ammount_to_date": F.coalesce(to_date(F.col("total_withdrawn_applied")), F.lit(0.0)),
        "withdrawn_attempt_to_date": F.coalesce(to_date(F.col("count_withdraw_apply")), F.lit(0)),
    }


def account_facts() -> dict[str, Column]:
    """What is fixed per account: firsts over all its days, whatever the row's day."""
    return {
        "first_payment": F.min("first_pay_time").over(_account()),
        "first_game_ever": F.min("first_game").over(_account()),
        "first_dispute": F.min("first_dispute_time").over(_account()),
        "first_withdrawal": F.min("first_withdrawn_attempt").over(_account()),
        "played_bundle_id": F.max("played_bundle").over(_account()),
    }


def timing_features() -> dict[str, Column]:
    register, day, paid = F.col("register_time"), F.col("matuirity_day"), F.col("first_payment")
    to_play = tu.complete_units("MINUTE", register, F.col("first_game_ever"))
    to_pay = tu.complete_units("MINUTE", register, paid)
    days_to_pay = tu.complete_units("DAY", register, paid)
    return {
        "minutes_to_play": to_play,
        "minutes_to_payment": to_pay,
        "minutes_to_pay_since_first_game": to_pay - to_play,
        "pay_matuirity": day - days_to_pay,
        "paying_matuirity": day - F.ceil(days_to_pay).cast("int"),
        "minutes_to_withdraw_since_first_payment": tu.complete_units("MINUTE", paid, F.col("first_withdrawal")),
    }


def outcome_labels() -> dict[str, Column]:
    """Disputed before the day's end, and disputed within 30 days from it."""
    limit = tu.add_days(F.col("register_time"), F.col("matuirity_day") + 1)
    wait = tu.complete_units("MINUTE", limit, F.col("first_dispute"))
    return {
        "limit_time": limit,
        "past_disputer": _flag(wait < 0),
        "new_disputer_30d": _flag(wait.between(0, OUTCOME_MINUTES)),
    }


def user_day_panel(roles, as_of: str, last_day: int | None = None) -> DataFrame:
    """All running features and labels per account and day of life.

    With ``last_day`` only rows up to that day come back, and the running histories are never built
    for later ones: their arrays grow with the day.
    """
    base = base_panel(roles, as_of).withColumns(account_facts())
    if last_day is not None:
        base = base.filter(F.col("matuirity_day") <= last_day + LONGEST_LOOK_AHEAD)
    features = {
        **timing_features(),
        **payment_features(),
        **activity_features(),
        **withdrawal_features(),
        **contact_features(),
        **outcome_labels(),
    }
    # One select: every window hangs on the same exchange and sort of (account, day).
    keep = ["account_id", "bundle_id", "register_time", "matuirity_day", "first_payment", "first_dispute", "played_bundle_id"]
    wide = base.select(*keep, *[c.alias(n) for n, c in features.items()])
    return wide if last_day is None else wide.filter(F.col("matuirity_day") <= last_day)


def not_yet_payers(panel: DataFrame, last_day: int = 35) -> DataFrame:
    """Rows of accounts that have not paid so far, are in their first days and never disputed."""
    return panel.filter((F.col("spent_to_date") == 0) & F.col("matuirity_day").between(0, last_day) & (F.col("past_disputer") == 0))
