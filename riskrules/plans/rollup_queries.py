"""Daily rollups, horizon pivots, the payer profile and summary reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskrules.functions.measures import binary_label
from riskrules.functions.timeunits import day_number, day_text, in_waking_hours, in_working_hours, on_weekend, shift_hours
from riskrules.operators import profile, reports, rollups, sequences, sessions
from riskrules.operators.binning import time_blocks
from riskrules.operators.joins import after_registration, with_disputes
from riskrules.plans.registry import query, rd, rds, sql_rd, sql_rds, sql_time, when_text
from riskrules.sources.roles import AS_OF

DAY = "CAST(floor(date_sub('minute', u.register_time, {t}) / 1440.0) AS INTEGER)"

ACTIVITY_SQL = f"""
act AS (
  SELECT a.account_id, {DAY.format(t='a.event_time')} AS matuirity_day, max(u.bundle_id) AS bundle_id, min(a.event_time) AS first_game,
    count(DISTINCT spin_id) AS games_played, count(DISTINCT CASE WHEN bet_chips > 0 THEN spin_id END) AS chip_games,
    count(DISTINCT CASE WHEN bet_money > 0 THEN spin_id END) AS money_games,
    count(DISTINCT CASE WHEN bet_money > 0 AND win_amount > 0 THEN spin_id END) AS money_games_wins,
    max(a.event_time) AS finished_playing, sum(bet_money) AS bet_money, max(bet_money) AS max_bet,
    sum(CASE WHEN bet_money > 0 THEN win_amount ELSE 0 END) AS money_win,
    sum(CASE WHEN hour(a.event_time) < 6 THEN 1 ELSE 0 END) AS games_before_6,
    sum(CASE WHEN hour(a.event_time) BETWEEN 6 AND 11 THEN 1 ELSE 0 END) AS games_6_to_12,
    sum(CASE WHEN hour(a.event_time) BETWEEN 12 AND 17 THEN 1 ELSE 0 END) AS games_12_to_18,
    sum(CASE WHEN hour(a.event_time) >= 18 THEN 1 ELSE 0 END) AS games_after_18
  FROM plays a JOIN usr u ON a.account_id = u.account_id AND a.event_time > u.register_time GROUP BY 1, 2)"""

PAYMENT_SQL = """
pday AS (
  SELECT r.account_id, r.matuirity_day, sum(CASE WHEN pay_amount > 0 THEN 1 ELSE 0 END) AS new_payments,
    sum(CASE WHEN d.dispute_time IS NULL THEN 0 ELSE pay_amount END) AS disputed_payments, coalesce(sum(pay_amount), 0) AS spent,
    min(event_time) AS first_pay_time, min(d.dispute_time) AS first_dispute_time, coalesce(max(pay_amount), 0) AS highest_payment,
    max(hour(event_time)) AS last_payment_time,
    sum(CASE WHEN hour(event_time) BETWEEN 9 AND 17 AND pay_amount > 0 THEN 1 ELSE 0 END) AS payments_working_hours,
    sum(CASE WHEN hour(event_time) BETWEEN 6 AND 23 AND pay_amount > 0 THEN 1 ELSE 0 END) AS payments_sleeptime,
    sum(CASE WHEN isodow(event_time) > 5 AND pay_amount > 0 THEN 1 ELSE 0 END) AS payments_weekend
  FROM regpay r LEFT JOIN disp d ON r.pay_id = d.pay_id AND r.account_id = d.account_id GROUP BY 1, 2)"""

WITHDRAWAL_SQL = f"""
wday AS (
  SELECT w.account_id, {DAY.format(t='w.event_time')} AS matuirity_day, min(w.event_time) AS first_withdrawn_attempt,
    count(DISTINCT w.event_time) AS count_withdraw_apply, sum(w.amount - w.withdraw_fee) AS total_withdrawn_applied
  FROM applied w JOIN usr u ON w.account_id = u.account_id AND w.event_time > u.register_time GROUP BY 1, 2)"""

TICKET_SQL = f"""
tday AS (
  SELECT t.account_id, {DAY.format(t='t.event_time')} AS matuirity_day, count(DISTINCT t.event_time) AS customer_service_interactions,
    max(t.event_time) AS last_customer_service_interaction
  FROM tickets t JOIN usr u ON t.account_id = u.account_id AND t.event_time > u.register_time GROUP BY 1, 2)"""

_ACT_COUNTS = ["games_played", "chip_games", "money_games", "money_games_wins", "games_before_6", "games_6_to_12", "games_12_to_18", "games_after_18"]
_PAY_COUNTS = ["new_payments", "last_payment_time", "payments_working_hours", "payments_sleeptime", "payments_weekend"]


def _big(names):
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


@query("D1", "D30", oracle=f"""
,{ACTIVITY_SQL}
SELECT account_id, matuirity_day, bundle_id, {sql_time('first_game')} AS first_game, {sql_time('finished_playing')} AS finished_playing,
  {_big(_ACT_COUNTS)}, {sql_rds(['bet_money', 'max_bet', 'money_win'], 2)} FROM act
""")
def daily_activity(r):
    days = rollups.daily_activity(r.plays, r.users)
    return days.select(
        "account_id", "matuirity_day", "bundle_id", when_text("first_game").alias("first_game"), when_text("finished_playing").alias("finished_playing"),
        *_ACT_COUNTS, *rds(["bet_money", "max_bet", "money_win"], 2),
    )


@query("D2", "H35", oracle=f"""
,{PAYMENT_SQL}
SELECT account_id, matuirity_day, {_big(_PAY_COUNTS)}, {sql_rds(['disputed_payments', 'spent', 'highest_payment'], 2)},
  {sql_time('first_pay_time')} AS first_pay, {sql_time('first_dispute_time')} AS first_dispute FROM pday
""")
def daily_payments(r):
    days = rollups.daily_payments(after_registration(r.payments, r.users), r.disputes)
    return days.select(
        "account_id", "matuirity_day", *_PAY_COUNTS, *rds(["disputed_payments", "spent", "highest_payment"], 2),
        when_text("first_pay_time").alias("first_pay"), when_text("first_dispute_time").alias("first_dispute"),
    )


@query("D3", oracle=f"""
,{WITHDRAWAL_SQL}
SELECT account_id, matuirity_day, {sql_time('first_withdrawn_attempt')} AS first_attempt, CAST(count_withdraw_apply AS BIGINT) AS count_withdraw_apply,
  {sql_rds(['total_withdrawn_applied'], 2)} FROM wday
""")
def daily_withdrawals(r):
    days = rollups.daily_withdrawals(r.withdrawals_applied, r.withdrawals_paid, r.users)
    return days.select(
        "account_id", "matuirity_day", when_text("first_withdrawn_attempt").alias("first_attempt"), "count_withdraw_apply", *rds(["total_withdrawn_applied"], 2)
    )


@query("D4", oracle=f"""
,{TICKET_SQL}
SELECT account_id, matuirity_day, CAST(customer_service_interactions AS BIGINT) AS customer_service_interactions,
  {sql_time('last_customer_service_interaction')} AS last_contact FROM tday
""")
def daily_tickets(r):
    days = rollups.daily_tickets(r.tickets, r.users)
    return days.select("account_id", "matuirity_day", "customer_service_interactions", when_text("last_customer_service_interaction").alias("last_contact"))


RATES_SQL = """
rates AS (
  SELECT account_id, register_time, avg(is_disputed) AS dispute_rate, count(*) AS valid_payments FROM (
    SELECT p.account_id, u.register_time, p.pay_id, p.event_time, avg(CASE WHEN c.dispute_time IS NOT NULL THEN 1.0 ELSE 0.0 END) AS is_disputed
    FROM (SELECT * FROM pay WHERE is_true IS NULL OR is_true) p JOIN usr u ON p.account_id = u.account_id AND p.event_time > u.register_time
    LEFT JOIN (SELECT * FROM disp WHERE kind = 'pay_dispute') c ON p.pay_id = c.pay_id GROUP BY 1, 2, 3, 4) GROUP BY 1, 2)"""


def confirmed_rates(r):
    confirmed = r.payments.filter(F.col("is_true").isNull() | F.col("is_true"))
    return rollups.dispute_rates(confirmed, r.users, r.disputes.filter("kind = 'pay_dispute'"))


@query("D5", "A1", "B1", "C1", "C3", oracle=f"""
,{RATES_SQL}
SELECT account_id, {sql_time('register_time')} AS registered, {sql_rd('dispute_rate')} AS dispute_rate, CAST(valid_payments AS BIGINT) AS valid_payments FROM rates
""")
def dispute_rates(r):
    return confirmed_rates(r).select("account_id", when_text("register_time").alias("registered"), rd("dispute_rate").alias("dispute_rate"), "valid_payments")


def _pivot_sql(table, horizons, value, extra="", cast="DOUBLE", zero="0"):
    parts = [
        f"{sql_rd(f'sum(CASE WHEN date_sub({unit.lower()!r}, a.register_time, b.event_time) <= {limit} THEN {value} ELSE {zero} END)', 2)} AS {name}"
        for name, unit, limit in horizons
    ]
    return f"""
SELECT a.account_id, {', '.join(parts)} FROM usr a LEFT JOIN {table} b ON a.account_id = b.account_id AND a.register_time < b.event_time {extra} GROUP BY 1
"""


_SPEND = _pivot_sql("pay", rollups.SPEND_HORIZONS + [], "pay_amount", "AND date_sub('day', a.register_time, b.event_time) <= 90")
_COUNT_PARTS = ", ".join(
    f"CAST(sum(CASE WHEN date_sub('day', a.register_time, b.event_time) <= {d} THEN 1 ELSE 0 END) AS DOUBLE) AS {n}" for n, _, d in rollups.COUNT_HORIZONS
)


@query("D6", oracle=_SPEND.replace("SELECT a.account_id,", f"SELECT a.account_id, {_COUNT_PARTS},"))
def spend_horizons(r):
    wide = rollups.spend_horizons(r.payments, r.users)
    return wide.select("account_id", *rds([n for n, _, _ in rollups.SPEND_HORIZONS], 2), *[n for n, _, _ in rollups.COUNT_HORIZONS])


_WITHDRAWN = """
, w AS (SELECT b.* FROM applied x JOIN paid_out b ON x.withdraw_id = b.withdraw_id)""" + _pivot_sql(
    "w", rollups.WITHDRAWAL_HORIZONS, "amount", "AND b.event_time < a.register_time + INTERVAL 30 DAY"
)


@query("D7", oracle=_WITHDRAWN)
def withdrawal_horizons(r):
    wide = rollups.withdrawal_horizons(r.withdrawals_applied, r.withdrawals_paid, r.users)
    return wide.select("account_id", *rds([n for n, _, _ in rollups.WITHDRAWAL_HORIZONS], 2))


_GAMES = ", ".join(
    f"CAST(count(DISTINCT CASE WHEN date_sub('{u.lower()}', a.register_time, b.event_time) <= {d} THEN game_id END) AS DOUBLE) AS {n}"
    for n, u, d in rollups.GAME_HORIZONS
)


@query("D8", oracle=f"""
SELECT a.account_id, {_GAMES} FROM usr a LEFT JOIN starts b ON a.account_id = b.account_id AND a.register_time < b.event_time
AND date_sub('day', a.register_time, b.event_time) <= 30 GROUP BY 1
""")
def game_horizons(r):
    return rollups.game_horizons(r.starts, r.users)


_CURRENCY = [(f"{c}_status_d{d}", "MINUTE", d * 1440, f"{c}_change") for c in ("coin", "bonus", "money") for d in rollups.CURRENCY_DAYS]
_CURRENCY_SQL = ", ".join(
    sql_rd(f"sum(CASE WHEN date_sub('minute', a.register_time, b.event_time) <= {m} THEN {v} ELSE 0 END)", 2) + f" AS {n}" for n, _, m, v in _CURRENCY
)


@query("D9", oracle=f"""
SELECT a.account_id, {_CURRENCY_SQL} FROM usr a LEFT JOIN currency b ON a.account_id = b.account_id AND a.register_time < b.event_time GROUP BY 1
""")
def currency_horizons(r):
    return rollups.currency_horizons(r.currency_changes, r.users).select("account_id", *rds([n for n, *_ in _CURRENCY], 2))


@query("D10", oracle=_pivot_sql("ads", rollups.AD_HORIZONS, "revenue", "AND date_sub('day', a.register_time, b.event_time) <= 30"))
def ad_horizons(r):
    return rollups.ad_horizons(r.ads, r.users).select("account_id", *rds([n for n, _, _ in rollups.AD_HORIZONS], 2))


# --- payer profile -------------------------------------------------------------------------

_AGE = "date_sub('minute', first_pay_time, {t})"
PAYER_SQL = f"""
conf AS (SELECT *, min(event_time) OVER (PARTITION BY account_id) AS first_pay_time FROM pay WHERE is_true IS NULL OR is_true),
fdisp AS (SELECT account_id, min(dispute_time) AS first_dispute_time FROM disp GROUP BY 1),
prow AS (
  SELECT c.*, u.register_time, u.bundle_id, d.dispute_time, f.first_dispute_time FROM conf c
  JOIN usr u ON c.account_id = u.account_id AND c.event_time > u.register_time
  LEFT JOIN disp d ON c.pay_id = d.pay_id AND c.account_id = d.account_id LEFT JOIN fdisp f ON c.account_id = f.account_id
  WHERE c.first_pay_time < TIMESTAMP '{AS_OF}' - INTERVAL 37 DAY AND (c.first_pay_time < d.dispute_time - INTERVAL 7 DAY OR d.dispute_time IS NULL)),
payer AS (
  SELECT account_id, first_pay_time, bundle_id,
    sum(CASE WHEN {_AGE.format(t='event_time')} <= 10080 THEN pay_amount ELSE 0 END) AS payment_d7,
    sum(CASE WHEN {_AGE.format(t='dispute_time')} <= 53280 THEN 1 ELSE 0 END) AS disputes_d30,
    sum(CASE WHEN {_AGE.format(t='dispute_time')} <= 53280 THEN pay_amount ELSE 0 END) AS disputed_d30,
    sum(CASE WHEN first_dispute_time IS NOT NULL THEN CASE WHEN event_time <= first_dispute_time THEN pay_amount ELSE 0 END
        WHEN {_AGE.format(t='event_time')} <= 53280 THEN pay_amount ELSE 0 END) AS disputable_payment,
    count(DISTINCT CASE WHEN {_AGE.format(t='event_time')} <= 10080 THEN payment_type END) AS payment_methods_score,
    array_to_string(list_sort(list(DISTINCT CASE WHEN {_AGE.format(t='event_time')} <= 10080 THEN payment_type END) FILTER (WHERE {_AGE.format(t='event_time')} <= 10080)), ',') AS methods,
    stddev_samp(CASE WHEN {_AGE.format(t='event_time')} <= 10080 THEN pay_amount ELSE 0 END) AS payment_impulsiveness_score
  FROM prow GROUP BY 1, 2, 3)"""

_PLAY = """
play_m AS (
  SELECT p.account_id,
    count(DISTINCT CASE WHEN {age} <= 10080 THEN machine_id END) AS game_types,
    count(DISTINCT CASE WHEN {age} <= 10080 THEN CAST(event_time AS DATE) END) AS days_played_score,
    CAST(sum(CASE WHEN {age} <= 10080 AND hour(event_time) < 6 THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN {age} <= 10080 THEN 1 ELSE 0 END), 0) AS nightly_play,
    sum(CASE WHEN {age} BETWEEN 10080 AND 20160 THEN bet_money ELSE 0 END) / nullif(sum(CASE WHEN {age} <= 10080 THEN bet_money END), 0) AS increasing_tolerance
  FROM plays a JOIN payer p ON a.account_id = p.account_id GROUP BY 1)""".format(age=_AGE.format(t="event_time"))

LOSS_SQL = """
rnd AS (
  SELECT *, win_amount - bet_money AS net_win,
    max(CASE WHEN win_amount - bet_money > 0 THEN NULL ELSE event_time END) OVER s AS last_loss FROM {rounds}
  WINDOW s AS (PARTITION BY account_id, session_id ORDER BY event_time, spin_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
streak AS (
  SELECT *, sum(CASE WHEN event_time > last_loss THEN 1 ELSE 0 END) OVER s AS win_streak_size,
    sum(CASE WHEN event_time > last_loss THEN net_win ELSE 0 END) OVER s AS win_streak_value,
    round(sum(net_win) OVER (PARTITION BY account_id, session_id ORDER BY event_time, spin_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 6) AS subsequent_profit
  FROM rnd WINDOW s AS (PARTITION BY account_id, session_id ORDER BY event_time, spin_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
loss AS (
  SELECT *, CASE WHEN win_streak_value <> 0 THEN 1 - (win_streak_value + subsequent_profit) / win_streak_value
      WHEN subsequent_profit < 0 THEN CAST('infinity' AS DOUBLE) WHEN subsequent_profit > 0 THEN CAST('-infinity' AS DOUBLE) END AS relative_loss
  FROM streak)"""

_SESSION = f"""
ends AS (
  SELECT b.account_id, b.session_id, max(b.event_time) AS last_result FROM results b JOIN payer p ON b.account_id = p.account_id
  WHERE b.event_time BETWEEN p.first_pay_time AND p.first_pay_time + INTERVAL 10080 MINUTE GROUP BY 1, 2),
rounds_in AS (SELECT a.*, e.last_result FROM plays a JOIN ends e ON a.account_id = e.account_id AND a.session_id = e.session_id),
{LOSS_SQL.format(rounds='rounds_in')},
sess AS (
  SELECT account_id, session_id, max(date_sub('second', event_time, last_result)) AS longest,
    max(CASE WHEN relative_loss > 0.5 THEN 1 ELSE 0 END) AS lost, sum(CASE WHEN relative_loss > 0.5 AND net_win > 10 THEN 1 ELSE 0 END) AS big_lost,
    sum(CASE WHEN net_win > 10 THEN 1 ELSE 0 END) AS big FROM loss GROUP BY 1, 2),
sess_m AS (
  SELECT account_id, count(DISTINCT CASE WHEN longest > 180 * 60 THEN session_id END) AS long_sessions_ps_score_180,
    count(DISTINCT CASE WHEN longest > 210 * 60 THEN session_id END) AS long_sessions_ps_score_210,
    count(DISTINCT CASE WHEN longest > 240 * 60 THEN session_id END) AS long_sessions_ps_score_240,
    count(DISTINCT CASE WHEN lost = 1 THEN session_id END) AS losses_of_winning, count(*) AS cases,
    CAST(sum(big_lost) AS DOUBLE) / nullif(sum(big), 0) AS losses_of_winning_score FROM sess GROUP BY 1)"""

_WEEK = "b.event_time BETWEEN p.first_pay_time AND p.first_pay_time + INTERVAL 10080 MINUTE"
_REST = f"""
wd AS (SELECT b.account_id, CASE WHEN sum(b.amount) > 0 THEN 1 ELSE 0 END AS user_withdrawed FROM applied b JOIN payer p ON b.account_id = p.account_id AND {_WEEK} GROUP BY 1),
vol AS (SELECT b.account_id, stddev_samp(CASE WHEN bet_money > 0 THEN bet_money END) / nullif(sum(bet_money), 0) AS fluctuating_wagers
  FROM plays b JOIN payer p ON b.account_id = p.account_id AND {_WEEK} GROUP BY 1),
se AS (SELECT account_id, session_id, event_time FROM starts UNION ALL SELECT account_id, session_id, event_time FROM results),
tm AS (SELECT account_id, sum(playtime) AS time_comsumption FROM (
  SELECT b.account_id, b.session_id, date_sub('second', min(b.event_time), max(b.event_time)) AS playtime FROM se b JOIN payer p ON b.account_id = p.account_id AND {_WEEK} GROUP BY 1, 2) GROUP BY 1)"""

_SESSION_COUNTS = ["long_sessions_ps_score_180", "long_sessions_ps_score_210", "long_sessions_ps_score_240", "losses_of_winning", "cases"]


@query("D11", "D12", "B4", oracle=f"""
,{PAYER_SQL}
SELECT account_id, {sql_time('first_pay_time')} AS first_paid, bundle_id, {sql_rds(['payment_d7', 'disputed_d30', 'disputable_payment'], 2)},
  CAST(disputes_d30 AS BIGINT) AS disputes_d30, CAST(payment_methods_score AS INTEGER) AS payment_methods_score, coalesce(methods, '') AS methods,
  {sql_rds(['payment_impulsiveness_score'], 4)} FROM payer
""")
def payer_payments(r):
    paid = profile.payers(r.payments.filter(F.col("is_true").isNull() | F.col("is_true")), r.users, r.disputes, AS_OF)
    found = profile.payment_measures(paid, r.disputes)
    return found.select(
        "account_id", when_text("first_pay_time").alias("first_paid"), "bundle_id", *rds(["payment_d7", "disputed_d30", "disputable_payment"], 2),
        "disputes_d30", "payment_methods_score", F.array_join("payment_methods_sequence", ",").alias("methods"), *rds(["payment_impulsiveness_score"], 4),
    )


@query("D11", "D12", "D13", "D14", "D15", "D16", "D17", "D18", "D19", "C7", "C8", oracle=f"""
,{PAYER_SQL},{_PLAY},{_SESSION},{_REST}
SELECT p.account_id, p.bundle_id, CAST(p.disputes_d30 AS BIGINT) AS disputes_d30, {sql_rd('p.payment_d7', 2)} AS monetary_consumption_score,
  CAST(coalesce(game_types, 0) AS BIGINT) AS game_types, CAST(coalesce(days_played_score, 0) AS BIGINT) AS days_played_score,
  {sql_rds(['nightly_play'])}, {sql_rds(['increasing_tolerance'], 1)},
  {', '.join(f'CAST(coalesce({n}, 0) AS BIGINT) AS {n}' for n in _SESSION_COUNTS)}, {sql_rds(['losses_of_winning_score'])},
  coalesce(user_withdrawed, 0) AS user_withdrawed, {sql_rds(['fluctuating_wagers'], 2)}, CAST(coalesce(time_comsumption, -1) AS BIGINT) AS time_comsumption
FROM payer p LEFT JOIN play_m USING (account_id) LEFT JOIN sess_m USING (account_id) LEFT JOIN wd USING (account_id)
LEFT JOIN vol USING (account_id) LEFT JOIN tm USING (account_id)
""")
def payer_profile(r):
    found = profile.payer_profile(r, AS_OF)
    return found.select(
        "account_id", "bundle_id", "disputes_d30", rd("monetary_consumption_score", 2).alias("monetary_consumption_score"), "game_types", "days_played_score",
        rd("nightly_play").alias("nightly_play"), "increasing_tolerance", *_SESSION_COUNTS, *rds(["losses_of_winning_score"]), "user_withdrawed",
        "fluctuating_wagers", F.coalesce("time_comsumption", F.lit(-1)).alias("time_comsumption"),
    )


@query("E12", "E13", "E14", "E15", oracle=f"""
,{LOSS_SQL.format(rounds='plays')}
SELECT spin_id, account_id, session_id, {sql_time('last_loss')} AS last_loss, CAST(win_streak_size AS BIGINT) AS win_streak_size,
  {sql_rds(['net_win', 'win_streak_value', 'subsequent_profit'], 2)}, CASE WHEN isfinite(relative_loss) THEN {sql_rd('CASE WHEN isfinite(relative_loss) THEN relative_loss END', 4)} END AS relative_loss,
  CASE WHEN relative_loss > 0.5 THEN 1 ELSE 0 END AS lost FROM loss
""")
def session_losses(r):
    from riskrules.functions.measures import exceeds, finite

    found = sessions.session_losses(r.plays)
    return found.select(
        "spin_id", "account_id", "session_id", when_text("last_loss").alias("last_loss"), "win_streak_size",
        *rds(["net_win", "win_streak_value", "subsequent_profit"], 2), rd(finite(F.col("relative_loss")), 4).alias("relative_loss"),
        exceeds(F.col("relative_loss"), 0.5).cast("int").alias("lost"),
    )


@query("E13", oracle="""
, w AS (SELECT *, CASE WHEN win_amount - bet_money > 0 THEN 1 ELSE 0 END AS won FROM plays),
g AS (SELECT *, sum(1 - won) OVER (PARTITION BY account_id, session_id ORDER BY event_time, spin_id) AS run FROM w)
SELECT spin_id, CAST(sum(won) OVER (PARTITION BY account_id, session_id, run ORDER BY event_time, spin_id) AS BIGINT) AS win_run FROM g
""")
def win_runs(r):
    return sessions.win_runs(r.plays).select("spin_id", "win_run")


# --- reports -------------------------------------------------------------------------------

LABELLED_SQL = """
lab AS (SELECT r.*, CASE WHEN d.dispute_time IS NULL THEN 0 ELSE 1 END AS label FROM regpay r LEFT JOIN disp d ON r.pay_id = d.pay_id)"""


def labelled_payments(r):
    paid = with_disputes(after_registration(r.payments, r.users), r.disputes)
    return paid.withColumn("label", binary_label(F.col("dispute_time").isNotNull().cast("int")))


@query("D20", oracle=f"""
,{LABELLED_SQL}
SELECT strftime(register_time, '%Y-%m-%d') AS day, {sql_rd('avg(label)')} AS rate FROM lab GROUP BY 1
""")
def daily_rate(r):
    found = reports.daily_rate(labelled_payments(r), "register_time", "label")
    return found.select(F.date_format("day", "yyyy-MM-dd").alias("day"), rd("rate").alias("rate"))


@query("D20", oracle=f"""
,{LABELLED_SQL}
SELECT strftime(register_time, '%Y-%m-%d') AS day, matuirity_day, {sql_rd('avg(label)')} AS rate FROM lab GROUP BY 1, 2
""")
def daily_rate_by_maturity(r):
    found = reports.daily_rate(labelled_payments(r), "register_time", "label", ["matuirity_day"])
    return found.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "matuirity_day", rd("rate").alias("rate"))


@query("D21", oracle=f"""
,{LABELLED_SQL}
SELECT 'all' AS part, label, {sql_rd('avg(pay_amount)')} AS mean_pay_amount FROM lab GROUP BY 2
UNION ALL SELECT 'large', label, {sql_rd('avg(pay_amount)')} FROM lab WHERE pay_amount > 52.995 GROUP BY 2
""")
def mean_amount_by_label(r):
    rows = labelled_payments(r)
    whole = reports.mean_by(rows, "label", "pay_amount").withColumn("part", F.lit("all"))
    large = reports.mean_by(rows, "label", "pay_amount", F.col("pay_amount") > 52.995).withColumn("part", F.lit("large"))
    return whole.unionByName(large).withColumn("mean_pay_amount", rd("mean_pay_amount"))


_SHARE_NAMES = ["any_all", "any_one", "every_one", "any_over_one", "every_over_one", "any_over_two", "every_over_two"]


@query("D22", oracle=f"""
,{RATES_SQL}
SELECT CAST(count(*) AS BIGINT) AS accounts, CAST(count(*) FILTER (WHERE dispute_rate > 0) AS BIGINT) AS disputers,
  {sql_rd('avg(CASE WHEN dispute_rate > 0 THEN 1.0 ELSE 0 END)')} AS any_all,
  {sql_rd('avg(CASE WHEN dispute_rate > 0 THEN 1.0 ELSE 0 END) FILTER (WHERE valid_payments = 1)')} AS any_one,
  {sql_rd('avg(CASE WHEN dispute_rate = 1 THEN 1.0 ELSE 0 END) FILTER (WHERE valid_payments = 1)')} AS every_one,
  {sql_rd('avg(CASE WHEN dispute_rate > 0 THEN 1.0 ELSE 0 END) FILTER (WHERE valid_payments > 1)')} AS any_over_one,
  {sql_rd('avg(CASE WHEN dispute_rate = 1 THEN 1.0 ELSE 0 END) FILTER (WHERE valid_payments > 1)')} AS every_over_one,
  {sql_rd('avg(CASE WHEN dispute_rate > 0 THEN 1.0 ELSE 0 END) FILTER (WHERE valid_payments > 2)')} AS any_over_two,
  {sql_rd('avg(CASE WHEN dispute_rate = 1 THEN 1.0 ELSE 0 END) FILTER (WHERE valid_payments > 2)')} AS every_over_two FROM rates
""")
def dispute_shares(r):
    return reports.dispute_shares(confirmed_rates(r)).select("accounts", "disputers", *rds(_SHARE_NAMES))


COUNTED_SQL = f"""{LABELLED_SQL},
cnt AS (SELECT account_id, count(*) AS number_payments, max(label) AS label, sum(pay_amount) AS spent, min(register_time) AS register_time FROM lab GROUP BY 1)"""


def counted_payers(r):
    return labelled_payments(r).groupBy("account_id").agg(
        F.count("*").alias("number_payments"), F.max("label").alias("label"), F.sum("pay_amount").alias("spent"), F.min("register_time").alias("register_time")
    )


@query("D23", oracle=f"""
,{COUNTED_SQL}
SELECT number_payments, CAST(sum(label) AS BIGINT) AS positives, {sql_rd('avg(label)')} AS rate, {sql_rd('sum(label) * 1.0 / (SELECT sum(label) FROM cnt)')} AS share FROM cnt GROUP BY 1
""")
def disputes_by_number_of_payments(r):
    return reports.rate_and_share(counted_payers(r), "number_payments", "label").select("number_payments", "positives", *rds(["rate", "share"]))


@query("D24", oracle=f"""
,{COUNTED_SQL}, g AS (SELECT number_payments, avg(label) AS rate FROM cnt GROUP BY 1)
SELECT number_payments, {sql_rd('rate')} AS rate, {sql_rd('rate / (SELECT avg(rate) FROM g)')} AS rate_index FROM g
""")
def rate_index(r):
    return reports.rate_index(counted_payers(r), "number_payments", "label").select("number_payments", *rds(["rate", "rate_index"]))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("D25", oracle="UNION ALL".join(
    f" SELECT CAST({p} AS DOUBLE) AS quantile, " + ", ".join(f"{sql_rd(f'quantile_cont({c}, {p})', 4)} AS {c}" for c in _NUMBERS) + " FROM lineitem "
    for p in (0.2, 0.4, 0.6, 0.8)
).join([", nothing AS (SELECT 1)", ""]))
def quantile_table(r):
    return reports.quantile_table(r.table("lineitem"), _NUMBERS).select("quantile", *rds(_NUMBERS, 4))


@query("D26", oracle=f"""
, g AS (SELECT l_linenumber, l_linestatus, CAST(l_quantity AS INTEGER) % 10 AS digit, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS positives FROM lineitem GROUP BY 1, 2, 3)
SELECT l_linenumber, l_linestatus, digit, CAST(n AS BIGINT) AS n, CAST(positives AS BIGINT) AS positives, {sql_rd('positives * 1.0 / n')} AS rate
FROM g WHERE n >= 10 AND positives * 1.0 / n >= (SELECT avg(positives * 1.0 / n) FROM g)
""")
def strong_groups(r):
    rows = r.table("lineitem").select("l_linenumber", "l_linestatus", (F.col("l_quantity").cast("int") % 10).alias("digit"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    found = reports.strong_groups(rows, ["l_linenumber", "l_linestatus", "digit"], "label")
    return found.withColumn("rate", rd("rate"))


@query("D27", oracle=f"""
, c AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)
SELECT 'large' AS case_name, {sql_rd('avg(label)')} AS rate, CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS positives FROM c WHERE l_extendedprice >= 50000
UNION ALL SELECT 'small_many', {sql_rd('avg(label)')}, count(*), sum(label) FROM c WHERE l_extendedprice <= 10000 AND l_quantity >= 15
UNION ALL SELECT 'discounted', {sql_rd('avg(label)')}, count(*), sum(label) FROM c WHERE l_discount > 0.05 AND l_quantity >= 40
""")
def case_metrics(r):
    rows = r.table("lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    cases = {"large": price >= 50000, "small_many": (price <= 10000) & (quantity >= 15), "discounted": (F.col("l_discount") > 0.05) & (quantity >= 40)}
    return reports.case_metrics(rows, cases, "label").withColumn("rate", rd("rate"))


@query("D28", "I8", oracle=f"""
,{COUNTED_SQL}, b AS (SELECT *, CAST(strftime(register_time, '%Y%m%d') AS INTEGER) AS day FROM cnt),
e AS (SELECT min(day) AS e0, max(day) AS e3, quantile_cont(day, 1/3.0) AS e1, quantile_cont(day, 2/3.0) AS e2 FROM b)
SELECT CASE WHEN day > e1 AND e1 > e0 THEN 1 ELSE 0 END + CASE WHEN day > e2 AND e2 > e1 AND e2 < e3 THEN 1 ELSE 0 END AS block, CAST(count(*) AS BIGINT) AS n, {sql_rd('avg(label)')} AS rate FROM b, e GROUP BY 1
""")
def block_rates(r):
    rows = counted_payers(r).withColumn("day", day_number(F.col("register_time")))
    return reports.block_rates(time_blocks(rows, "day", 3), "block", "label").withColumn("rate", rd("rate"))


@query("D29", oracle=f"""
, p AS (SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS quantity, avg(l_extendedprice) AS price, avg(l_discount) AS discount FROM lineitem GROUP BY 1),
f AS (SELECT * FROM p ORDER BY n DESC, l_returnflag LIMIT 1)
SELECT p.l_returnflag, {sql_rd('p.quantity / f.quantity')} AS quantity_ratio, {sql_rd('p.price / f.price')} AS price_ratio, {sql_rd('p.discount / f.discount')} AS discount_ratio FROM p, f
""")
def profile_ratios(r):
    groups = r.table("lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.avg("l_quantity").alias("quantity"), F.avg("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount")
    )
    found = reports.profile_ratios(groups, [F.desc("n"), F.asc("l_returnflag")], ["quantity", "price", "discount"])
    return found.select("l_returnflag", *rds(["quantity_ratio", "price_ratio", "discount_ratio"]))


@query("H3", "H35", oracle=f"""
SELECT pay_id, hour(event_time) AS pay_hour, strftime(event_time + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day, {sql_time('event_time + INTERVAL 30 DAY')} AS month_later,
  CASE WHEN hour(event_time) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS working, CASE WHEN hour(event_time) BETWEEN 6 AND 23 THEN 1 ELSE 0 END AS waking,
  CASE WHEN isodow(event_time) > 5 THEN 1 ELSE 0 END AS weekend FROM pay
""")
def payment_clock(r):
    from riskrules.functions.timeunits import add_days

    time = F.col("event_time")
    return r.payments.select(
        "pay_id", F.hour(time).cast("long").alias("pay_hour"), day_text(shift_hours(time, 8)).alias("local_day"), when_text(add_days(time, 30)).alias("month_later"),
        in_working_hours(time).cast("int").alias("working"), in_waking_hours(time).cast("int").alias("waking"), on_weekend(time).cast("int").alias("weekend"),
    )


@query("H1", oracle="""
SELECT p.pay_id, date_sub('second', u.register_time, p.event_time) AS seconds, date_sub('minute', u.register_time, p.event_time) AS minutes,
  date_sub('hour', u.register_time, p.event_time) AS hours, date_sub('day', u.register_time, p.event_time) AS days FROM pay p JOIN usr u ON p.account_id = u.account_id
""")
def age_in_units(r):
    from riskrules.functions.timeunits import complete_units

    rows = r.payments.join(r.users, "account_id")
    ages = {u: complete_units(u, F.col("register_time"), F.col("event_time")) for u in ("second", "minute", "hour", "day")}
    return rows.select("pay_id", *[c.alias(f"{u}s") for u, c in ages.items()])


# --- sequences from event rows -------------------------------------------------------------

@query("E17", oracle="""
SELECT a.account_id, """ + ", ".join(
    f"CAST(max(n{w}) AS BIGINT) AS max_num_payments_{w}_minutes" for w in sequences.DENSITY_MINUTES
) + " FROM (SELECT a.account_id, a.pay_id, " + ", ".join(
    f"count(*) FILTER (WHERE b.event_time <= a.event_time + INTERVAL {w} MINUTE) AS n{w}" for w in sequences.DENSITY_MINUTES
) + """ FROM pay a JOIN pay b ON a.account_id = b.account_id AND b.event_time >= a.event_time GROUP BY 1, 2) a GROUP BY 1
""")
def payment_density(r):
    return sequences.payment_density(r.payments)


@query("E17", oracle="""
SELECT a.account_id, """ + ", ".join(
    f"CAST(max(n{w}) AS BIGINT) AS max_num_payments_{w}_minutes" for w in (60, 600, 4000)
) + " FROM (SELECT a.account_id, a.event_id, " + ", ".join(
    f"count(*) FILTER (WHERE b.event_time <= a.event_time + INTERVAL {w} MINUTE) AS n{w}" for w in (60, 600, 4000)
) + """ FROM ev a JOIN ev b ON a.account_id = b.account_id AND b.event_time >= a.event_time GROUP BY 1, 2) a GROUP BY 1
""")
def event_density(r):
    return sequences.payment_density(r.events, (60, 600, 4000))


@query("E18", "H9", oracle=f"""
, n AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY event_time, pay_id) AS rn FROM pay),
w AS (SELECT account_id, {', '.join(f'max(CASE WHEN rn = {i} THEN pay_amount END) AS {n}_payment, max(CASE WHEN rn = {i} THEN event_time END) AS t{i}' for i, n in ((1, 'first'), (2, 'second'), (3, 'third')))} FROM n GROUP BY 1)
SELECT account_id, first_payment, second_payment, third_payment, {sql_rd('(epoch_us(t2) - epoch_us(t1)) / 60000000.0', 4)} AS minutes_first_to_second,
  {sql_rd('(epoch_us(t3) - epoch_us(t2)) / 60000000.0', 4)} AS minutes_second_to_third FROM w
""")
def first_payments(r):
    found = sequences.first_amounts(r.payments)
    return found.select("account_id", "first_payment", "second_payment", "third_payment", *rds(["minutes_first_to_second", "minutes_second_to_third"], 4))


_STATS = ["median_payment", "average_payment", "maximum_payment", "minimum_payment", "rel_maximum_payment", "rel_payment_range"]


@query("H7", "H8", oracle=f"""
SELECT account_id, CAST(count(*) AS BIGINT) AS number_payments, {sql_rd('quantile_cont(pay_amount, 0.5)', 4)} AS median_payment, {sql_rd('avg(pay_amount)', 4)} AS average_payment,
  {sql_rd('max(pay_amount)', 4)} AS maximum_payment, {sql_rd('min(pay_amount)', 4)} AS minimum_payment, {sql_rd('max(pay_amount) / avg(pay_amount)', 4)} AS rel_maximum_payment,
  {sql_rd('(max(pay_amount) - min(pay_amount)) / nullif(min(pay_amount), 0)', 4)} AS rel_payment_range FROM pay GROUP BY 1
""")
def payment_statistics(r):
    return sequences.amount_stats(r.payments).select("account_id", "number_payments", *rds(_STATS, 4))


HOURS = (0.25, 0.5, 1, 6, 24, 48, 72, 96, 168)


def _hours_sql(table, value, prefix):
    return ", ".join(
        sql_rd(f"sum(CASE WHEN epoch_us(b.event_time) - epoch_us(f.first_pay_time) <= {int(h * 3600000000)} THEN {value} ELSE 0 END)", 2) + f" AS \"{prefix}_within_{h:g}_hours\""
        for h in HOURS
    )


HOURS_SQL = f"""
f AS (SELECT account_id, min(event_time) AS first_pay_time FROM pay GROUP BY 1),
ph AS (SELECT b.account_id, {_hours_sql('pay', 'pay_amount', 'sum_payments')} FROM pay b JOIN f ON b.account_id = f.account_id GROUP BY 1),
wh AS (SELECT b.account_id, {_hours_sql('applied', 'amount', 'sum_withdrawns')} FROM applied b JOIN f ON b.account_id = f.account_id GROUP BY 1)"""


def hour_features(r):
    starts = profile.first_payments(r.payments)
    paid = rollups.hour_windows(r.payments, starts, "pay_amount", "sum_payments")
    out = rollups.hour_windows(r.withdrawals_applied, starts, "amount", "sum_withdrawns")
    return paid.join(out, "account_id", "left")


@query("H12", "H13", oracle=f"""
,{HOURS_SQL}
SELECT * FROM ph LEFT JOIN wh USING (account_id)
""")
def sums_within_hours(r):
    wide = hour_features(r)
    return wide.select("account_id", *[rd(F.col(f"`{c}`"), 2).alias(c) for c in wide.columns if c != "account_id"])


@query("E16", oracle="""
SELECT o_orderkey, CAST(ntile(20) OVER (ORDER BY o_orderpriority_rank, o_orderkey) AS INTEGER) AS tile FROM (
  SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS o_orderpriority_rank FROM orders)
""")
def ntile_scores(r):
    from riskrules.operators.ordered import global_ntile

    ranked = r.table("orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"))
    return global_ntile(ranked, "priority", "o_orderkey", 20).select("o_orderkey", "tile")


@query("E16", oracle="""
SELECT o_orderkey, CAST(ntile(100) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS tile FROM orders
""")
def ntile_of_amount(r):
    from riskrules.operators.ordered import global_ntile

    return global_ntile(r.table("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 100).select("o_orderkey", "tile")


