"""The user-day panel and what is derived from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskrules.functions import lists
from riskrules.functions import measures as m
from riskrules.operators import binning, panel
from riskrules.plans.registry import query, rd, rds, sql_rd, sql_rds, sql_time, when_text
from riskrules.plans.rollup_queries import ACTIVITY_SQL, PAYMENT_SQL, TICKET_SQL, WITHDRAWAL_SQL
from riskrules.sources.roles import AS_OF

# Spine, daily facts and windows as SQL. ``base`` holds one row per payer and closed day.
BASE_SQL = f"""{ACTIVITY_SQL},{PAYMENT_SQL},{WITHDRAWAL_SQL},{TICKET_SQL},
spine AS (
  SELECT b.account_id, b.register_time, b.bundle_id, d.matuirity_day FROM (SELECT DISTINCT matuirity_day FROM regpay) d
  CROSS JOIN (SELECT DISTINCT account_id, register_time, bundle_id FROM regpay) b
  WHERE CAST(b.register_time AS DATE) + CAST(d.matuirity_day + 30 AS INTEGER) < DATE '{AS_OF}'),
base AS (
  SELECT s.*, coalesce(new_payments, 0) AS new_payments, coalesce(spent, 0) AS spent, coalesce(highest_payment, 0) AS highest_payment, first_pay_time, first_dispute_time,
    a.bundle_id AS played_bundle, games_played, money_games, bet_money, money_win, max_bet, first_game, games_before_6, games_6_to_12, games_12_to_18, games_after_18,
    first_withdrawn_attempt, count_withdraw_apply, total_withdrawn_applied, customer_service_interactions, last_customer_service_interaction
  FROM spine s LEFT JOIN pday p ON s.account_id = p.account_id AND s.matuirity_day = p.matuirity_day
  LEFT JOIN act a ON s.account_id = a.account_id AND s.matuirity_day = a.matuirity_day
  LEFT JOIN wday w ON s.account_id = w.account_id AND s.matuirity_day = w.matuirity_day
  LEFT JOIN tday t ON s.account_id = t.account_id AND s.matuirity_day = t.matuirity_day)"""

_RUN = "(PARTITION BY account_id ORDER BY matuirity_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _last(days: int) -> str:
    return f"(PARTITION BY account_id ORDER BY matuirity_day ROWS BETWEEN {days} PRECEDING AND CURRENT ROW)"


def _first(ahead: int) -> str:
    return f"(PARTITION BY account_id ORDER BY matuirity_day ROWS BETWEEN UNBOUNDED PRECEDING AND {ahead} FOLLOWING)"


_ALL = "(PARTITION BY account_id)"
_LIST = "array_to_string(list({x}) OVER " + _RUN + ", ',')"
_LIMIT = "register_time + to_days(CAST(matuirity_day + 1 AS INTEGER))"

_FEATURES = {
    **{f"payments_last_{d}d": f"CAST(sum(new_payments) OVER {_last(d)} AS BIGINT)" for d in (14, 7, 3)},
    **{f"spent_last_{d}d": sql_rd(f"sum(spent) OVER {_last(d)}", 2) for d in (14, 7, 3)},
    "payments_to_date": f"CAST(sum(new_payments) OVER {_RUN} AS BIGINT)",
    "spent_to_date": sql_rd(f"sum(spent) OVER {_RUN}", 2),
    "daily_spent_to_date": sql_rd(f"avg(spent) OVER {_RUN}", 2),
    "daily_spent_last_7_d": sql_rd(f"avg(spent) OVER {_last(7)}", 2),
    "daily_spent_first_14d": sql_rd(f"avg(spent) OVER {_first(13)}", 2),
    "daily_spent_first_7d": sql_rd(f"avg(spent) OVER {_first(7)}", 2),
    "daily_spent_first_1d": sql_rd(f"avg(spent) OVER {_first(0)}", 2),
    "max_daily_spent": sql_rd(f"max(spent) OVER {_RUN}", 2),
    "max_payment": sql_rd(f"max(highest_payment) OVER {_RUN}", 2),
}
_ACTIVITY = {
    **{f"games_last_{d}d": f"CAST(coalesce(sum(games_played) OVER {_last(d)}, -1) AS BIGINT)" for d in (14, 7)},
    **{f"money_games_last_{d}d": f"CAST(coalesce(sum(money_games) OVER {_last(d)}, -1) AS BIGINT)" for d in (14, 7)},
    **{f"bet_money_last_{d}d": sql_rd(f"sum(bet_money) OVER {_last(d)}", 1) for d in (14, 7)},
    **{f"win_amount_last_{d}d": sql_rd(f"sum(money_win) OVER {_last(d)}", 2) for d in (14, 7)},
    "games_to_date": f"CAST(coalesce(sum(games_played) OVER {_RUN}, -1) AS BIGINT)",
    "money_games_to_date": f"CAST(coalesce(sum(money_games) OVER {_RUN}, -1) AS BIGINT)",
    "max_games_daily_games": f"CAST(coalesce(max(games_played) OVER {_RUN}, -1) AS BIGINT)",
    "daily_games_first_14d": sql_rd(f"avg(games_played) OVER {_first(13)}", 2),
    "daily_games_first_7d": sql_rd(f"avg(games_played) OVER {_first(7)}", 2),
    "daily_games_first_1d": sql_rd(f"avg(games_played) OVER {_first(0)}", 2),
    "bet_money_to_date": sql_rd(f"sum(bet_money) OVER {_RUN}", 1),
    "win_amount_to_date": sql_rd(f"sum(money_win) OVER {_RUN}", 2),
    "max_bet_to_date": sql_rd(f"max(max_bet) OVER {_RUN}", 2),
    **{f"local_time_{p}": f"CAST(coalesce(sum(games_{p}) OVER {_RUN}, 0) AS BIGINT)" for p in ("before_6", "6_to_12", "12_to_18", "after_18")},
}
_ACTIVITY_COUNTS = [n for n, e in _ACTIVITY.items() if "-1" in e]
_HISTORY = {
    "daily_payment_history_binary": _LIST.format(x="CASE WHEN new_payments > 0 THEN 1 ELSE 0 END"),
    "daily_payment_history_count": _LIST.format(x="CAST(new_payments AS BIGINT)"),
    "retention_sequence": _LIST.format(x="CASE WHEN games_played > 0 THEN 1 ELSE 0 END"),
    "games_sequence": _LIST.format(x="CAST(coalesce(games_played, 0) AS BIGINT)"),
    "days_betting_money_sequence": _LIST.format(x="CASE WHEN bet_money > 0 THEN 1 ELSE 0 END"),
    "days_50_usd_bet_money_sequence": _LIST.format(x="CASE WHEN bet_money > 50 THEN 1 ELSE 0 END"),
}
_TIMING = {
    "minutes_to_play": f"coalesce(date_sub('minute', register_time, min(first_game) OVER {_ALL}), -1)",
    "minutes_to_payment": f"coalesce(date_sub('minute', register_time, min(first_pay_time) OVER {_ALL}), -1)",
    "minutes_to_pay_since_first_game": f"coalesce(date_sub('minute', register_time, min(first_pay_time) OVER {_ALL}) - date_sub('minute', register_time, min(first_game) OVER {_ALL}), -1)",
    "pay_matuirity": f"coalesce(matuirity_day - date_sub('day', register_time, min(first_pay_time) OVER {_ALL}), -1)",
    "paying_matuirity": f"coalesce(matuirity_day - date_sub('day', register_time, min(first_pay_time) OVER {_ALL}), -1)",
    "minutes_to_withdraw_since_first_payment": f"coalesce(date_sub('minute', min(first_pay_time) OVER {_ALL}, min(first_withdrawn_attempt) OVER {_ALL}), -1)",
}
_WAIT = f"date_sub('minute', {_LIMIT}, min(first_dispute_time) OVER {_ALL})"
_LABELS = {"past_disputer": f"CASE WHEN {_WAIT} < 0 THEN 1 ELSE 0 END", "new_disputer_30d": f"CASE WHEN {_WAIT} BETWEEN 0 AND 43200 THEN 1 ELSE 0 END"}


def _select(parts: dict[str, str], more: str = "") -> str:
    return f"SELECT account_id, matuirity_day, {', '.join(f'{e} AS {n}' for n, e in parts.items())}{more} FROM base"


def panel_of(r, last_day=None):
    return panel.user_day_panel(r, AS_OF, last_day)


@query("C5", "C6", "B2", "B6", oracle=f"""
,{BASE_SQL}
SELECT account_id, matuirity_day, CAST(new_payments AS BIGINT) AS new_payments, {sql_rds(['spent', 'bet_money', 'total_withdrawn_applied'], 2)},
  CAST(coalesce(games_played, 0) AS BIGINT) AS games_played, CAST(coalesce(customer_service_interactions, 0) AS BIGINT) AS contacts FROM base
""")
def daily_panel(r):
    base = panel.base_panel(r, AS_OF).na.fill(0, ["games_played", "customer_service_interactions"])
    return base.select(
        "account_id", "matuirity_day", "new_payments", *rds(["spent", "bet_money", "total_withdrawn_applied"], 2), "games_played",
        F.col("customer_service_interactions").alias("contacts"),
    )


@query("E3", "E4", "E5", "E6", "E7", oracle=f",{BASE_SQL}\n{_select(_FEATURES)}")
def panel_payment_windows(r):
    doubles = [n for n, e in _FEATURES.items() if "BIGINT" not in e]
    wide = panel_of(r)
    return wide.select("account_id", "matuirity_day", *[n for n in _FEATURES if n not in doubles], *rds(doubles, 2))


@query("E3", "E4", "E6", "E7", "D30", oracle=f",{BASE_SQL}\n{_select(_ACTIVITY)}")
def panel_activity_windows(r):
    doubles = [n for n, e in _ACTIVITY.items() if "BIGINT" not in e]
    wide = panel_of(r)
    counts = [F.coalesce(n, F.lit(-1)).alias(n) if n in _ACTIVITY_COUNTS else F.col(n) for n in _ACTIVITY if n not in doubles]
    return wide.select("account_id", "matuirity_day", *counts, *rds(doubles, 2))


@query("E8", "H22", "H23", oracle=f""",{BASE_SQL}, h AS ({_select(_HISTORY)})
SELECT *, CAST(right(daily_payment_history_binary, 1) AS INTEGER) AS pays_today, right(retention_sequence, 13) AS last_week FROM h
""")
def panel_histories(r):
    wide = panel_of(r)
    return wide.select(
        "account_id", "matuirity_day", *[F.array_join(n, ",").alias(n) for n in _HISTORY],
        lists.last_item(F.col("daily_payment_history_binary")).alias("pays_today"), lists.tail_pattern(F.col("retention_sequence")).alias("last_week"),
    )


@query("E1", "E2", "E9", "E10", "E11", "D30", oracle=f",{BASE_SQL}\n" + _select({**_TIMING, **_LABELS}, f""", {sql_time(_LIMIT)} AS limit_time,
  max(played_bundle) OVER {_ALL} AS played_bundle_id, {sql_time(f'min(first_dispute_time) OVER {_ALL}')} AS first_dispute,
  CAST(coalesce(sum(count_withdraw_apply) OVER {_RUN}, 0) AS BIGINT) AS withdrawn_attempt_to_date,
  {sql_rd(f'coalesce(sum(total_withdrawn_applied) OVER {_RUN}, 0)', 2)} AS withdrawn_attempted_ammount_to_date,
  CAST(sum(coalesce(customer_service_interactions, 0)) OVER {_RUN} AS BIGINT) AS contacts_to_date,
  {sql_time(f'max(last_customer_service_interaction) OVER {_RUN}')} AS last_contact"""))
def panel_timing_and_labels(r):
    wide = panel_of(r)
    return wide.select(
        "account_id", "matuirity_day", *[F.coalesce(n, F.lit(-1)).alias(n) for n in _TIMING], *_LABELS, when_text("limit_time").alias("limit_time"),
        "played_bundle_id", when_text("first_dispute").alias("first_dispute"), "withdrawn_attempt_to_date",
        rd("withdrawn_attempted_ammount_to_date", 2).alias("withdrawn_attempted_ammount_to_date"), "contacts_to_date", when_text("last_contact_to_date").alias("last_contact"),
    )


_FULL = {**_FEATURES, **_ACTIVITY, **_TIMING, **_LABELS}


@query("B3", oracle=f",{BASE_SQL}, w AS ({_select(_FULL)})\nSELECT account_id, matuirity_day, new_disputer_30d FROM w WHERE spent_to_date = 0 AND matuirity_day BETWEEN 0 AND 35 AND past_disputer = 0")
def not_yet_payers(r):
    return panel.not_yet_payers(panel_of(r, 35)).select("account_id", "matuirity_day", "new_disputer_30d")


@query("B5", "H21", oracle=f""",{BASE_SQL},
d AS (SELECT account_id, sum(CASE WHEN matuirity_day = 0 THEN spent END) AS d1, sum(CASE WHEN matuirity_day BETWEEN 1 AND 3 THEN spent END) AS d2_4,
    sum(CASE WHEN matuirity_day BETWEEN 4 AND 6 THEN spent END) AS d5_7, sum(CASE WHEN matuirity_day = 0 THEN new_payments END) AS n1 FROM base WHERE matuirity_day <= 6 GROUP BY 1)
SELECT account_id, CAST(n1 AS BIGINT) AS day_1_count_payment, {sql_rd('d1', 2)} AS day_1_total_payment, {sql_rd('d2_4 / d1')} AS d2_4_total_payment_rel, {sql_rd('d5_7 / nullif(d2_4, 0)')} AS d4_7_total_payment_rel
FROM d WHERE d1 > 0
""")
def first_week_growth(r):
    week = panel_of(r, 6).filter(F.col("matuirity_day") == 6)
    history = F.col("daily_spent_history_count")
    parts = week.select(
        "account_id",
        F.get("daily_payment_history_count", 0).alias("day_1_count_payment"),
        F.get(history, 0).alias("day_1_total_payment"),
        lists.sum_slice(history, 2, 3).alias("block_2"),
        lists.sum_slice(history, 5, 3).alias("block_3"),
    ).filter(F.col("day_1_total_payment") > 0)
    return parts.select(
        "account_id", "day_1_count_payment", rd("day_1_total_payment", 2).alias("day_1_total_payment"),
        rd(m.ratio(F.col("block_2"), F.col("day_1_total_payment"))).alias("d2_4_total_payment_rel"), rd(m.ratio(F.col("block_3"), F.col("block_2"))).alias("d4_7_total_payment_rel"),
    )


_NORMAL = {
    "max_payment_rel": "max_payment / nullif(spent_to_date, 0)",
    "max_daily_spent_rel": "max_daily_spent / nullif(spent_to_date, 0)",
    "max_games_daily_games_rel": "CASE WHEN games_to_date > 0 THEN CAST(max_games_daily_games AS DOUBLE) / games_to_date END",
    "daily_games_first_1d_rel": "CASE WHEN games_to_date > 0 THEN daily_games_first_1d / games_to_date END",
    "win_spent_ratio": "win_amount_to_date / (spent_to_date + 0.0001)",
    **{
        f"local_time_{p}_rel": f"CAST(local_time_{p} AS DOUBLE) / nullif(local_time_before_6 + local_time_6_to_12 + local_time_12_to_18 + local_time_after_18, 0)"
        for p in ("before_6", "6_to_12", "12_to_18", "after_18")
    },
}


@query("H20", oracle=f",{BASE_SQL}, w AS ({_select({**_FEATURES, **_ACTIVITY})})\nSELECT account_id, matuirity_day, " + ", ".join(f"{sql_rd(e, 4)} AS {n}" for n, e in _NORMAL.items()) + " FROM w")
def normalised_panel(r):
    wide = panel_of(r).withColumns(m.normalised_panel())
    return wide.select("account_id", "matuirity_day", *rds(list(_NORMAL), 4))


_SEGMENT = " ".join(
    f"WHEN {test} AND payments_to_date > 1 THEN '{m.SEGMENTS[2 * i]}' WHEN {test} THEN '{m.SEGMENTS[2 * i + 1]}'"
    for i, test in enumerate(["matuirity_day < 14", "matuirity_day >= 14 AND paying < 14", "matuirity_day >= 14 AND paying >= 14"])
)


@query("H30", "K9", oracle=f""",{BASE_SQL}, w AS ({_select(_FULL, f", matuirity_day - date_sub('day', register_time, min(first_pay_time) OVER {_ALL}) AS paying")}),
s AS (SELECT *, CASE {_SEGMENT} END AS segment FROM w)
SELECT coalesce(segment, 'none') AS segment, CAST(count(*) AS BIGINT) AS n, CAST(sum(new_disputer_30d) AS BIGINT) AS positives FROM s GROUP BY 1
""")
def life_time_segments(r):
    segment = m.segment(F.col("matuirity_day"), F.col("paying_matuirity"), F.col("payments_to_date"))
    rows = panel_of(r).select(F.coalesce(segment, F.lit("none")).alias("segment"), "new_disputer_30d")
    return rows.groupBy("segment").agg(F.count("*").alias("n"), F.sum("new_disputer_30d").alias("positives"))


@query("K9", oracle=f""",{BASE_SQL}, w AS ({_select({**_FEATURES, **_TIMING})})
SELECT account_id, matuirity_day FROM w WHERE matuirity_day >= 14 AND NOT max_payment > 150
""")
def rows_without_segment(r):
    from riskrules.operators.matching import without_value

    # Paying life starts with the first large payment here, so accounts without one have no segment.
    paying = F.when(F.col("max_payment") > 150, F.col("paying_matuirity"))
    rows = panel_of(r).withColumn("segment", m.segment(F.col("matuirity_day"), paying, F.col("payments_to_date")))
    return without_value(rows, "segment").select("account_id", "matuirity_day")


@query("I4", "H23", oracle=f""",{BASE_SQL}, w AS ({_select({**_HISTORY, **_LABELS})}), t AS (SELECT *, right(retention_sequence, 13) AS pattern FROM w),
k AS (SELECT pattern FROM t GROUP BY 1 HAVING sum(new_disputer_30d) >= 15)
SELECT account_id, matuirity_day, 'playing_days_' || pattern AS indicator FROM t WHERE pattern IN (SELECT pattern FROM k)
""")
def supported_patterns(r):
    rows = panel_of(r).select("account_id", "matuirity_day", "new_disputer_30d", lists.tail_pattern(F.col("retention_sequence")).alias("pattern"))
    kept = binning.supported_values(rows, "pattern", "new_disputer_30d", at_least=15)
    return binning.pattern_indicators(rows, "pattern", kept, "playing_days", ["account_id", "matuirity_day"])
