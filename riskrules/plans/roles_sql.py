"""The roles of ``sources.roles`` as SQL over the raw event table."""

ROLES = """
ev AS (
  SELECT event_id, user_id AS account_id, ts AS event_time, event_type, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS item
  FROM events),
linked AS (
  SELECT *,
    min(CASE WHEN event_type = 'error' THEN event_time END) OVER later AS next_error_time,
    first_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER later AS next_view_value,
    min(CASE WHEN event_type = 'click' THEN event_time END) OVER later AS next_click_time,
    first_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER later AS next_click_value
  FROM ev WHERE event_type IN ('purchase', 'click', 'view', 'error')
  WINDOW later AS (PARTITION BY account_id, item ORDER BY event_time, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
usr AS (
  SELECT account_id, min(event_time) AS register_time, 'bundle_' || CAST(account_id % 3 AS VARCHAR) AS bundle_id
  FROM ev WHERE event_type = 'signup' GROUP BY account_id),
pay AS (
  SELECT event_id AS pay_id, account_id, event_time, value AS pay_amount,
         'method_' || CAST(item % 3 AS VARCHAR) AS payment_type, 'entry_' || CAST(item % 4 AS VARCHAR) AS pay_entry,
         CASE WHEN item % 10 = 0 THEN NULL ELSE item % 10 <> 9 END AS is_true
  FROM ev WHERE event_type = 'purchase'),
disp AS (
  SELECT event_id AS pay_id, account_id, next_error_time AS dispute_time,
         CASE WHEN item % 4 = 0 THEN 'fraud' ELSE 'pay_dispute' END AS kind
  FROM linked WHERE event_type = 'purchase' AND next_error_time IS NOT NULL),
plays AS (
  SELECT event_id AS spin_id, account_id, event_time,
         CASE WHEN item % 5 = 0 THEN value ELSE 0.0 END AS bet_chips,
         CASE WHEN item % 5 = 0 THEN 0.0 ELSE value END AS bet_money,
         coalesce(next_view_value, 0.0) AS win_amount, item AS machine_id, item AS session_id
  FROM linked WHERE event_type = 'click'),
starts AS (SELECT account_id, event_time, item AS game_id, item AS session_id FROM ev WHERE event_type = 'click'),
results AS (SELECT account_id, event_time, item AS session_id FROM ev WHERE event_type = 'view'),
applied AS (
  SELECT event_id AS withdraw_id, account_id, event_time, value AS amount, 0.0 AS withdraw_fee FROM ev WHERE event_type = 'view'),
paid_out AS (
  SELECT event_id AS withdraw_id, account_id, next_click_time AS event_time, next_click_value AS amount, 0.0 AS withdraw_fee
  FROM linked WHERE event_type = 'view' AND next_click_time IS NOT NULL),
tickets AS (SELECT account_id, event_time FROM ev WHERE event_type = 'error'),
currency AS (
  SELECT account_id, event_time, CASE WHEN event_type = 'click' THEN -value ELSE value END AS coin_change,
         CAST(item AS DOUBLE) AS bonus_change, value - item AS money_change
  FROM ev WHERE event_type IN ('click', 'view')),
ads AS (SELECT account_id, event_time, value AS revenue FROM ev WHERE event_type = 'view'),
regpay AS (
  SELECT p.*, u.register_time, u.bundle_id, CAST(floor(date_sub('minute', u.register_time, p.event_time) / 1440.0) AS INTEGER) AS matuirity_day
  FROM pay p JOIN usr u ON p.account_id = u.account_id AND p.event_time > u.register_time)
"""
