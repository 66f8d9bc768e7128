"""Scans, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskrules.functions import columns as cols
from riskrules.functions.measures import binary_label, fill_gaps, float_ratio
from riskrules.operators import joins, profile, reports, rollups, splits
from riskrules.operators.panel import payers_of
from riskrules.plans.registry import query, rd, rds, sql_rd, sql_time, when_text
from riskrules.sources import tables
from riskrules.sources.roles import AS_OF


@query("A1", "B1", oracle="""
SELECT event_id, account_id, value FROM ev
WHERE event_type IN ('purchase', 'error') AND event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-21'
""")
def event_scan(r):
    return tables.event_scan(r.events, ["purchase", "error"], ["event_id", "account_id", "value"], "2024-01-10", "2024-01-20")


@query("A2", oracle=f"""
SELECT account_id, bundle_id, {sql_time('register_time')} AS registered FROM usr
WHERE bundle_id IN ('bundle_0', 'bundle_2') AND register_time >= TIMESTAMP '2024-01-02' AND register_time < TIMESTAMP '2024-01-06'
""")
def user_scan(r):
    found = tables.user_scan(r.users, ["bundle_0", "bundle_2"], "2024-01-02", "2024-01-06")
    return found.select("account_id", "bundle_id", when_text("register_time").alias("registered"))


@query("A4", oracle="""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'P', 'O')
""")
def extracts_as_one_table(r):
    orders = r.table("orders")
    old = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderpriority")
    new = orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_custkey")
    now = orders.filter("o_orderstatus = 'O'").select("o_orderpriority", "o_custkey", "o_orderkey")
    return tables.one_table([old, new, now])


@query("A6", oracle=f"""
, a AS (SELECT account_id, sum(pay_amount) AS paid FROM pay GROUP BY 1),
b AS (SELECT account_id, sum(bet_money) AS bet FROM plays GROUP BY 1),
c AS (SELECT account_id, count(*) AS contacts FROM tickets GROUP BY 1)
SELECT a.account_id, {sql_rd('paid', 2)} AS paid, {sql_rd('bet', 2)} AS bet, CAST(contacts AS BIGINT) AS contacts
FROM a JOIN b ON a.account_id = b.account_id JOIN c ON a.account_id = c.account_id
""")
def sequence_tables_joined(r):
    paid = r.payments.groupBy("account_id").agg(F.sum("pay_amount").alias("paid"))
    bet = r.plays.groupBy("account_id").agg(F.sum("bet_money").alias("bet"))
    contacts = r.tickets.groupBy("account_id").agg(F.count("*").alias("contacts"))
    return joins.assembled([paid, bet, contacts], how="inner").select("account_id", *rds(["paid", "bet"], 2), "contacts")


@query("A8", oracle=f"""
, p AS (SELECT u.account_id, sum(CASE WHEN date_sub('day', u.register_time, b.event_time) <= 7 THEN pay_amount ELSE 0 END) AS p7
  FROM usr u LEFT JOIN pay b ON u.account_id = b.account_id AND u.register_time < b.event_time AND date_sub('day', u.register_time, b.event_time) <= 90 GROUP BY 1),
g AS (SELECT u.account_id, count(DISTINCT CASE WHEN date_sub('day', u.register_time, b.event_time) <= 7 THEN game_id END) AS games_played_d7
  FROM usr u LEFT JOIN starts b ON u.account_id = b.account_id AND u.register_time < b.event_time GROUP BY 1),
d AS (SELECT u.account_id, sum(CASE WHEN date_sub('day', u.register_time, b.event_time) <= 7 THEN revenue ELSE 0 END) AS ad7
  FROM usr u LEFT JOIN ads b ON u.account_id = b.account_id AND u.register_time < b.event_time GROUP BY 1),
resp AS (SELECT rp.account_id, avg(CASE WHEN x.dispute_time IS NULL THEN 0.0 ELSE 1.0 END) AS dispute_rate, count(*) AS valid_payments
  FROM regpay rp LEFT JOIN disp x ON rp.pay_id = x.pay_id GROUP BY 1)
SELECT resp.account_id, {sql_rd('dispute_rate')} AS dispute_rate, CAST(valid_payments AS BIGINT) AS valid_payments,
  {sql_rd('p7', 2)} AS p7, CAST(games_played_d7 AS DOUBLE) AS games_played_d7, {sql_rd('ad7', 2)} AS ad7
FROM resp JOIN p ON resp.account_id = p.account_id LEFT JOIN g ON p.account_id = g.account_id LEFT JOIN d ON p.account_id = d.account_id
""")
def feature_table(r):
    features = joins.assembled(
        [
            rollups.spend_horizons(r.payments, r.users).drop("register_time"),
            rollups.game_horizons(r.starts, r.users),
            rollups.ad_horizons(r.ads, r.users),
        ]
    )
    response = rollups.dispute_rates(r.payments, r.users, r.disputes)
    wide = joins.assembled([response, features], how="inner")
    return wide.select("account_id", rd("dispute_rate").alias("dispute_rate"), "valid_payments", *rds(["p7"], 2), "games_played_d7", *rds(["ad7"], 2))


_CURVE = """
, f AS (SELECT o_custkey, min(o_orderdate) AS first_day FROM orders GROUP BY 1),
s AS (SELECT o.o_custkey, CAST(o.o_orderdate AS DATE) - CAST(f.first_day AS DATE) AS days_since_first_payment, c.c_mktsegment AS segment, o.o_totalprice
  FROM orders o JOIN f ON o.o_custkey = f.o_custkey JOIN customer c ON c.c_custkey = o.o_custkey),
d AS (SELECT {seg} o_custkey, days_since_first_payment, sum(o_totalprice) AS revenue FROM s WHERE days_since_first_payment <= 60 GROUP BY ALL)
SELECT {seg} CAST(days_since_first_payment AS BIGINT) AS days_since_first_payment, {avg} AS average_total_net_revenue, CAST(count(*) AS BIGINT) AS payers
FROM d GROUP BY ALL
"""


def _order_payments(r):
    segment = r.table("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("segment"))
    orders = r.table("orders").select(
        F.col("o_custkey").alias("account_id"), F.col("o_orderdate").cast("timestamp").alias("event_time"), F.col("o_totalprice").alias("pay_amount")
    )
    return orders.join(segment, "account_id")


@query("A9", oracle=_CURVE.format(seg="", avg=sql_rd("avg(revenue)", 4)))
def revenue_curve(r):
    return rollups.revenue_curve(_order_payments(r)).withColumn("average_total_net_revenue", rd("average_total_net_revenue", 4))


@query("A9", oracle=_CURVE.format(seg="segment,", avg=sql_rd("avg(revenue)", 4)))
def revenue_curve_by_segment(r):
    return rollups.revenue_curve(_order_payments(r), by=["segment"]).withColumn("average_total_net_revenue", rd("average_total_net_revenue", 4))


@query("B1", oracle="""
SELECT pay_id, account_id, pay_amount FROM pay
WHERE (is_true IS NULL OR is_true) AND payment_type IN ('method_0', 'method_2') AND CAST(event_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
  AND date_sub('day', event_time, TIMESTAMP '2024-03-15') < 60
""")
def valid_recent_payments(r):
    confirmed = F.col("is_true").isNull() | F.col("is_true")
    chosen = confirmed & F.col("payment_type").isin("method_0", "method_2") & F.to_date("event_time").between("2024-01-05", "2024-01-25")
    return splits.recent_or_old(r.payments.filter(chosen), "event_time", AS_OF, 60).select("pay_id", "account_id", "pay_amount")


@query("B4", oracle="""
, f AS (SELECT *, min(event_time) OVER (PARTITION BY account_id) AS first_pay_time FROM pay)
SELECT f.pay_id, f.account_id FROM f LEFT JOIN disp d ON f.pay_id = d.pay_id AND f.account_id = d.account_id
WHERE f.first_pay_time < d.dispute_time - INTERVAL 7 DAY OR d.dispute_time IS NULL
""")
def payments_without_early_dispute(r):
    started = r.payments.join(profile.first_payments(r.payments), "account_id")
    return profile.undisputed_at_first(joins.with_disputes(started, r.disputes)).select("pay_id", "account_id")


@query("B6", oracle=f"""
SELECT account_id, {sql_rd('sum(CASE WHEN bet_money > 0 THEN win_amount ELSE 0 END)', 2)} AS money_win,
  CAST(sum(CASE WHEN bet_chips > 0 THEN 1 ELSE 0 END) AS BIGINT) AS chip_rounds FROM plays GROUP BY 1
""")
def conditional_sums(r):
    sums = {
        "money_win": F.sum(F.when(F.col("bet_money") > 0, F.col("win_amount")).otherwise(0.0)),
        "chip_rounds": F.sum(F.when(F.col("bet_chips") > 0, 1).otherwise(0)),
    }
    return rollups.sums_by(r.plays, ["account_id"], sums).withColumn("money_win", rd("money_win", 2))


@query("B10", "H34", oracle=f"""
SELECT spin_id, {sql_rd('CASE WHEN bet_money = 0 THEN 0 ELSE coalesce(win_amount / nullif(bet_money, 0), 0) END')} AS return_rate FROM plays
""")
def gaps_filled(r):
    raw = r.plays.select("spin_id", float_ratio(F.col("win_amount"), F.col("bet_money")).alias("return_rate"))
    return fill_gaps(raw, ["return_rate"]).withColumn("return_rate", rd("return_rate"))


@query("B11", oracle="""
SELECT 'l_quantity' AS column_name, min(l_quantity) = max(l_quantity) AS is_constant FROM lineitem
UNION ALL SELECT 'l_tax', min(l_tax) = max(l_tax) FROM lineitem
UNION ALL SELECT 'nothing', true
""")
def constant_columns(r):
    return cols.constant_flags(r.table("lineitem").withColumn("nothing", F.lit(0)), ["l_quantity", "l_tax", "nothing"])


@query("B12", oracle="""
SELECT 'win_amount' AS column_name, false AS is_infinite FROM (SELECT 1) UNION ALL
SELECT 'return_rate', (SELECT count(*) > 0 FROM plays WHERE bet_money = 0 AND win_amount > 0)
""")
def infinite_columns(r):
    raw = r.plays.withColumn("return_rate", float_ratio(F.col("win_amount"), F.col("bet_money")))
    return cols.infinite_flags(raw, ["win_amount", "return_rate"])


@query("B13", "G4", oracle="SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_combinations(r):
    return r.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


@query("B14", oracle="""
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 100
""")
def random_rows(r):
    return splits.random_rows(r.table("orders").select("o_orderkey", "o_custkey"), 100, "o_orderkey")


@query("C1", "H2", oracle="""
SELECT b.spin_id, b.account_id, CAST(floor(date_sub('minute', u.register_time, b.event_time) / 1440.0) AS INTEGER) AS matuirity_day
FROM plays b JOIN usr u ON b.account_id = u.account_id AND b.event_time > u.register_time
""")
def plays_after_registration(r):
    return joins.after_registration(r.plays, r.users).select("spin_id", "account_id", "matuirity_day")


@query("C2", oracle=f"""
SELECT p.pay_id, p.account_id, {sql_time('d.dispute_time')} AS disputed_at
FROM pay p LEFT JOIN disp d ON p.pay_id = d.pay_id AND p.account_id = d.account_id
""")
def payments_with_disputes(r):
    return joins.with_disputes(r.payments, r.disputes).select("pay_id", "account_id", when_text("dispute_time").alias("disputed_at"))


@query("C3", oracle=f"""
SELECT p.pay_id, p.account_id, {sql_time('d.dispute_time')} AS disputed_at
FROM pay p LEFT JOIN (SELECT * FROM disp WHERE kind = 'pay_dispute') d ON p.pay_id = d.pay_id
""")
def payments_with_disputes_by_id(r):
    found = joins.with_disputes(r.payments, r.disputes.filter("kind = 'pay_dispute'"), same_account=False)
    return found.select("pay_id", "account_id", when_text("dispute_time").alias("disputed_at"))


@query("C4", oracle="""
SELECT account_id, bundle_id FROM usr WHERE account_id IN (SELECT DISTINCT account_id FROM pay WHERE pay_amount > 150)
""")
def users_with_large_payment(r):
    return joins.having_events(r.users, r.payments.filter("pay_amount > 150")).select("account_id", "bundle_id")


@query("C5", "B2", oracle="""
SELECT b.account_id, m.matuirity_day FROM (SELECT DISTINCT matuirity_day FROM regpay) m
CROSS JOIN (SELECT DISTINCT account_id, register_time FROM regpay) b
WHERE CAST(b.register_time AS DATE) + CAST(m.matuirity_day + 30 AS INTEGER) < DATE '2024-02-20'
""")
def maturity_spine(r):
    registered = joins.after_registration(r.payments, r.users)
    return joins.maturity_spine(payers_of(registered), registered, "2024-02-20").select("account_id", "matuirity_day")


@query("B2", oracle="""
SELECT pay_id, account_id, matuirity_day FROM regpay
WHERE CAST(register_time AS DATE) + CAST(matuirity_day + 30 AS INTEGER) < DATE '2024-02-20'
""")
def payments_with_closed_outcome(r):
    return joins.outcome_closed(joins.after_registration(r.payments, r.users), "2024-02-20").select("pay_id", "account_id", "matuirity_day")


@query("C7", oracle="""
, f AS (SELECT account_id, min(event_time) AS first_pay_time FROM pay GROUP BY 1)
SELECT b.spin_id, b.account_id FROM plays b JOIN f ON b.account_id = f.account_id
WHERE b.event_time BETWEEN f.first_pay_time AND f.first_pay_time + INTERVAL 10080 MINUTE
""")
def plays_in_first_week(r):
    return joins.in_first_week(r.plays, profile.first_payments(r.payments)).select("spin_id", "account_id")


@query("C8", "E1", oracle=f"""
, f AS (SELECT account_id, min(event_time) AS first_pay_time FROM pay WHERE pay_amount > 100 GROUP BY 1),
b AS (SELECT account_id, bet_money FROM plays WHERE bet_money > 100)
SELECT f.account_id, {sql_time('f.first_pay_time')} AS first_paid, CAST(count(b.account_id) AS BIGINT) AS rounds, {sql_rd('coalesce(sum(b.bet_money), 0)', 2)} AS bet
FROM b RIGHT JOIN f ON b.account_id = f.account_id GROUP BY f.account_id, f.first_pay_time
""")
def large_payers_with_or_without_rounds(r):
    payers = profile.first_payments(r.payments.filter("pay_amount > 100"))
    measures = r.plays.filter("bet_money > 100").groupBy("account_id").agg(F.count("*").alias("rounds"), F.sum("bet_money").alias("bet"))
    kept = joins.keep_all(payers, measures).na.fill(0, ["rounds", "bet"])
    return kept.select("account_id", when_text("first_pay_time").alias("first_paid"), "rounds", rd("bet", 2).alias("bet"))


@query("C9", oracle=f"""
SELECT a.account_id, a.session_id, CAST(count(*) AS BIGINT) AS pairs, CAST(max(date_sub('second', a.event_time, b.event_time)) AS BIGINT) AS longest_seconds,
  CAST(min(date_sub('second', a.event_time, b.event_time)) AS BIGINT) AS shortest_seconds, {sql_rd('sum(a.win_amount - a.bet_money)', 2)} AS net_over_pairs
FROM plays a JOIN results b ON a.account_id = b.account_id AND a.session_id = b.session_id GROUP BY 1, 2
""")
def session_pairs(r):
    return joins.session_pairs(r.plays, r.results).withColumn("net_over_pairs", rd("net_over_pairs", 2))


@query("C10", oracle="""
SELECT u.account_id, CAST(count(b.event_time) AS BIGINT) AS payments_in_10d FROM usr u LEFT JOIN pay b
ON u.account_id = b.account_id AND u.register_time < b.event_time AND date_sub('day', u.register_time, b.event_time) <= 10 GROUP BY 1
""")
def payments_within_horizon(r):
    counts = joins.within_horizon(r.payments, r.users, 10).groupBy("account_id").agg(F.count("*").alias("payments_in_10d"))
    return joins.keep_all(r.users.select("account_id"), counts).na.fill(0, ["payments_in_10d"])


@query("C11", oracle=f"""
SELECT a.withdraw_id, a.account_id, {sql_rd('a.amount - a.withdraw_fee', 2)} AS apply_amount, {sql_time('b.event_time')} AS paid_at, {sql_rd('b.amount', 2)} AS paid_amount
FROM applied a LEFT JOIN paid_out b ON a.withdraw_id = b.withdraw_id AND a.account_id = b.account_id
""")
def withdrawals_with_payouts(r):
    found = joins.withdrawals(r.withdrawals_applied, r.withdrawals_paid)
    return found.select("withdraw_id", "account_id", *rds(["apply_amount"], 2), when_text("paid_time").alias("paid_at"), *rds(["paid_amount"], 2))


@query("C12", oracle=f"""
, g1 AS (SELECT l_returnflag, l_linenumber, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2),
g2 AS (SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
g3 AS (SELECT l_returnflag, l_linenumber, avg(l_discount) AS discount FROM lineitem GROUP BY 1, 2)
SELECT g1.l_returnflag, g1.l_linenumber, quantity, CAST(n AS BIGINT) AS n, {sql_rd('discount')} AS discount
FROM g1 JOIN g2 ON g1.l_returnflag = g2.l_returnflag AND g1.l_linenumber = g2.l_linenumber
JOIN g3 ON g1.l_returnflag = g3.l_returnflag AND g1.l_linenumber = g3.l_linenumber
""")
def sibling_sums(r):
    measures = {"quantity": F.sum("l_quantity"), "n": F.count("*"), "discount": F.avg("l_discount")}
    return rollups.sums_by(r.table("lineitem"), ["l_returnflag", "l_linenumber"], measures).withColumn("discount", rd("discount"))


@query("G3", "H4", oracle="""
SELECT account_id, 'block' AS side, CAST(strftime(register_time, '%Y%m%d') AS INTEGER) AS register_day FROM usr WHERE account_id % 3 = 1
UNION ALL SELECT account_id, 'rest', CAST(strftime(register_time, '%Y%m%d') AS INTEGER) FROM usr WHERE account_id % 3 <> 1
""")
def block_and_rest(r):
    from riskrules.functions.timeunits import day_number

    users = r.users.select("account_id", (F.col("account_id") % 3).alias("b"), day_number(F.col("register_time")).alias("register_day"))
    block, rest = splits.block_and_rest(users, "b", 1)
    sides = [d.select("account_id", F.lit(n).alias("side"), "register_day") for n, d in (("block", block), ("rest", rest))]
    return tables.one_table(sides)


@query("L21", oracle="""
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-04-01' THEN 'train' ELSE 'test' END AS part FROM orders
""")
def temporal_split(r):
    train, test = splits.before_and_from(r.table("orders"), "o_orderdate", "1998-04-01")
    return tables.one_table([d.select("o_orderkey", F.lit(n).alias("part")) for n, d in (("train", train), ("test", test))])


@query("L22", oracle="""
SELECT CASE WHEN substr(md5('42:' || o_custkey), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS part, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1
""")
def random_split(r):
    train, test = splits.random_split(r.table("orders"), "o_custkey", 0.2)
    sides = tables.one_table([d.select("o_orderkey", F.lit(n).alias("part")) for n, d in (("train", train), ("test", test))])
    return reports.block_rates(sides.withColumn("one", F.lit(1)), "part", "one").select("part", "n")


@query("H31", oracle="""
SELECT CAST(p.pay_id AS BIGINT) AS pay_id, CASE WHEN d.pay_id IS NULL THEN 0 ELSE 1 END AS disputed FROM pay p LEFT JOIN disp d ON p.pay_id = d.pay_id
""")
def disputed_label(r):
    found = joins.with_disputes(r.payments, r.disputes)
    return found.select("pay_id", binary_label(F.col("dispute_time").isNotNull().cast("int")).alias("disputed"))
