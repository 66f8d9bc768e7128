"""Row-level features: list columns, ratios, growth, transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskrules.functions import lists
from riskrules.functions import measures as m
from riskrules.operators import binning, rollups
from riskrules.plans.registry import query, rd, rds, sql_rd, sql_time, when_text
from riskrules.plans.rollup_queries import HOURS_SQL, hour_features

# One list per line item, as text: built from the row's own columns, so every list is short.
ITEMS_SQL = """
li AS (
  SELECT row_number() OVER () AS rid, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
    CASE WHEN l_linenumber = 1 THEN [l_quantity] WHEN l_linenumber = 2 THEN [l_quantity, NULL, l_tax] WHEN l_linenumber % 2 = 1 THEN [l_quantity, l_discount * 100, l_suppkey]
      ELSE [l_quantity, l_discount * 100, l_suppkey, l_quantity] END AS items,
    CASE WHEN l_linenumber = 1 THEN '[' || l_quantity || ']' WHEN l_linenumber = 2 THEN '[' || l_quantity || ', null, ' || l_tax || ']' END AS short_text
  FROM lineitem)"""


def _lists(r):
    """Line items with a list column written as text, as an extract would hold it."""
    quantity, percent, supplier, tax = (F.col(c).cast("string") for c in ("l_quantity", "_percent", "l_suppkey", "l_tax"))
    rows = r.table("lineitem").withColumn("_percent", F.col("l_discount") * 100)
    n = F.col("l_linenumber")
    body = (
        F.when(n == 1, F.concat_ws(", ", quantity))
        .when(n == 2, F.concat_ws(", ", quantity, F.lit("null"), tax))
        .when(n % 2 == 1, F.concat_ws(", ", quantity, percent, supplier))
        .otherwise(F.concat_ws(", ", quantity, percent, supplier, quantity))
    )
    return rows.withColumn("payment_history", F.concat(F.lit("["), body, F.lit("]")))


_STATS = ["median_payment", "average_payment", "maximum_payment", "minimum_payment", "rel_maximum_payment", "rel_payment_range"]
_HAS_NULL = "list_count(items) < len(items)"


def _known(expr: str) -> str:
    return f"CASE WHEN {_HAS_NULL} THEN NULL ELSE {expr} END"


@query("H5", "H7", "H8", "H9", "H10", oracle=f"""
,{ITEMS_SQL}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, CAST(len(items) AS INTEGER) AS number_payments, items[1] AS first_payment, {sql_rd('items[2]', 4)} AS second_payment,
  {sql_rd('items[3]', 4)} AS third_payment, {sql_rd(_known('list_aggregate(items, $$median$$)'), 4)} AS median_payment, {sql_rd(_known('list_avg(items)'), 4)} AS average_payment,
  {sql_rd(_known('list_max(items)'), 4)} AS maximum_payment, {sql_rd(_known('list_min(items)'), 4)} AS minimum_payment,
  {sql_rd(_known('list_max(items) / nullif(list_avg(items), 0)'), 4)} AS rel_maximum_payment,
  {sql_rd(_known('(list_max(items) - list_min(items)) / nullif(list_min(items), 0)'), 4)} AS rel_payment_range,
  CAST(len(list_distinct(items)) + CASE WHEN {_HAS_NULL} THEN 1 ELSE 0 END AS INTEGER) AS distinct_items FROM li
""")
def list_statistics(r):
    rows = _lists(r).withColumn("items", lists.parse_numbers(F.col("payment_history")))
    items = F.col("items")
    stats = lists.with_payment_stats(rows, "items")
    return stats.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", F.size(items).alias("number_payments"), lists.pick(items, 1).alias("first_payment"),
        rd(lists.pick(items, 2), 4).alias("second_payment"), rd(lists.pick(items, 3), 4).alias("third_payment"), *rds(_STATS, 4),
        F.size(F.array_distinct(items)).alias("distinct_items"),
    )


@query("H6", "H12", "H29", oracle=f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, {sql_time('l_shipdate + to_hours(10 * l_linenumber)')} AS second_time,
  {sql_rd('l_quantity + CASE WHEN 10 * l_linenumber <= 24 THEN l_tax ELSE 0 END', 4)} AS within_24h, {sql_rd('l_quantity + l_tax + CASE WHEN 40 * l_linenumber <= 168 THEN l_discount ELSE 0 END', 4)} AS within_168h,
  '0,' || CASE WHEN 10 * l_linenumber < 72 AND l_quantity - l_suppkey > 1 THEN 1 ELSE 0 END || ',' || CASE WHEN 30 * l_linenumber < 72 AND l_suppkey - l_quantity > 1 THEN 1 ELSE 0 END AS loss_flags
FROM lineitem
""")
def time_lists(r):
    rows = r.table("lineitem").withColumn("t0", F.col("l_shipdate").cast("timestamp"))
    def later(hours):
        return F.timestamp_add("HOUR", (F.lit(hours) * F.col("l_linenumber")).cast("int"), F.col("t0"))

    written = [F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSS") for t in (F.col("t0"), later(10), later(40))]
    text = F.concat(F.lit("['"), F.concat_ws("', '", *written), F.lit("']"))
    rows = rows.withColumns({"times": lists.parse_times(text), "amounts": F.array("l_quantity", "l_tax", "l_discount")})
    losses = F.array(F.col("l_suppkey").cast("double"), F.col("l_quantity"), F.col("l_suppkey").cast("double"))
    flags = lists.recharge_and_loss_flags(F.col("times"), losses)
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", when_text(F.get("times", 1)).alias("second_time"),
        rd(lists.sum_within_hours(F.col("times"), F.col("amounts"), F.col("t0"), 24), 4).alias("within_24h"),
        rd(lists.sum_within_hours(F.col("times"), F.col("amounts"), F.col("t0"), 168), 4).alias("within_168h"),
        F.array_join(flags, ",").alias("loss_flags"),
    )


@query("H10", "H11", "H23", "H28", oracle="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
  array_to_string(list_sort(list_distinct([l_returnflag, l_linestatus, 'mode_' || l_linenumber, l_returnflag])), ',') AS entries,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS has_r, CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS has_mode_3,
  l_linestatus || ',mode_' || l_linenumber || ',' || l_returnflag AS last_three,
  '0,' || CASE WHEN l_quantity > l_linenumber + l_linenumber * 0.1 THEN 1 ELSE 0 END || ',' || CASE WHEN l_suppkey > l_quantity + l_quantity * 0.1 THEN 1 ELSE 0 END AS steps
FROM lineitem
""")
def entry_lists(r):
    mode = F.concat(F.lit("mode_"), F.col("l_linenumber"))
    text = F.concat(F.lit("['"), F.concat_ws("', '", "l_returnflag", "l_linestatus", mode, "l_returnflag"), F.lit("']"))
    rows = r.table("lineitem").withColumn("items", lists.parse_words(text))
    numbers = F.array(*[F.col(c).cast("double") for c in ("l_linenumber", "l_quantity", "l_suppkey")])
    items = F.col("items")
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", lists.distinct_label(items).alias("entries"),
        lists.keyword_flag(items, "R").alias("has_r"), lists.text_flag(text, "mode_3").alias("has_mode_3"),
        lists.tail_pattern(items, 3).alias("last_three"), F.array_join(lists.step_flags(numbers), ",").alias("steps"),
    )


_CHAIN = [f"sum_payments_within_{h}_hours" for h in (24, 48, 72, 96, 168)]


def _round_sql(change: str) -> str:
    # Nearest of the levels, the lower one on a tie; zero stays.
    middles = [(20, 50), (50, 100), (100, 200), (200, 300), (300, 500)]
    cases = " ".join(f"WHEN {change} <= {(a + b) / 2} THEN {a}" for a, b in middles)
    return f"CASE WHEN {change} IS NULL THEN NULL WHEN {change} = 0 THEN 0 {cases} ELSE 500 END"


_GROWTH_SQL = {f"{b}_percentual": _round_sql(f"(({b} - {a}) * 100 / nullif({a}, 0))") for a, b in zip(_CHAIN, _CHAIN[1:])}


@query("H14", "H15", oracle=f""",{HOURS_SQL}, g AS (SELECT account_id, {', '.join(f'{e} AS {n}' for n, e in _GROWTH_SQL.items())} FROM ph)
SELECT account_id, {' || $$_$$ || '.join(f"coalesce(CAST({n} AS VARCHAR), 'na')" for n in _GROWTH_SQL)} AS payment_growth_shape FROM g
""")
def growth_shapes(r):
    rounded = hour_features(r).select("account_id", *[rd(c, 2).alias(c) for c in _CHAIN])
    chained = rounded.withColumns(m.growth_chain(_CHAIN))
    return chained.select("account_id", m.growth_shape(list(_GROWTH_SQL)).alias("payment_growth_shape"))


_REL = [f"sum_payments_within_{h}_hours" for h in ("0.25", "0.5", "1", "6", "24", "48", "72", "96")]


@query("H16", "H17", "H19", oracle=f""",{HOURS_SQL}, x AS (SELECT account_id, max(pay_amount) AS maximum_payment, count(*) AS n FROM pay GROUP BY 1)
SELECT account_id, {', '.join(sql_rd(f'"{c}" / nullif(sum_payments_within_168_hours, 0)') + f' AS "{c}_rel"' for c in _REL)},
  {', '.join(f"{sql_rd(f'sum_withdrawns_within_{h}_hours / nullif(sum_payments_within_{h}_hours, 0)')} AS withdrawn_ratio_{h}" for h in (24, 96, 168))},
  {sql_rd('sum_payments_within_24_hours / nullif(sum_withdrawns_within_24_hours, 0)')} AS pay_withdraw_ratio_24,
  {sql_rd('maximum_payment / n')} AS share_maximum_payment, {sql_rd('maximum_payment / nullif(sum_payments_within_168_hours, 0)')} AS rel_maximum_payment
FROM ph LEFT JOIN wh USING (account_id) JOIN x USING (account_id)
""")
def payment_ratios(r):
    wide = hour_features(r)
    biggest = r.payments.groupBy("account_id").agg(F.max("pay_amount").alias("maximum_payment"), F.count("*").alias("n"))
    wide = wide.withColumnsRenamed({c: c.replace(".", "_") for c in wide.columns}).join(biggest, "account_id")
    def paid(h):
        return F.col(f"sum_payments_within_{h}_hours")

    def out(h):
        return F.col(f"sum_withdrawns_within_{h}_hours")

    shares = m.shares_of([c.replace(".", "_") for c in _REL], "sum_payments_within_168_hours")
    named = dict(zip([f"{c}_rel" for c in _REL], shares.values()))
    ratios = {
        **named,
        **{f"withdrawn_ratio_{h}": m.ratio(out(h), paid(h)) for h in (24, 96, 168)},
        "pay_withdraw_ratio_24": m.ratio(paid(24), out(24)),
        "share_maximum_payment": m.ratio(F.col("maximum_payment"), F.col("n")),
        "rel_maximum_payment": m.ratio(F.col("maximum_payment"), paid(168)),
    }
    return wide.select("account_id", *[rd(e).alias(n) for n, e in ratios.items()])


_DAYS = (1, 3, 7)
_BETS_SQL = ", ".join(
    f"sum(CASE WHEN {c} <= {d} * 1440 THEN bet_money END) AS sum_bet_day_{d}, avg(CASE WHEN {c} <= {d} * 1440 THEN bet_money END) AS avg_bet_day_{d}, sum(CASE WHEN {c} <= {d} * 1440 THEN win_amount END) AS sum_win_day_{d}"
    for d in _DAYS
    for c in ["date_sub('minute', f.first_pay_time, b.event_time)"]
)
_RTP = ["increase_avg_bet_1_3", "increase_avg_bet_3_7", "rtp_day_1", "rtp_day_3", "rtp_day_7", "bet_relative_to_payment"]


@query("H18", oracle=f""",{HOURS_SQL}, bets AS (SELECT b.account_id, {_BETS_SQL} FROM plays b JOIN f ON b.account_id = f.account_id WHERE b.event_time >= f.first_pay_time GROUP BY 1)
SELECT account_id, {sql_rd('avg_bet_day_3 / nullif(avg_bet_day_1, 0)')} AS increase_avg_bet_1_3, {sql_rd('avg_bet_day_7 / nullif(avg_bet_day_3, 0)')} AS increase_avg_bet_3_7,
  {', '.join(f"{sql_rd(f'sum_win_day_{d} / nullif(sum_bet_day_{d}, 0)')} AS rtp_day_{d}" for d in _DAYS)}, {sql_rd('sum_bet_day_7 / nullif(sum_payments_within_168_hours, 0)')} AS bet_relative_to_payment
FROM bets JOIN ph USING (account_id)
""")
def betting_ratios(r):
    from riskrules.functions.timeunits import complete_units
    from riskrules.operators.profile import first_payments

    rows = r.plays.join(first_payments(r.payments), "account_id").filter(F.col("event_time") >= F.col("first_pay_time"))
    age = complete_units("MINUTE", F.col("first_pay_time"), F.col("event_time"))
    sums = []
    for d in _DAYS:
        until = age <= d * 1440
        sums += [
            F.sum(F.when(until, F.col("bet_money"))).alias(f"sum_bet_day_{d}"),
            F.avg(F.when(until, F.col("bet_money"))).alias(f"avg_bet_day_{d}"),
            F.sum(F.when(until, F.col("win_amount"))).alias(f"sum_win_day_{d}"),
        ]
    wide = rows.groupBy("account_id").agg(*sums).join(hour_features(r).select("account_id", "sum_payments_within_168_hours"), "account_id")
    return wide.withColumns(m.betting_ratios("sum_payments_within_168_hours")).select("account_id", *rds(_RTP))


@query("H24", "H25", "H26", "H32", "H33", oracle=f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {sql_rd('CASE WHEN l_extendedprice > 0 THEN ln(l_extendedprice) END')} AS l_l_extendedprice, {sql_rd('CASE WHEN l_tax > 0 THEN ln(l_tax) END')} AS l_l_tax,
  {sql_rd('l_extendedprice / nullif(l_quantity, 0)', 4)} AS ratio_l_extendedprice_to_l_quantity, {sql_rd('l_discount / nullif(l_tax, 0)', 4)} AS ratio_l_discount_to_l_tax,
  {sql_rd('l_quantity * l_discount', 4)} AS l_quantity_x_l_discount, {sql_rd('l_quantity * l_tax', 4)} AS l_quantity_x_l_tax, {sql_rd('l_discount * l_tax', 6)} AS l_discount_x_l_tax,
  CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '.00%' AS discount_text, regexp_replace('price_gt_' || l_linenumber || '_1', '_[0-9]+$', '') AS indicator
FROM lineitem
""")
def transforms(r):
    rows = r.table("lineitem").withColumns(m.log_columns(["l_extendedprice", "l_tax"])).withColumns(
        {**m.divided_columns(["l_extendedprice", "l_discount"], ["l_quantity", "l_tax"]), **m.product_columns(["l_quantity", "l_discount", "l_tax"])}
    )
    name = F.concat(F.lit("price_gt_"), F.col("l_linenumber"), F.lit("_1"))
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *rds(["l_l_extendedprice", "l_l_tax"]),
        *rds(["ratio_l_extendedprice_to_l_quantity", "ratio_l_discount_to_l_tax", "l_quantity_x_l_discount", "l_quantity_x_l_tax"], 4), *rds(["l_discount_x_l_tax"]),
        m.percent_text(F.col("l_discount")).alias("discount_text"), F.regexp_replace(name, r"_[0-9]+$", "").alias("indicator"),
    )


@query("H27", oracle=f"""
, v AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END AS value_outlier FROM events, v
""")
def outlier_flags(r):
    rows = r.table("events")
    found = binning.exact_quantiles(rows, ["value"], [0.25, 0.75])
    return rows.select("event_id", m.outside_fences("value", *found["value"]).alias("value_outlier"))


@query("H13", "A6", oracle=f"""
SELECT account_id, {sql_rd('sum(amount)', 2)} AS withdrawn, CAST(count(*) AS BIGINT) AS count_withdrawns FROM applied GROUP BY 1
""")
def withdrawal_counts(r):
    sums = {"withdrawn": F.sum("amount"), "count_withdrawns": F.count("*")}
    return rollups.sums_by(r.withdrawals_applied, ["account_id"], sums).withColumn("withdrawn", rd("withdrawn", 2))


