"""Wins and losses along a session.

A session is a key (account, session). Its rounds are ordered in ranges as in ``operators.ordered``, so a
session, or a minute of it, that holds much of the data is spread over several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskrules.functions.measures import float_ratio
from riskrules.operators.ordered import SLOT, Running, in_ranges, running

KEYS = ["account_id", "session_id"]


def session_losses(rounds: DataFrame, tie: str = "spin_id") -> DataFrame:
    """Rounds with the last loss before them, the winnings since and how much of those is lost later.

    A win counts once any loss of the session lies before it (the streak never resets). The
    subsequent profit of a session's last round is unknown, not zero.
    """
    net = F.col("win_amount") - F.col("bet_money")
    lost = F.when(net > 0, None).otherwise(F.col("event_time"))
    order = ["event_time", tie]
    base = in_ranges(rounds.withColumn("net_win", net), KEYS, order)
    inside = [*KEYS, SLOT]
    upto = Window.partitionBy(*inside).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    # Inside a range: the last loss, and the winnings split by whether the range has had a loss yet. The
    # wins before it count only if an earlier range had one, and those at the range's first instant only
    # if that loss was before this instant.
    local = base.withColumns({"_loss": F.max(lost).over(upto), "_first": F.min("event_time").over(upto)})
    won = F.when(F.col("_loss").isNull() | (F.col("event_time") > F.col("_loss")), F.col("net_win"))
    at_first = F.col("event_time") == F.col("_first")
    parts = {"_after": F.col("_loss").isNotNull(), "_before": F.col("_loss").isNull() & ~at_first, "_start": F.col("_loss").isNull() & at_first}
    local = local.withColumns({c: F.when(test, won) for c, test in parts.items()})

    # Totals of ranges and what the ranges before and after add.
    slots = local.groupBy(*inside).agg(
        F.max("_loss").alias("loss"),
        F.min("event_time").alias("first"),
        *[f(c).alias(f"{n}{c}") for c in parts for n, f in (("n", F.count), ("s", F.sum))],
        F.sum("net_win").alias("net"),
        F.count("*").alias("rows"),
    )
    past = Window.partitionBy(*KEYS).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*KEYS)
    slots = slots.withColumn("loss_so_far", F.max("loss").over(past))
    seen, seen_before = F.col("loss_so_far").isNotNull(), F.coalesce(F.col("loss_so_far") < F.col("first"), F.lit(False))

    def slot_part(n: str):
        earlier = F.when(seen, F.coalesce(f"{n}_before", F.lit(0))).otherwise(0) + F.when(seen_before, F.coalesce(f"{n}_start", F.lit(0))).otherwise(0)
        return F.coalesce(f"{n}_after", F.lit(0)) + earlier

    slots = slots.withColumns({"streak_n": slot_part("n"), "streak_s": slot_part("s")})
    carry = slots.select(
        *inside,
        F.col("loss_so_far"),
        seen_before.alias("seen_before"),
        *[F.coalesce(F.sum(c).over(past), F.lit(0)).alias(f"{c}_past") for c in ("streak_n", "streak_s", "net", "rows")],
        F.sum("net").over(whole).alias("net_all"),
        F.sum("rows").over(whole).alias("rows_all"),
    )

    def inner(how, c: str):
        return F.coalesce(how(c).over(upto), F.lit(0))

    local = local.withColumns(
        {
            **{f"_{n}{c}": inner(how, c) for c in parts for n, how in (("n", F.count), ("s", F.sum))},
            "_net": F.sum("net_win").over(upto),
            "_rows": F.count(F.lit(1)).over(upto),
        }
    )
    joined = local.join(carry, inside, "left")
    earlier = F.col("loss_so_far").isNotNull()

    def streak(n: str):
        own = F.when(earlier, F.col(f"_{n}_before")).otherwise(0) + F.when(F.col("seen_before"), F.col(f"_{n}_start")).otherwise(0)
        return F.col(f"streak_{n}_past") + F.col(f"_{n}_after") + own

    size, value = streak("n"), streak("s")
    rest = F.col("net_all") - F.col("net_past") - F.col("_net")
    is_last = F.col("rows_past") + F.col("_rows") == F.col("rows_all")
    out = joined.select(
        *rounds.columns,
        "net_win",
        F.greatest("_loss", "loss_so_far").alias("last_loss"),
        size.cast("long").alias("win_streak_size"),
        value.alias("win_streak_value"),
        # Rounded so that rounds which cancel out give an exact zero.
        F.when(~is_last, F.round(rest, 6)).alias("subsequent_profit"),
    )
    v, s = F.col("win_streak_value"), F.col("subsequent_profit")
    return out.withColumn("relative_loss", F.lit(1.0) - float_ratio(v + s, v))


def win_runs(rounds: DataFrame, tie: str = "spin_id") -> DataFrame:
    """Rounds with the length of the current run of wins, which does reset at a loss."""
    base = rounds.withColumn("won", (F.col("win_amount") - F.col("bet_money") > 0).cast("int"))
    losses = running(base, KEYS, ["event_time", tie], {"_run": Running("count", F.when(F.col("won") == 0, 1))})
    # A run is the wins that share a number of losses before them.
    numbered = running(losses, [*KEYS, "_run"], ["event_time", tie], {"win_run": Running("sum", F.col("won"))})
    return numbered.drop("_run", "won")
