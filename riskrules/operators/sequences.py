"""Sequence measures from payment rows: density in time, gaps, first amounts, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrules.operators.ordered import Running, first_per_key, grouped_median, running

MICROS_PER_MINUTE = 60_000_000
# The published window widths in minutes.
DENSITY_MINUTES = (2, 3, 5, 10, 30, 60, 120)


def payment_density(payments: DataFrame, widths: Sequence[int] = DENSITY_MINUTES, key: str = "account_id", time: str = "event_time") -> DataFrame:
    """Largest number of payments in any window of each width, ends included.

    Some fullest window ends at a payment. So payments of one instant are counted first, each instant
    comes in at its time and goes out after the last time a window from it reaches, and a running sum of
    both is the number of payments in the window that ends there.
    """
    instants = payments.groupBy(key, F.unix_micros(F.col(time)).alias("t")).agg(F.count("*").alias("n"))
    comes = F.struct(F.col("t").alias("at"), F.lit(0).alias("width"))
    goes = [F.struct((F.col("t") + w * MICROS_PER_MINUTE).alias("at"), F.lit(w).alias("width")) for w in widths]
    # At the same instant payments come before others go: their width is 0.
    points = instants.select(key, "n", F.inline(F.array(comes, *goes)))
    change = {w: F.when(F.col("width") == 0, F.col("n")).when(F.col("width") == w, -F.col("n")).otherwise(0) for w in widths}
    inside = running(points, [key], ["at", "width"], {f"_in_{w}": Running("sum", change[w]) for w in widths})
    return inside.filter("width = 0").groupBy(key).agg(*[F.max(f"_in_{w}").alias(f"max_num_payments_{w}_minutes") for w in widths])


def first_amounts(payments: DataFrame, key: str = "account_id", time: str = "event_time", tie: str = "pay_id") -> DataFrame:
    """First three amounts and the minutes between them, one row per account."""
    few = first_per_key(payments.select(key, time, tie, "pay_amount"), [key], [time, tie], 3)

    def nth(n: int, c: str):
        return F.max(F.when(F.col("position") == n, F.col(c)))

    names = ("first", "second", "third")
    wide = few.groupBy(key).agg(
        *[nth(i + 1, "pay_amount").alias(f"{n}_payment") for i, n in enumerate(names)],
        *[nth(i + 1, time).alias(f"{n}_datetime") for i, n in enumerate(names)],
    )
    def minutes(a: str, b: str):
        return (F.unix_micros(f"{b}_datetime") - F.unix_micros(f"{a}_datetime")) / MICROS_PER_MINUTE

    return wide.withColumns(
        {"minutes_first_to_second": minutes("first", "second"), "minutes_second_to_third": minutes("second", "third")}
    )


def amount_stats(payments: DataFrame, key: str = "account_id", amount: str = "pay_amount") -> DataFrame:
    """Count, mean, extremes and exact median of an account's payments, from rows.

    A payment history is never gathered; see ``grouped_median``.
    """
    values = payments.groupBy(key, amount).agg(F.count("*").alias("n"))
    measures = values.groupBy(key).agg(
        F.sum("n").alias("number_payments"),
        F.try_divide(F.sum(F.col(amount) * F.col("n")), F.sum("n")).alias("average_payment"),
        F.max(amount).alias("maximum_payment"),
        F.min(amount).alias("minimum_payment"),
    )
    middle = grouped_median(payments, key, amount).withColumnRenamed("median", "median_payment")
    return measures.join(middle, key, "left").withColumns(
        {
            "rel_maximum_payment": F.try_divide("maximum_payment", "average_payment"),
            "rel_payment_range": F.try_divide(F.col("maximum_payment") - F.col("minimum_payment"), F.col("minimum_payment")),
        }
    )
