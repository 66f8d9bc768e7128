"""From one wide event table to the roles the operators work on.

The operators never see source names; another log needs only another class with these
properties. Here payments are purchases, disputes are the first later error with the same user
and item, rounds are clicks that win what the next view of the item is worth, and withdrawals
are views that succeed with the next click.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrules.operators.ordered import next_after
from riskrules.session import configure
from riskrules.sources.tables import parquet

# The day the extract was taken; outcome windows are closed against it.
AS_OF = "2024-03-15"


class EventRoles:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def table(self, name: str) -> DataFrame:
        return parquet(self.spark, self.folder, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            F.col("user_id").alias("account_id"),
            F.col("ts").cast("timestamp").alias("event_time"),
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("item"),
        )

    def of_type(self, event_type: str) -> DataFrame:
        return self.events.filter(F.col("event_type") == event_type)

    def followed(self, first: str, then: str, *take: str) -> DataFrame:
        """Events of one type with the next event of another, for the same user and item.

        Only these two types are shuffled.
        """
        both = self.events.filter(F.col("event_type").isin(first, then))
        found = {"following": (F.col("event_type") == then, F.struct(*take))}
        return next_after(both, ["account_id", "item"], found).filter(F.col("event_type") == first)

    @cached_property
    def users(self) -> DataFrame:
        first = self.of_type("signup").groupBy("account_id").agg(F.min("event_time").alias("register_time"))
        return first.select("account_id", "register_time", F.concat(F.lit("bundle_"), (F.col("account_id") % 3).cast("string")).alias("bundle_id"))

    @property
    def _payment_columns(self) -> list[Column]:
        item = F.col("item")
        confirmed = F.when(item % 10 == 0, F.lit(None).cast("boolean")).otherwise(item % 10 != 9)
        return [
            F.col("event_id").alias("pay_id"),
            F.col("account_id"),
            F.col("event_time"),
            F.col("value").alias("pay_amount"),
            F.concat(F.lit("method_"), (item % 3).cast("string")).alias("payment_type"),
            F.concat(F.lit("entry_"), (item % 4).cast("string")).alias("pay_entry"),
            confirmed.alias("is_true"),
        ]

    @cached_property
    def payments(self) -> DataFrame:
        return self.of_type("purchase").select(*self._payment_columns)

    @cached_property
    def disputes(self) -> DataFrame:
        """At most one dispute per payment."""
        disputed = self.followed("purchase", "error", "event_time").filter(F.col("following").isNotNull())
        return disputed.select(
            F.col("event_id").alias("pay_id"),
            "account_id",
            F.col("following.event_time").alias("dispute_time"),
            F.when(F.col("item") % 4 == 0, "fraud").otherwise("pay_dispute").alias("kind"),
        )

    @property
    def _bet_columns(self) -> list[Column]:
        on_chips = F.col("item") % 5 == 0
        return [
            F.col("event_id").alias("spin_id"),
            F.col("account_id"),
            F.col("event_time"),
            F.when(on_chips, F.col("value")).otherwise(0.0).alias("bet_chips"),
            F.when(on_chips, 0.0).otherwise(F.col("value")).alias("bet_money"),
            F.col("item").alias("machine_id"),
            F.col("item").alias("session_id"),
        ]

    @cached_property
    def bets(self) -> DataFrame:
        """Rounds without what they won: no need to look for it."""
        return self.of_type("click").select(*self._bet_columns)

    @cached_property
    def plays(self) -> DataFrame:
        won = F.coalesce("following.value", F.lit(0.0)).alias("win_amount")
        return self.followed("click", "view", "value").select(*self._bet_columns, won)

    @cached_property
    def starts(self) -> DataFrame:
        return self.of_type("click").select("account_id", "event_time", F.col("item").alias("game_id"), F.col("item").alias("session_id"))

    @cached_property
    def results(self) -> DataFrame:
        return self.of_type("view").select("account_id", "event_time", F.col("item").alias("session_id"))

    @cached_property
    def withdrawals_applied(self) -> DataFrame:
        return self.of_type("view").select(
            F.col("event_id").alias("withdraw_id"), "account_id", "event_time", F.col("value").alias("amount"), F.lit(0.0).alias("withdraw_fee")
        )

    @cached_property
    def withdrawals_paid(self) -> DataFrame:
        paid = self.followed("view", "click", "event_time", "value").filter(F.col("following").isNotNull())
        return paid.select(
            F.col("event_id").alias("withdraw_id"),
            "account_id",
            F.col("following.event_time").alias("event_time"),
            F.col("following.value").alias("amount"),
            F.lit(0.0).alias("withdraw_fee"),
        )

    @cached_property
    def tickets(self) -> DataFrame:
        return self.of_type("error").select("account_id", "event_time")

    @cached_property
    def currency_changes(self) -> DataFrame:
        moved = self.events.filter(F.col("event_type").isin("click", "view"))
        return moved.select(
            "account_id",
            "event_time",
            F.when(F.col("event_type") == "click", -F.col("value")).otherwise(F.col("value")).alias("coin_change"),
            F.col("item").cast("double").alias("bonus_change"),
            (F.col("value") - F.col("item")).alias("money_change"),
        )

    @cached_property
    def ads(self) -> DataFrame:
        return self.of_type("view").select("account_id", "event_time", F.col("value").alias("revenue"))
