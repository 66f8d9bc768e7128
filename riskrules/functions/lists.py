"""Functions over list columns: one array per row, never collected here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_numbers(text: Column) -> Column:
    """``[1.5, null, 3]`` as text to array<double>; items that read ``null`` become null."""
    return F.from_json(text, "array<double>")


def parse_times(text: Column) -> Column:
    """List of timestamps as text, tolerant of quotes and blanks; bad items become null."""
    bare = F.regexp_replace(text, r"[\[\]'\"]", "")
    return F.transform(F.split(bare, ","), lambda item: F.try_to_timestamp(F.trim(item)))


def parse_words(text: Column) -> Column:
    bare = F.regexp_replace(text, r"[\[\]'\"]", "")
    return F.transform(F.split(bare, ","), lambda item: F.trim(item))


def mean(items: Column) -> Column:
    total = F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(items))


def with_payment_stats(df: DataFrame, column: str) -> DataFrame:
    """Median, mean, extremes and their ratios; a list with a missing item has no statistics.

    The list is sorted once, nulls first: the ends give the extremes and tell of missing items.
    """
    line, n = F.col("_line"), F.size("_line")
    sorted_once = df.withColumn("_line", F.sort_array(F.col(column)))
    bottom = F.get(line, 0)
    middle = (F.get(line, F.floor((n - 1) / 2).cast("int")) + F.get(line, F.floor(n / 2).cast("int"))) / 2
    known = F.when(bottom.isNotNull(), F.struct(middle.alias("median"), mean(line).alias("mean"), F.get(line, n - 1).alias("top"), bottom.alias("bottom")))
    parts = sorted_once.withColumn("_of", known)
    top, average, low = F.col("_of.top"), F.col("_of.mean"), F.col("_of.bottom")
    return parts.withColumns(
        {
            "median_payment": F.col("_of.median"),
            "average_payment": average,
            "maximum_payment": top,
            "rel_maximum_payment": F.try_divide(top, average),
            "minimum_payment": low,
            "rel_payment_range": F.try_divide(top - low, low),
        }
    ).drop("_line", "_of")


def pick(items: Column, position: int) -> Column:
    """Item at a 1-based position, null when the list is shorter."""
    return F.try_element_at(items, F.lit(position))


def distinct_label(items: Column) -> Column:
    """The distinct items in sorted order, as one text."""
    return F.array_join(F.array_sort(F.array_distinct(items)), ",")


def keyword_flag(items: Column, word: str) -> Column:
    """1 when any item contains the word."""
    return F.coalesce(F.exists(items, lambda x: x.contains(word)), F.lit(False)).cast("int")


def text_flag(text: Column, word: str) -> Column:
    return F.coalesce(text.contains(word), F.lit(False)).cast("int")


def seconds_of(hours: float) -> int:
    return int(round(hours * 3600))


def sum_within_hours(times: Column, amounts: Column, start: Column, hours: float) -> Column:
    """Sum of the amounts whose time is at most ``hours`` after ``start`` (no lower bound)."""
    limit = F.timestamp_add("SECOND", F.lit(seconds_of(hours)), start)
    pairs = F.arrays_zip(times.alias("t"), amounts.alias("a"))
    return F.aggregate(
        F.filter(pairs, lambda p: (p["t"] <= limit) & p["a"].isNotNull()),
        F.lit(0.0),
        lambda acc, p: acc + p["a"],
    )


def tail(items: Column, count: int = 7) -> Column:
    """The last ``count`` items (all of them when there are fewer)."""
    return F.slice(items, F.greatest(F.size(items) - (count - 1), F.lit(1)), F.lit(count))


def tail_pattern(items: Column, count: int = 7) -> Column:
    return F.array_join(tail(items, count), ",")


def last_item(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def sum_slice(items: Column, first: int, count: int) -> Column:
    """Sum of ``count`` items from 1-based ``first``; null when the list ends before."""
    part = F.slice(items, first, count)
    total = F.aggregate(part, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(items) >= first + count - 1, total)


def step_flags(items: Column, share: float = 0.1) -> Column:
    """1 where an item exceeds the previous one by more than ``share`` of it."""
    def flag(x: Column, i: Column) -> Column:
        before = F.get(items, i - 1)
        return F.when(i == 0, 0).otherwise(F.coalesce(x > before + before * share, F.lit(False)).cast("int"))

    return F.transform(items, flag)


def recharge_and_loss_flags(times: Column, losses: Column, days: int = 2, step: float = 1.0) -> Column:
    """1 where a payment follows the one before within ``days`` and the loss grew by more than ``step``."""
    def flag(t: Column, i: Column) -> Column:
        gap = F.unix_micros(t) - F.unix_micros(F.get(times, i - 1))
        close = F.floor(gap / F.lit(86_400_000_000)) <= days
        grew = F.get(losses, i) - F.get(losses, i - 1) > step
        return F.when(i == 0, 0).otherwise(F.coalesce(close & grew, F.lit(False)).cast("int"))

    return F.transform(times, flag)
