"""Time arithmetic in complete units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440


def complete_units(unit: str, start: Column, end: Column) -> Column:
    """Whole SECONDs, MINUTEs, HOURs or DAYs between two instants (boundaries are not counted)."""
    return F.timestamp_diff(unit.upper(), start, end)


def maturity_day(register_time: Column, event_time: Column) -> Column:
    """Day of life of an account: 0 for the first 24 hours after registration."""
    minutes = complete_units("MINUTE", register_time, event_time)
    return F.floor(minutes / F.lit(MINUTES_PER_DAY)).cast("int")


def add_days(ts: Column, days: Column | int) -> Column:
    return F.timestamp_add("DAY", F.lit(days) if isinstance(days, int) else days, ts)


def add_minutes(ts: Column, minutes: int) -> Column:
    return F.timestamp_add("MINUTE", F.lit(minutes), ts)


def shift_hours(ts: Column, hours: int) -> Column:
    """Move a UTC instant to a fixed-offset local time."""
    return F.timestamp_add("HOUR", F.lit(hours), ts)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def day_number(ts: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def in_working_hours(ts: Column) -> Column:
    return F.hour(ts).between(9, 17)


def in_waking_hours(ts: Column) -> Column:
    """Hours 6 to 23. The panel column fed by this is called ``payments_sleeptime``."""
    return F.hour(ts).between(6, 23)


def on_weekend(ts: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(ts) >= 5


def at_night(ts: Column) -> Column:
    """Hours 0 to 5."""
    return F.hour(ts) < 6


def local_time_bucket(ts: Column) -> Column:
    """Quarter of the day: 0 before 6h, 1 until 12h, 2 until 18h, 3 after."""
    return F.floor(F.hour(ts) / 6).cast("int")


def time_slot(ts: Column, minutes: int) -> Column:
    """Number of the fixed-width time slot an instant falls in; splits long histories into parts."""
    return F.floor(F.unix_seconds(ts) / F.lit(60 * minutes))
