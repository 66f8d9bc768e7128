import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskrules.functions import columns as cols
from riskrules.functions import lists
from riskrules.functions import measures as m
from riskrules.functions import timeunits as tu


def one(spark, *exprs):
    return tuple(spark.range(1).select(*exprs).first())


def numbers(*xs):
    return F.array(*[F.lit(None if x is None else float(x)) for x in xs]).cast("array<double>")


def ts(text):
    return F.lit(text).cast("timestamp")


def test_complete_units_do_not_count_boundaries(spark):
    a, b = ts("2024-01-01 23:00:00"), ts("2024-01-02 01:00:00")
    assert one(spark, tu.complete_units("day", a, b), tu.complete_units("hour", a, b), tu.maturity_day(a, b)) == (0, 2, 0)


def test_clock_parts(spark):
    saturday, friday = ts("2024-01-06 05:59:00"), ts("2024-01-05 23:00:00")
    assert one(spark, tu.on_weekend(saturday), tu.on_weekend(friday), tu.at_night(saturday), tu.in_waking_hours(friday)) == (True, False, True, True)
    assert one(spark, tu.local_time_bucket(saturday), tu.local_time_bucket(friday), tu.day_number(friday)) == (0, 3, 20240105)


def test_short_lists(spark):
    names = ["median_payment", "average_payment", "maximum_payment", "rel_maximum_payment", "minimum_payment", "rel_payment_range"]

    def stats(items):
        return tuple(lists.with_payment_stats(spark.range(1).select(items.alias("items")), "items").select(*names).first())

    assert stats(numbers(4, 1, 3)) == (3.0, pytest.approx(8 / 3), 4.0, 1.5, 1.0, 3.0)
    assert stats(numbers(5, 1, 2, 10))[0] == 3.5
    assert stats(numbers(4, None)) == stats(F.array().cast("array<double>")) == (None,) * 6
    assert one(spark, lists.pick(numbers(7), 2), lists.last_item(numbers(7, 8))) == (None, 8.0)


def test_tail_takes_what_there_is(spark):
    long, short = F.array(*[F.lit(i) for i in range(9)]), F.array(F.lit(1), F.lit(0))
    assert one(spark, lists.tail_pattern(long), lists.tail_pattern(short)) == ("2,3,4,5,6,7,8", "1,0")


def test_time_lists_accept_quotes_and_blanks(spark):
    text = F.lit("['2024-01-01 10:00:00.500', \" 2024-01-02 10:00:00.000\", nonsense]")
    assert one(spark, lists.parse_times(text))[0] == [dt.datetime(2024, 1, 1, 10, 0, 0, 500000), dt.datetime(2024, 1, 2, 10), None]


def test_sum_within_hours_has_no_lower_bound(spark):
    times = F.array(ts("2024-01-01 00:00:00"), ts("2024-01-02 00:15:00"), ts("2024-01-02 02:00:00"))
    start = ts("2024-01-02 00:00:00")
    sums = [lists.sum_within_hours(times, numbers(1, 2, None), start, h) for h in (0.25, 0.1, 24)]
    assert one(spark, *sums) == (3.0, 1.0, 3.0)


def test_step_and_recharge_flags(spark):
    assert one(spark, lists.step_flags(numbers(10, 11, 13, 1)))[0] == [0, 0, 1, 0]
    times = F.array(ts("2024-01-01"), ts("2024-01-03 23:00:00"), ts("2024-01-07"), ts("2024-01-08"))
    assert one(spark, lists.recharge_and_loss_flags(times, numbers(0, 5, 9, 9.5)))[0] == [0, 1, 0, 0]


def test_growth_levels(spark):
    values = [0.0, -40.0, 35.0, 36.0, 1000.0, None]
    got = one(spark, *[m.round_to_levels(F.lit(v).cast("double")) for v in values])
    assert got == (0, 20, 20, 50, 500, None)


def test_zero_denominators(spark):
    one_, zero, null = F.lit(1.0), F.lit(0.0), F.lit(None).cast("double")
    assert one(spark, m.ratio(one_, zero), m.ratio(one_, null), m.filled(m.float_ratio(one_, zero)), m.filled(m.float_ratio(zero, zero))) == (None, None, 0.0, 0.0)
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    assert one(spark, m.exceeds(nan, 0.5), m.exceeds(inf, 0.5), m.exceeds(null, 0.5)) == (False, True, False)


def test_rounding_ignores_float_noise(spark):
    assert one(spark, m.rounded(F.lit(10.015), 2), m.rounded(F.lit(2.675), 2), m.rounded(F.lit(0.1 + 0.2), 1)) == (10.02, 2.68, 0.3)


def test_segments(spark):
    def seg(a, b, c):
        return m.segment(F.lit(a), F.lit(b).cast("int"), F.lit(c).cast("int"))

    got = one(spark, seg(3, 1, 2), seg(3, None, None), seg(20, 5, 1), seg(20, 15, 4), seg(20, None, 4))
    assert got == (m.SEGMENTS[0], m.SEGMENTS[1], m.SEGMENTS[3], m.SEGMENTS[4], None)


def test_choosing_and_naming_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3.0)], "a_true int, b_true double, name string, nothing double")
    assert cols.with_suffix(df, "_true") == ["a_true", "b_true"]
    assert cols.containing(df, "na", "noth") == ["name", "nothing"]
    assert cols.numeric(df) == ["a_true", "b_true", "nothing"]
    assert cols.strip_suffix(df, "_true").columns == ["a", "b", "name", "nothing"]
    assert cols.rename_by(df, str.upper).columns == ["A_TRUE", "B_TRUE", "NAME", "NOTHING"]
    assert cols.without(df.columns, ["name", "absent"]) == ["a_true", "b_true", "nothing"]


def test_constant_and_infinite_columns(spark):
    df = spark.createDataFrame([(1.0, float("inf"), None), (1.0, 2.0, None)], "a double, b double, c double")
    assert {r[0]: r[1] for r in cols.constant_flags(df, ["a", "b", "c"]).collect()} == {"a": True, "b": False, "c": True}
    assert {r[0]: r[1] for r in cols.infinite_flags(df, ["a", "b", "c"]).collect()} == {"a": False, "b": True, "c": False}
