"""Ratios, guards, growth and other row-level measures."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding of the value as written with eight decimals.

    A mean that lies half-way in exact arithmetic is not pushed down by float noise.
    """
    return F.round(F.round(value, 8), digits)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null on a zero or missing denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def float_ratio(top: Column, bottom: Column) -> Column:
    """Division with floating-point rules: x/0 is signed infinity, 0/0 is NaN."""
    by_zero = F.when(top > 0, F.lit(INF)).when(top < 0, F.lit(-INF)).when(top == 0, F.lit(float("nan")))
    return F.when(bottom == 0, by_zero).otherwise(F.try_divide(top, bottom))


def exceeds(value: Column, limit: float) -> Column:
    """``value > limit`` where NaN and null count as no (Spark orders NaN above everything)."""
    return F.coalesce(~F.isnan(value) & (value > limit), F.lit(False))


def finite(value: Column) -> Column:
    """Null in place of NaN and the infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(INF)), value)


def filled(value: Column, default: float = 0.0) -> Column:
    """NaN, infinity and null replaced by a default."""
    return F.coalesce(finite(value), F.lit(default))


def fill_gaps(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    return df.withColumns({c: filled(F.col(c).cast("double"), default) for c in columns})


# The growth levels that a percent change is rounded to.
GROWTH_LEVELS = (20, 50, 100, 200, 300, 500)


def round_to_levels(value: Column, levels: Sequence[int] = GROWTH_LEVELS) -> Column:
    """Nearest level; zero stays zero, null stays null, the lower level wins a tie."""
    options = F.array(*[F.struct(F.abs(value - level).alias("gap"), F.lit(level).alias("level")) for level in levels])
    return F.when(value == 0, 0).when(value.isNotNull(), F.array_min(options)["level"])


def growth_chain(columns: Sequence[str], levels: Sequence[int] = GROWTH_LEVELS) -> dict[str, Column]:
    """Rounded percent change of every column against the one before it."""
    out = {}
    for before, after in zip(columns, columns[1:]):
        change = ratio((F.col(after) - F.col(before)) * 100, F.col(before))
        out[f"{after}_percentual"] = round_to_levels(change, levels)
    return out


def growth_shape(columns: Sequence[str]) -> Column:
    """The growth levels as one text, ``na`` for an unknown one."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("na")) for c in columns])


def shares_of(columns: Sequence[str], whole: str) -> dict[str, Column]:
    return {f"{c}_rel": ratio(F.col(c), F.col(whole)) for c in columns}


def betting_ratios(payments: str) -> dict[str, Column]:
    """Return to player by day, growth of the average bet and bets over payments."""
    out = {
        "increase_avg_bet_1_3": ratio(F.col("avg_bet_day_3"), F.col("avg_bet_day_1")),
        "increase_avg_bet_3_7": ratio(F.col("avg_bet_day_7"), F.col("avg_bet_day_3")),
    }
    for day in (1, 3, 7):
        out[f"rtp_day_{day}"] = ratio(F.col(f"sum_win_day_{day}"), F.col(f"sum_bet_day_{day}"))
    out["bet_relative_to_payment"] = ratio(F.col("sum_bet_day_7"), F.col(payments))
    return out


def normalised_panel() -> dict[str, Column]:
    """Panel amounts relative to their own total, from the columns of the user-day panel."""
    games = F.col("local_time_before_6") + F.col("local_time_6_to_12") + F.col("local_time_12_to_18") + F.col("local_time_after_18")
    out = {
        "max_payment_rel": ratio(F.col("max_payment"), F.col("spent_to_date")),
        "max_daily_spent_rel": ratio(F.col("max_daily_spent"), F.col("spent_to_date")),
        "max_games_daily_games_rel": ratio(F.col("max_games_daily_games"), F.col("games_to_date")),
        "daily_games_first_1d_rel": ratio(F.col("daily_games_first_1d"), F.col("games_to_date")),
        "win_spent_ratio": F.col("win_amount_to_date") / (F.col("spent_to_date") + F.lit(0.0001)),
    }
    for part in ("before_6", "6_to_12", "12_to_18", "after_18"):
        out[f"local_time_{part}_rel"] = ratio(F.col(f"local_time_{part}"), games)
    return out


def log_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Natural logarithm; null where the value is not positive."""
    return {f"l_{c}": F.ln(F.when(F.col(c) > 0, F.col(c))) for c in columns}


def divided_columns(tops: Sequence[str], bottoms: Sequence[str]) -> dict[str, Column]:
    """Pairwise ratios; the lists are zipped, as the shorter one ends first."""
    return {f"ratio_{a}_to_{b}": ratio(F.col(a), F.col(b)) for a, b in zip(tops, bottoms)}


def product_columns(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(columns, 2)}


def outside_fences(column: str, q1: float, q3: float, reach: float = 1.5) -> Column:
    """1 when a value lies more than ``reach`` inter-quartile ranges outside the quartiles."""
    width = reach * (q3 - q1)
    value = F.col(column)
    return F.coalesce((value < q1 - width) | (value > q3 + width), F.lit(False)).cast("int")


def binary_label(count: Column) -> Column:
    return F.coalesce(count > 0, F.lit(False)).cast("int")


# The names of the six life-time segments.
SEGMENTS = (
    "maturity_day < 14 & payments > 1",
    "maturity_day < 14 & payments = 1",
    "maturity_day > 14 & paying_matuirity < 14 & payments > 1",
    "maturity_day > 14 & paying_matuirity < 14 & payments = 1",
    "maturity_day > 14 & paying_matuirity > 14 & payments > 1",
    "maturity_day > 14 & paying_matuirity > 14 & payments = 1",
)


def segment(maturity: Column, paying_maturity: Column, payments: Column, turn: int = 14) -> Column:
    """Life-time segment; null when the maturity, or a paying maturity that matters, is unknown."""
    many = F.coalesce(payments > 1, F.lit(False))
    def split(first: int) -> Column:
        return F.when(many, SEGMENTS[first]).otherwise(SEGMENTS[first + 1])

    return (
        F.when(maturity < turn, split(0))
        .when((maturity >= turn) & (paying_maturity < turn), split(2))
        .when((maturity >= turn) & (paying_maturity >= turn), split(4))
    )


def percent_text(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def error_margin(rate: Column, n: Column, z: float = 1.645) -> Column:
    """Half-width of the 90 % interval of a rate, three decimals."""
    return rounded(z * F.sqrt(F.try_divide(rate * (1 - rate), n)), 3)
