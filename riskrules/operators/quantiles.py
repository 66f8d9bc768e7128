"""Exact quantiles per group, with groups, ranks and values as tables.

A double is turned into a whole number of the same order, made of its sign, exponent and mantissa. The
cells that hold the wanted ranks are then refined digit by digit: a histogram over the next 16 bits of the
rows in those cells, a running sum along it, and the ranks pass to the cells they fall in. After four
digits a cell is one value. No round sees more than 2^16 cells of one parent in a window, however many
rows or equal values a group has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.functions.measures import finite
from riskrules.session import cut, small

DIGIT_BITS, DIGITS = 16, 4
_MANTISSA = 1 << 52


def ordered_numbers(df: DataFrame, numbers: Mapping[str, Column]) -> DataFrame:
    """``df`` with a long of the same order as each finite double: its magnitude's exponent and mantissa, with
    its sign; null for unknown numbers.

    Each step is a projection of its own, as the next one reads it several times.
    """
    steps: list[dict[str, Column]] = [{} for _ in range(4)]
    names = [f"_{step}_{name}" for name in numbers for step in ("v", "a", "e", "m")]
    for name, value in numbers.items():
        v, a, e, m = (f"_{step}_{name}" for step in ("v", "a", "e", "m"))
        steps[0][v] = value
        guess = F.least(F.greatest(F.floor(F.log2(F.abs(v))), F.lit(-1022)), F.lit(1023)).cast("int")
        steps[1] |= {a: F.abs(v), e: F.when(F.col(v) != 0, guess)}
        # Dividing by powers of two is exact; the logarithm may be off by one.
        steps[2][m] = F.col(a) / F.pow(F.lit(2.0), F.col(e))
        above, below = F.col(m) >= 2, (F.col(m) < 1) & (F.col(e) > -1022)
        exponent = F.when(above, F.col(e) + 1).when(below, F.col(e) - 1).otherwise(F.col(e))
        share = F.when(above, F.col(m) / 2).when(below, F.col(m) * 2).otherwise(F.col(m))
        steps[3] |= {e: exponent, m: share}
    for step in steps:
        df = df.withColumns(step)
    # Shares below 1 only belong to numbers too small for a full mantissa.
    whole = {
        name: F.when(F.col(f"_m_{name}") >= 1, (F.col(f"_e_{name}") + 1022).cast("long") * _MANTISSA).otherwise(0) + (F.col(f"_m_{name}") * _MANTISSA).cast("long")
        for name in numbers
    }
    df = df.withColumns({f"_a_{name}": bits for name, bits in whole.items()})
    signed = {name: F.when(F.col(f"_v_{name}") < 0, -F.col(f"_a_{name}")).when(F.col(f"_v_{name}") == 0, F.lit(0).cast("long")).otherwise(F.col(f"_a_{name}")) for name in numbers}
    return df.withColumns(signed).drop(*names)


def number_back(bits: Column) -> Column:
    a = F.abs(bits)
    exponent = F.shiftright(a, 52).cast("int")
    rest = F.pmod(a, F.lit(_MANTISSA)) / float(_MANTISSA)
    size = F.when(exponent > 0, (1 + rest) * F.pow(F.lit(2.0), exponent - 1023)).otherwise(rest * F.pow(F.lit(2.0), F.lit(-1022)))
    return F.when(bits < 0, -size).otherwise(size)


def quantile_table(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """A written row per group and column: (*by, column, n, values), ``values`` in the order of the probabilities.

    Quantiles interpolate linearly. Null, NaN and the infinities are unknown; groups with a null key are
    left out, as are groups and columns without known values.
    """
    columns, by, shares = list(columns), list(by), [float(p) for p in probabilities]
    known = df
    for k in by:
        known = known.filter(F.col(k).isNotNull())
    numbers = known.select(*by, *[finite(F.col(c).cast("double")).alias(f"_x{i}") for i, c in enumerate(columns)])
    narrow = cut(ordered_numbers(numbers, {f"_{i}": F.col(f"_x{i}") for i in range(len(columns))}).drop(*[f"_x{i}" for i in range(len(columns))]))
    at = [*by, "column"]

    def cells(digit: int) -> DataFrame:
        """(*by, column, prefix) of every known value: its first ``digit`` digits."""
        prefix = lambda i: F.shiftright(F.col(f"_{i}"), DIGIT_BITS * (DIGITS - digit))
        items = [F.struct(F.lit(c).alias("column"), prefix(i).alias("prefix")) for i, c in enumerate(columns)]
        return narrow.select(*by, F.inline(F.array(*items))).filter("prefix IS NOT NULL")

    inside = lambda: F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
    counts = cells(1).groupBy(*at, "prefix").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*at).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*at, "prefix", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy(*at)).alias("total"))
    around = F.transform(F.lit(shares), lambda p: F.array(F.floor((F.col("total") - 1) * p), F.ceil((F.col("total") - 1) * p)))
    wanted = counts.withColumn("ranks", F.array_distinct(F.flatten(around)))
    wanted = cut(wanted.withColumn("ranks", inside()).filter(F.size("ranks") > 0).drop("n"))
    for digit in range(2, DIGITS + 1):
        parents = wanted.withColumnRenamed("prefix", "parent")
        counts = cells(digit).withColumn("parent", F.shiftright("prefix", DIGIT_BITS))
        rows = wanted.count()
        narrowed = small(parents, rows, len(at) + 3 + 2 * len(shares))
        if narrowed is not parents:
            counts = counts.join(F.broadcast(parents.select(*at, "parent")), [*at, "parent"], "left_semi")
        # With many groups rows are counted by cell first, so that no cell's rows meet in the join.
        counts = counts.groupBy(*at, "parent", "prefix").agg(F.count("*").alias("n")).join(narrowed, [*at, "parent"])
        before = Window.partitionBy(*at, "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        wanted = cut(counts.withColumn("ranks", inside()).filter(F.size("ranks") > 0).select(*at, "prefix", "start", "total", "ranks"))
    found = wanted.select(*at, "total", number_back(F.col("prefix")).alias("value"), F.explode("ranks").alias("rank"))
    listed = found.groupBy(*at).agg(F.max("total").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("of"))  # at most two ranks per probability

    def between(p: Column) -> Column:
        place = (F.col("n") - 1) * p
        low, high = F.col("of")[F.floor(place)], F.col("of")[F.ceil(place)]
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    return cut(listed.select(*at, "n", F.transform(F.lit(shares), between).alias("values")))


def edge_table(df: DataFrame, columns: Sequence[str], quantiles: int, by: Sequence[str] = ()) -> DataFrame:
    """(*by, column, n, edges): distinct edges of equal-share bins, lowest and highest value included."""
    found = quantile_table(df, columns, [i / quantiles for i in range(quantiles + 1)], by)
    return found.select(*by, "column", "n", F.array_sort(F.array_distinct("values")).alias("edges"))
