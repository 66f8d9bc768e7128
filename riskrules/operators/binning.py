"""Quantile edges, bins, indicators and pivots.

Edges are few and live on the driver; everything per row stays in Spark. An indicator column
``feature > edge`` is never written out: the number of edges below a value implies all of them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.functions.measures import finite
from riskrules.operators.ordered import cut_points
from riskrules.operators.quantiles import edge_table, quantile_table
from riskrules.session import cut, small

Edges = dict[str, list[float]]
# Rows of a slot that one task orders.
SLOT_ROWS = 100_000
MAX_SLOTS = 20_000


def _plain(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns as doubles with NaN and the infinities as null."""
    values = [finite(F.col(c).cast("double")).alias(c) for c in columns]
    return df.select(*keep, *values)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    slot_rows: int = SLOT_ROWS,
) -> dict:
    """Quantiles with linear interpolation, exact at any size; an action.

    Returns column -> list of values, or group -> column -> list when ``by`` is given: for a handful of
    groups, as they come to the driver (``quantiles.quantile_table`` keeps them as a table).
    Infinities and NaN count as unknown; a column or group without known values has an empty list. The way is the
    same at every size: (1) cut points from a sample lay every column into slots of at most about
    ``slot_rows`` rows, (2) slot counts and their running sums tell which slots hold the wanted ranks,
    (3) only those slots are ordered, each by itself. The driver gets the slots that hold ranks (at
    most two per group, column and probability) and the values found.
    """
    columns, probabilities = list(columns), list(probabilities)
    if by:
        out = {r[by]: {c: [] for c in columns} for r in df.filter(F.col(by).isNotNull()).select(by).distinct().collect()}
        for r in quantile_table(df, columns, probabilities, [by]).collect():
            out[r[by]][r["column"]] = list(r["values"])
        return out
    data, out = _plain(df, columns), {c: [] for c in columns}
    rows = data.count()
    # With more slots than ranks most rows are out after the slot counts.
    slots = min(max(math.ceil(rows / slot_rows), min(8 * len(probabilities), 1024), 2), MAX_SLOTS)
    placed = edge_counts(data, cut_points(data, columns, slots, rows), suffix="_slot")
    long = placed.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"{c}_slot").alias("s"), F.col(c).alias("v")) for c in columns]))).filter(F.col("v").isNotNull())

    sizes = long.groupBy("c", "s").agg(F.count("*").alias("n"))
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy("c")))
    places = [(F.col("total") - 1) * F.lit(float(p)) for p in probabilities]
    ranks = F.array_sort(F.array_distinct(F.array(*[f(x) for x in places for f in (F.floor, F.ceil)])))
    inside = F.filter(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
    wanted = sizes.select("c", "s", "start", "total", inside.alias("ranks")).filter(F.size("ranks") > 0).collect()
    totals = {r["c"]: r["total"] for r in wanted}

    slots_wanted = df.sparkSession.createDataFrame([tuple(r[k] for k in ("c", "s", "start", "ranks")) for r in wanted], "c string, s int, start long, ranks array<long>")
    slots_wanted = small(slots_wanted, len(wanted), 3 + 2 * len(probabilities))
    key = ["c", "s"]
    near = long.join(slots_wanted, key, "left_semi")
    values = near.groupBy(*key, "v").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    summed = values.withColumn("end", F.sum("n").over(upto))
    first, last = F.col("start") + F.col("end") - F.col("n"), F.col("start") + F.col("end")
    found = summed.join(slots_wanted, key).select("c", "v", F.filter("ranks", lambda r: (r >= first) & (r < last)).alias("hit"))
    at = {(r["c"], r["rank"]): r["v"] for r in found.select("c", "v", F.explode("hit").alias("rank")).collect()}
    for c, total in totals.items():
        out[c] = [_between(at, c, (total - 1) * p) for p in probabilities]
    return out


def _between(at: dict, c: str, position: float) -> float:
    low, high = at[c, math.floor(position)], at[c, math.ceil(position)]
    return low if low == high else (math.ceil(position) - position) * low + (position - math.floor(position)) * high


def quantile_edges(df: DataFrame, columns: Sequence[str], quantiles: int, by: str | None = None, **how) -> dict:
    """Distinct edges of equal-share bins, lowest and highest value included."""
    shares = [i / quantiles for i in range(quantiles + 1)]
    found = exact_quantiles(df, columns, shares, by=by, **how)

    def distinct(qs: dict) -> Edges:
        return {c: sorted(set(v)) for c, v in qs.items()}

    return {g: distinct(qs) for g, qs in found.items()} if by else distinct(found)


def edge_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], suffix: str = "_above") -> DataFrame:
    """Per column the number of its edges strictly below the value; 0 for null and NaN.

    ``edges`` must be sorted and distinct. ``Bucketizer`` finds the place by binary search; it
    closes bins on the left, so it is given negated values and edges.
    """
    names = list(edges)
    searched = [c for c in names if edges[c]]
    out = df.withColumns({f"_neg_{c}": 0.0 - F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in searched}) if searched else df
    if searched:
        splits = [[-math.inf, *sorted(0.0 - e for e in edges[c]), math.inf] for c in searched]
        out = Bucketizer(
            inputCols=[f"_neg_{c}" for c in searched], outputCols=[f"_at_{c}" for c in searched], splitsArray=splits, handleInvalid="keep"
        ).transform(out)
    found = {
        f"{c}{suffix}": F.when(F.col(f"_neg_{c}").isNull(), 0).otherwise(F.lit(len(edges[c])) - F.col(f"_at_{c}").cast("int"))
        if edges[c]
        else F.lit(0)
        for c in names
    }
    return out.withColumns(found).drop(*[f"_{p}_{c}" for p in ("neg", "at") for c in searched])


def with_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], suffix: str = "_quantile") -> DataFrame:
    """Adds the bin number and the bin's left edge; bins are right-closed, the lowest value included.

    Values outside the edges (a new table binned with old edges) and nulls have no bin.
    """
    inner = {c: list(e[1:-1]) for c, e in edges.items()}
    counted = edge_counts(df, inner, suffix="_bin")
    out = {}
    for c, e in edges.items():
        value = finite(F.col(c).cast("double"))
        inside = value.between(e[0], e[-1]) if len(e) > 1 else F.lit(False)
        number = F.when(inside, F.col(f"{c}_bin"))
        out[f"{c}_bin"] = number
        lefts = F.array(*[F.lit(float(x)) for x in (e[:-1] or [float("nan")])])
        out[f"{c}{suffix}"] = F.when(number.isNotNull(), F.get(lefts, F.col(f"{c}_bin")))
    return counted.withColumns(out)


def indicator_thresholds(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> Edges:
    """Thresholds of the cumulative indicators: left edges of the filled bins but the last; an action.

    One pass counts the bins of every column.
    """
    names = list(edges)
    binned = with_bins(_plain(df, names), edges)
    filled = binned.agg(*[F.array_sort(F.collect_set(f"{c}_quantile")).alias(c) for c in names]).first()
    return {c: list(filled[c])[:-1] for c in names}


def indicators(df: DataFrame, thresholds: Mapping[str, Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """Long form of the indicators: one row per input row and (feature, threshold), 0 or 1.

    Only for inspection and export; mining works on ``edge_counts``.
    """
    above = edge_counts(df, thresholds)
    items = [
        F.struct(F.lit(c).alias("feature"), F.lit(float(t)).alias("threshold"), (F.col(f"{c}_above") > i).cast("int").alias("value"))
        for c, ts in thresholds.items()
        for i, t in enumerate(ts)
    ]
    return above.select(*keep, F.inline(F.array(*items)))


def quantile_flags(df: DataFrame, quantiles: Mapping[str, Sequence[float]]) -> DataFrame:
    """Flag ``i`` of a column: the value exceeds its quantile ``i - 1`` (of evenly spaced ones, from 0)."""
    flags = {}
    for c, qs in quantiles.items():
        for i in range(1, len(qs) - 1):
            value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            flags[f"{c}_quantile_{i}"] = F.coalesce(value > float(qs[i - 1]), F.lit(False)).cast("int")
    return df.withColumns(flags)


def supported_values(df: DataFrame, column: str, label: str, at_least: int | None = None, exactly: int | None = None) -> DataFrame:
    """Values of a column whose labels add up to enough (or exactly to a number)."""
    sums = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.sum(label).alias("positives"), F.count("*").alias("n"))
    return sums.filter(F.col("positives") >= at_least if exactly is None else F.col("positives") == exactly)


def pattern_indicators(df: DataFrame, column: str, patterns: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Rows whose value is a kept pattern, with the indicator's name; all other indicators are 0.

    ``patterns`` may come from an older table, so that new data is encoded the same way.
    """
    known = df.join(patterns.select(column), column, "left_semi")
    return known.select(*keep, F.concat(F.lit(f"{prefix}_"), F.col(column)).alias("indicator"))


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per given value."""
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in values}
    return df.withColumns(flags)


def distinct_values(df: DataFrame, column: str, limit: int = 10_000) -> list:
    """The values of a category, for ``one_hot``; refuses what is not a category."""
    found = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    return sorted(found)


def rounded_bins(df: DataFrame, columns: Sequence[str], quantiles: int = 5, digits: int = 1) -> tuple[DataFrame, Edges]:
    """Bins whose edges are rounded first; values below a rounded-up lowest edge have none. An action."""
    edges = {c: sorted({round(e, digits) for e in es}) for c, es in quantile_edges(df, columns, quantiles).items()}
    return with_bins(df, edges), edges


def range_labels(edges: Sequence[float]) -> list[str]:
    return [f"{a:.2f}-{b:.2f}" for a, b in zip(edges, edges[1:])]


def quantile_pivot(df: DataFrame, x: str, y: str, label: str, x_quantiles: int, y_quantiles: int, how=F.avg) -> DataFrame:
    """Table of the label by quantile ranges of two columns, rows ``y`` and columns ``x``. An action for the edges."""
    edges = {**quantile_edges(df, [x], x_quantiles), **quantile_edges(df, [y], y_quantiles)}
    binned = with_bins(df, edges)
    names = range_labels(edges[x])
    table = (
        binned.filter(F.col(f"{x}_bin").isNotNull() & F.col(f"{y}_bin").isNotNull())
        .groupBy(f"{y}_bin")
        .pivot(f"{x}_bin", list(range(len(names))))
        .agg(how(F.col(label)))
    )
    rows = F.array(*[F.lit(t) for t in range_labels(edges[y])])
    ranged = table.withColumn(f"{y}_range", F.get(rows, F.col(f"{y}_bin"))).drop(f"{y}_bin")
    return ranged.withColumnsRenamed({str(i): n for i, n in enumerate(names)})


def time_blocks(df: DataFrame, day: str, blocks: int) -> DataFrame:
    """Validation block of each row: equal-share bins of a day number. An action for the edges."""
    edges = quantile_edges(df, [day], blocks)
    return with_bins(df, edges).withColumnRenamed(f"{day}_bin", "block").drop(f"{day}_quantile")


def codes_by_group(df: DataFrame, columns: Sequence[str], by: str, quantiles: int) -> DataFrame:
    """Bin numbers from each group's own edges, which are a table of one row per group, joined back to the
    data. An action for the edges."""
    edges = edge_table(df, columns, quantiles, [by])
    wide = edges.groupBy(F.col(by).alias("_g")).agg(F.map_from_entries(F.collect_list(F.struct("column", "edges"))).alias("_e"))  # as many as columns
    wide = cut(wide)
    joined = df.join(small(wide, wide.count(), 1 + len(columns) * (quantiles + 1)), df[by] == wide["_g"])

    def code(c: str) -> Column:
        e, v = F.col("_e")[c], F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        inner = F.slice(e, 2, F.greatest(F.size(e) - 2, F.lit(0)))
        return F.when(v.isNotNull() & (F.size(e) > 1), F.size(F.filter(inner, lambda x: x < v)))

    return joined.withColumns({f"{c}_code": code(c) for c in columns}).drop("_g", "_e")
