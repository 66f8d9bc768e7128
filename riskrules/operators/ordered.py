"""Running values along an account's history when one account may hold much of the data.

A window over ``partitionBy(account)`` puts an account into one task. Here rows are laid in ranges of
(keys, time, tie) of about equal size, whatever account or minute they belong to: a segmented prefix scan.
Rows are ordered inside (keys, range), range totals are carried over a small table of one row per key and
range, and the two are put together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.session import cut

SLOT = "_slot"
# Ranges per shuffle partition: with several, hashing them to tasks stays even.
RANGES_PER_PARTITION = 3


@dataclass(frozen=True)
class Running:
    """One running measure: ``kind`` is sum, count, min or max; rows to come are read with ``forward``."""

    kind: str
    value: Column
    forward: bool = False
    with_current: bool = True


_COMBINE = {
    "sum": lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b),
    "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "min": lambda a, b: F.least(a, b),
    "max": lambda a, b: F.greatest(a, b),
}
_AGGREGATE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_OVER_SLOTS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` written in ranges of (keys, order), with the number of a row's range as ``SLOT``. Only rows equal
    in all of these are bound to share a range. An action."""
    ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(ranges, *keys, *order).withColumn(SLOT, F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Running],
    slot: Column | None = None,
) -> DataFrame:
    """``df`` with running measures per ``keys`` in the order of ``order``, an action unless a ``slot`` is given.

    A ``slot`` is a number that grows with the order; without one rows are laid in ranges. Rows with a
    null key have no history: their sums, minima and maxima are null, their counts 0.
    """
    keys = list(keys)
    slotted = in_ranges(df, keys, order) if slot is None else df.withColumn(SLOT, slot)
    inside = [*keys, SLOT]
    ahead = [F.col(c) for c in order]
    back = [F.col(c).desc() for c in order]

    def within(m: Running) -> Column:
        # Rows to come are read as rows before in the reversed order: a frame that ends at
        # unboundedFollowing would be summed anew for every row.
        frame = Window.partitionBy(*inside).orderBy(*(back if m.forward else ahead))
        last = 0 if m.with_current else -1
        return _AGGREGATE[m.kind](m.value).over(frame.rowsBetween(Window.unboundedPreceding, last))

    rows = slotted.withColumns({f"_w_{name}": within(m) for name, m in measures.items()})
    totals = slotted.groupBy(*inside).agg(*[_AGGREGATE[m.kind](m.value).alias(f"_t_{name}") for name, m in measures.items()])

    def carried(name: str, m: Running) -> Column:
        frame = Window.partitionBy(*keys).orderBy(F.col(SLOT).desc() if m.forward else F.col(SLOT))
        return _OVER_SLOTS[m.kind](f"_t_{name}").over(frame.rowsBetween(Window.unboundedPreceding, -1))

    carry = totals.select(*inside, *[carried(name, m).alias(f"_c_{name}") for name, m in measures.items()])
    # Equal keys, so that the join uses the partitioning of the window.
    joined = rows.join(carry, inside, "left")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    def both(name: str, m: Running) -> Column:
        whole = F.when(known, _COMBINE[m.kind](F.col(f"_c_{name}"), F.col(f"_w_{name}")))
        return F.coalesce(whole, F.lit(0)) if m.kind == "count" else whole

    done = joined.withColumns({name: both(name, m) for name, m in measures.items()})
    return done.drop(SLOT, *[f"_{p}_{name}" for p in "wc" for name in measures])


def running_over_all(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """``df`` with running sums down the whole table in a complete order; an action.

    Rows are laid in ranges of the order; only one total per range is ordered as a whole, and those are at
    most ``RANGES_PER_PARTITION`` times the shuffle partitions.
    """
    ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = cut(df.withColumns(dict(sums)).repartitionByRange(ranges, *order).withColumn(SLOT, F.spark_partition_id()))
    totals = laid.groupBy(SLOT).agg(*[F.sum(name).alias(f"_t_{name}") for name in sums])
    before = Window.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(SLOT, *[F.sum(f"_t_{name}").over(before).alias(f"_c_{name}") for name in sums])
    inside = Window.partitionBy(SLOT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = laid.withColumns({f"_w_{name}": F.sum(name).over(inside) for name in sums}).join(F.broadcast(carry), SLOT)
    done = rows.withColumns({name: _COMBINE["sum"](F.col(f"_c_{name}"), F.col(f"_w_{name}")) for name in sums})
    return done.drop(SLOT, *[f"_{p}_{name}" for p in "wc" for name in sums])


def next_after(df: DataFrame, keys: Sequence[str], found: Mapping[str, tuple[Column, Column]], time: str = "event_time", tie: str = "event_id") -> DataFrame:
    """For every row the nearest later row of the same keys that meets a condition.

    ``found`` maps an output name to (condition, what to take from the row found). The nearest
    later row is the least (time, tie) among the rows to come, so it is a running minimum.
    """
    measures = {
        name: Running("min", F.when(test, F.struct(F.col(time).alias("_at"), F.col(tie).alias("_tie"), take.alias("_take"))), forward=True, with_current=False)
        for name, (test, take) in found.items()
    }
    out = running(df, keys, [time, tie], measures)
    return out.withColumns({name: F.col(name)["_take"] for name in found})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int, salts: int = 32) -> DataFrame:
    """The first ``count`` rows of every key with their ``position``, in two steps.

    The first step ranks inside (keys, salt) and leaves at most ``count`` rows of each, so the
    second sees at most ``salts * count`` rows per key however large the key is.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salts))
    ordering = [F.col(c) for c in order]
    part = Window.partitionBy(*keys, "_salt").orderBy(*ordering)
    whole = Window.partitionBy(*keys).orderBy(*ordering)
    few = df.withColumn("_salt", salt).withColumn("position", F.row_number().over(part)).filter(F.col("position") <= count)
    return few.withColumn("position", F.row_number().over(whole)).filter(F.col("position") <= count).drop("_salt")


def grouped_median(df: DataFrame, key: str, value: str, parts_per_octave: int = 64) -> DataFrame:
    """Exact median of ``value`` per key (column ``median``), no key gathered in one place.

    Values are counted, laid in logarithmic slots (monotone in the value), and only the slots that
    hold the two middle ranks are ordered value by value.
    """
    v = F.col(value)
    counted = df.filter(v.isNotNull() & ~F.isnan(v.cast("double"))).groupBy(key, value).agg(F.count("*").alias("_n"))
    slot = (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * parts_per_octave)).cast("long")
    counted = counted.withColumn(SLOT, slot)
    by_slot = Window.partitionBy(key).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    slots = counted.groupBy(key, SLOT).agg(F.sum("_n").alias("_size"))
    slots = slots.select(
        key, SLOT, "_size", F.coalesce(F.sum("_size").over(by_slot), F.lit(0)).alias("_start"), F.sum("_size").over(Window.partitionBy(key)).alias("_all")
    )
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    middle = slots.filter((F.col("_start") <= high) & (F.col("_start") + F.col("_size") > low))
    inside = Window.partitionBy(key, SLOT).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.join(middle, [key, SLOT]).withColumn("_upto", F.col("_start") + F.sum("_n").over(inside))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), v))

    return ranked.groupBy(key).agg(((at(low) + at(high)) / 2).alias("median"))


def cut_points(df: DataFrame, columns: Sequence[str], parts: int, rows: int, per_part: int = 50) -> dict[str, list]:
    """Values that cut each column into about ``parts`` equal shares, from a sample; an action.

    Only the balance of the parts hangs on them, never a result, so a sample of ``per_part`` rows
    per part is enough and its sketch stays small however large the table is.
    """
    fraction = min(1.0, per_part * parts / max(rows, 1))
    some = df.select(*columns) if fraction >= 1.0 else df.select(*columns).sample(fraction, seed=7)
    shares = [i / parts for i in range(1, parts)]
    found = some.agg(*[F.percentile_approx(c, shares, 10 * parts).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def global_ntile(df: DataFrame, value: str, tie: str, tiles: int, parts: int = 256) -> DataFrame:
    """``ntile(tiles) over (order by value, tie)`` without one global window.

    Rows are laid in parts between approximate quantiles of the value; a value that fills parts of
    its own is laid out further by quantiles of the tie-break. Row numbers run inside a part, on
    top of the sizes of the parts before. The cut points are the only rows the driver sees.
    """
    cuts = cut_points(df, [value, tie], parts, df.count())
    value_cuts, tie_cuts = cuts[value], cuts[tie]

    def below(column: str, edges: list) -> Column:
        return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col(column))) if edges else F.lit(0)

    on_cut = F.col(value).isin(value_cuts)
    # Values that are cut points stand alone; only those may be laid out by the tie-break.
    part = F.struct((2 * below(value, value_cuts) + on_cut.cast("int")).alias("v"), F.when(on_cut, below(tie, tie_cuts)).otherwise(0).alias("t"))
    known = df.filter(F.col(value).isNotNull()).withColumn("_part", part)
    sizes = known.groupBy("_part").agg(F.count("*").alias("_size"))
    # At most (2 * parts + 1) + parts * parts rows of sizes.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(Window.partitionBy()).alias("_all")
    )
    inside = Window.partitionBy("_part").orderBy(value, tie)
    numbered = known.withColumn("_i", F.row_number().over(inside)).join(offsets, "_part")
    row = F.col("_before") + F.col("_i") - 1
    long, extra = F.floor(F.col("_all") / tiles), F.col("_all") % tiles
    # The first ``extra`` tiles hold one row more.
    head = extra * (long + 1)
    tile = F.when(row < head, F.floor(row / (long + 1))).otherwise(extra + F.floor((row - head) / F.greatest(long, F.lit(1))))
    return numbered.withColumn("tile", (tile + 1).cast("int")).drop("_part", "_i", "_before", "_all")
