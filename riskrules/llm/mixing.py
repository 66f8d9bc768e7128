"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source asks for its share by weight of all words; a source stops at three times its own words and
what it leaves is shared by weight among the rest, until no target is above its cap. The level (words per
weight) is found by a few grouped sums over the table of sources, with only numbers on the driver.

A source's rows are then taken ``floor(target / size)`` times, and a seeded sample of them once more: in
the order of a seeded hash until the rest of the target is reached. Hash ranges are summed first, so no
source is ordered as a whole; only sums of 4,096 ranges per source and the rows inside a range are. The
sample ends below the rest; one further row, the one whose size is nearest to what is missing, is added
where that brings the source nearer to its target. So a plan is one row per source and a row's repeats
follow from its own hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrules.llm.common import part_starts
from riskrules.session import cut

MOST_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 20_240_607
RANGE_BITS = 12  # hash ranges per source
_BLANKS = "[\\x20\\x09-\\x0D]"


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    at_edge = lambda c: c.rlike(_BLANKS).cast("int")
    n = F.size(F.split(text, f"{_BLANKS}+")) - at_edge(F.substring(text, 1, 1)) - at_edge(F.substring(text, -1, 1))
    return F.when(text.isNull() | (text == ""), 0).when(text.rlike(f"^{_BLANKS}+$"), 0).otherwise(n).cast("long")


def _source(name: str) -> Column:
    """A key that is never null and differs for null and empty sources."""
    return F.coalesce(F.concat(F.lit("s"), F.col(name)), F.lit("n"))


def _draw(key: str, source: str, seed: int) -> Column:
    """A seeded 63-bit number of a row's id and source."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key).cast("long"), F.col(source)), 1)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """(doc_id, source_key, source_name, size, draw) of every row."""
    body = F.col(text).cast("string")
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), _source(source).alias("source_key"), F.col(source).alias("source_name"), words(body).alias("size"), _draw(key, source, seed).alias("draw")
    )


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source_key, source_size, target): weights repeat over the sources by code point, null last."""
    sources = rows.groupBy("source_key", "source_name").agg(F.sum("size").alias("source_size"))
    ordered = sources.repartitionByRange(F.col("source_name").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ordered = cut(ordered)
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source_name").asc_nulls_last()))
    ranks = ordered.withColumn("inside", inside).join(part_starts(ordered.withColumn("one", F.lit(1)), "part", "one"), "part")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("start") + F.col("inside") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = cut(ranks.select("source_key", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).alias("cap")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, done = 0.0, False
    while not done:
        full = F.col("cap") <= level * F.col("weight")
        taken, open_weight = table.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not open_weight:  # nothing left to fill: all sources are empty or at their caps
            break
        risen = (total - taken) / open_weight
        done, level = risen <= level, max(level, risen)
    return table.select("source_key", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * level).alias("target"))


def plan(rows: DataFrame, goals: DataFrame, epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source_key, source_size, target, whole, last, extra): a row is taken ``whole`` times, and once
    more if its draw is at most ``last`` or equal to ``extra``."""
    size = F.greatest(F.col("source_size"), F.lit(1))
    goals = goals.withColumn("whole", F.least(F.floor(F.col("target") / size), F.lit(epochs)).cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = rows.withColumn("range", F.shiftright("draw", 63 - RANGE_BITS)).select("source_key", "range", "draw", "size")
    ranges = rows.groupBy("source_key", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows at most
    ranges = ranges.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).join(goals, "source_key")
    ranges = ranges.select("source_key", "range", "before", "rest").filter("before <= rest")
    inside = Window.partitionBy("source_key", "range").orderBy("draw").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    some = rows.join(ranges, ["source_key", "range"]).withColumn("upto", F.col("before") + F.sum("size").over(inside))
    last = some.filter("upto <= rest").groupBy("source_key").agg(F.max("draw").alias("last"), F.max("upto").alias("upto"))
    state = cut(goals.join(last, "source_key", "left").withColumn("missing", F.col("rest") - F.coalesce("upto", F.lit(0))))
    # Rows of one draw go together, so their sizes count together.
    left = rows.groupBy("source_key", "draw").agg(F.sum("size").alias("size")).join(state.select("source_key", "last", "missing"), "source_key")
    left = left.filter(F.col("draw") > F.coalesce("last", F.lit(-1))).withColumn("off", F.abs(F.col("size") - F.col("missing"))).filter("off < missing")
    extra = left.groupBy("source_key").agg(F.min(F.struct("off", "draw"))["draw"].alias("extra"))
    return cut(state.join(extra, "source_key", "left").select("source_key", "source_size", "target", "whole", "last", "extra"))


def repeats(epochs: int) -> Column:
    more = (F.col("draw") <= F.coalesce("last", F.lit(-1))) | F.coalesce(F.col("draw") == F.col("extra"), F.lit(False))
    return F.least(F.col("whole") + more.cast("long"), F.lit(epochs).cast("long"))  # texts without words fit into any rest


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, epochs: int = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row.

    A null or blank text has size 0. Null is a source of its own, after all others. Rows of equal id and
    source are drawn together. An empty table gives no rows.
    """
    rows = cut(measured(docs, key, text, source, seed))
    chosen = plan(rows, targets(rows, weights, epochs), epochs)
    out = rows.join(chosen, "source_key")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * repeats(epochs)).alias("taken"))


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, epochs: int = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns, at most
    ``epochs`` times each; a source without words is left as it is. Null ids, repeated rows and texts
    without words are drawn like others; an empty table stays empty."""
    rows = cut(measured(docs, key, text, source, seed))
    chosen = plan(rows, targets(rows, weights, epochs), epochs)
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(whole_row, _source(source).alias("source_key"), _draw(key, source, seed).alias("draw"))
    times = F.when(F.col("source_size") == 0, F.lit(1)).otherwise(repeats(epochs)).cast("int")
    return marked.join(chosen, "source_key").select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")
