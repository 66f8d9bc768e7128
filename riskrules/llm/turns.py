"""Conversations as rows of turns with fingerprints that compose, and joins that hold out against hot keys.

The fingerprint of a sequence of turns is its product in a monoid: every turn is a pair of values below a
prime, and two sequences join by ``F(uv) = F(u) * B^len(v) + F(v)`` for two fixed bases B. So prefixes cut
apart by a task's border, or taken from two conversations, are joined without their texts, and the last
turn can be taken off again.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskrules.session import cut

PRIME = (1 << 61) - 1
BASES = (1_000_000_007 * 998_244_353, 1_234_567_891_011_121_314)  # any two values below the prime
INVERSES = tuple(pow(b, -1, PRIME) for b in BASES)

TURN = "conv_id long, part int, turn_no long, f1 long, f2 long, d1 long, d2 long, v1 long, v2 long, weight long, upto long, payload binary"
# Rows of one key that a join leaves together, at most this share of all, or this number where that is more.
KEY_SHARE, KEY_ROWS = 1 / 64, 500


def turn_values(role: bytes, text: bytes) -> tuple[int, int, int, int]:
    """Two values for the product and 128 further bits to compare turns by, of the SHA-256 of the turn."""
    v1, v2, d1, d2 = struct.unpack("<QQqq", hashlib.sha256(struct.pack("<Q", len(role)) + role + text).digest())
    return v1 % PRIME, v2 % PRIME, d1, d2


def power(base: int, n: int) -> int:
    return pow(BASES[base], n, PRIME)


def shifted(base: int) -> Callable:
    """A column function (f, add, n): f + add * B^n; rows without ``add`` stay."""

    @pandas_udf("long")
    def moved(f: pd.Series, add: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([(int(a) + int(b) * power(base, int(k))) % PRIME if b else int(a) for a, b, k in zip(f, add, n)], dtype="int64")

    return moved


def shortened(base: int) -> Callable:
    """A column function (f, v): the product without its last turn, whose value is ``v``."""

    @pandas_udf("long")
    def cut_off(f: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([(int(a) - int(b)) * INVERSES[base] % PRIME for a, b in zip(f, v)], dtype="int64")

    return cut_off


Weigh = Callable[[list[bytes], list[bytes]], tuple[list[int], list[bytes | None]]]


def text_bytes(roles: list[bytes], texts: list[bytes]) -> tuple[list[int], list[bytes | None]]:
    return [len(t) for t in texts], [None] * len(texts)


def numbered(rows: DataFrame, weigh: Callable[[], Weigh], key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A written table of turns, in order of (turn, role, text), null turns first: ``turn_no`` from 0, the
    prefix's fingerprint ``f1, f2``, comparison bits ``d1, d2`` and values ``v1, v2`` of the turn, its
    ``weight`` and ``payload`` by ``weigh``, and ``upto``, the weight of the prefix.

    Null roles and texts count as empty; rows without an id belong to no conversation and are left out.
    Turns are ordered by range, so that a conversation of any length is shared among tasks; the product
    and number of a conversation's turns in earlier tasks is joined to its later ones.
    """
    empty = F.lit(b"")
    plain = rows.select(
        F.col(key).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("binary"), empty).alias("role"),
        F.coalesce(F.col(text).cast("binary"), empty).alias("text"),
    ).filter("conv_id IS NOT NULL")
    ordered = plain.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, weighed, conv, at = TaskContext.get().partitionId(), weigh(), None, None
        for batch in batches:
            ids, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            weights, payloads = weighed(roles, texts)
            out: list[tuple] = []
            for c, r, t, w in zip(ids, roles, texts, weights):
                if c != conv:
                    conv, at = c, (0, 0, 0, 0)
                v1, v2, d1, d2 = turn_values(r, t)
                n, f1, f2, upto = at
                at = n + 1, (f1 * BASES[0] + v1) % PRIME, (f2 * BASES[1] + v2) % PRIME, upto + w
                out.append((n, at[1], at[2], d1, d2, v1, v2, w, at[3]))
            columns = [pa.array(x, pa.int64()) for x in zip(*out)] if out else [pa.array([], pa.int64())] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([part] * len(ids), pa.int32()), *columns, pa.array(payloads, pa.binary())],
                names=[f.split()[0] for f in TURN.split(", ")],
            )

    return _carried(cut(ordered.select("conv_id", "role", "text").mapInArrow(run, TURN)))


def _carried(turns: DataFrame) -> DataFrame:
    """The same with numbers, weights and products that count a conversation's turns in earlier parts.

    The driver sees the first and last id of every part, and for ids that go on from one part to the next
    a row per part: at most two rows a part.
    """
    ends = sorted(turns.groupBy("part").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("b")).collect(), key=lambda r: r.part)
    spanning = sorted({p.b for p, q in zip(ends, ends[1:]) if p.b == q.a})
    if not spanning:
        return turns
    last = turns.filter(F.col("conv_id").isin(spanning)).groupBy("conv_id", "part").agg(F.max(F.struct("turn_no", "f1", "f2", "upto")).alias("x"))
    carries, conv, at = [], None, (0, 0, 0, 0)
    for r in last.orderBy("conv_id", "part").collect():
        if r.conv_id != conv:
            conv, at = r.conv_id, (0, 0, 0, 0)
        if at[0]:
            carries.append((r.part, conv, *at))
        k = r.x.turn_no + 1
        at = at[0] + k, (at[1] * power(0, k) + r.x.f1) % PRIME, (at[2] * power(1, k) + r.x.f2) % PRIME, at[3] + r.x.upto
    carry = F.broadcast(turns.sparkSession.createDataFrame(carries, "part int, conv_id long, _n long, _f1 long, _f2 long, _upto long"))
    where, names = ["part", "conv_id"], turns.columns
    moved = turns.filter(F.col("conv_id").isin(spanning)).join(carry, where)
    moved = moved.withColumns(
        {
            "f1": shifted(0)("f1", "_f1", F.col("turn_no") + 1),
            "f2": shifted(1)("f2", "_f2", F.col("turn_no") + 1),
            "turn_no": F.col("turn_no") + F.col("_n"),
            "upto": F.col("upto") + F.col("_upto"),
        }
    ).select(names)
    return turns.join(carry, where, "left_anti").select(names).union(moved)


def looked_up(rows: DataFrame, table: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per ``key``.

    Keys that hold more than their share of the rows are dealt over several tasks, with as many copies of
    their one row of the table. Such keys are fewer than 1 / KEY_SHARE, so they are broadcast. ``rows`` is
    read twice: give a written table.
    """
    key = list(key)
    counts = rows.groupBy(*key).agg(F.count("*").alias("_count"))
    limit = max(int(rows.count() * KEY_SHARE), KEY_ROWS)
    heavy = counts.filter(F.col("_count") > limit).collect()
    if not heavy:
        return rows.join(table, key, how)
    schema = ", ".join([*(f"{k} {rows.schema[k].dataType.simpleString()}" for k in key), "_parts int"])
    heavy = rows.sparkSession.createDataFrame([(*[r[k] for k in key], -(-r["_count"] // limit)) for r in heavy], schema)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(F.broadcast(heavy), key, "left").withColumn("_deal", F.pmod(F.xxhash64(*rows.columns), parts).cast("int")).drop("_parts")
    copies = table.join(F.broadcast(heavy), key, "left").withColumn("_deal", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copies, [*key, "_deal"], how).drop("_deal")


def running_before(rows: DataFrame, key: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """A written table of ``rows`` with ``name``, the sum of ``value`` over the rows before in ``order`` within ``key``.

    Rows are cut by ranges of (key, order), so that a key of any size is shared among tasks. The sums
    of earlier parts are kept for keys that go on from one part to the next: at most two rows a part.
    """
    from pyspark.sql import Window

    key = list(key)
    placed = cut(rows.withColumn("_value", value).repartitionByRange(*key, order).sortWithinPartitions(*key, order).withColumn("_part", F.spark_partition_id()))
    one = F.struct(*key)
    ends = placed.groupBy("_part").agg(F.min(one).alias("a"), F.max(one).alias("b"))
    border = ends.select(F.col("b.*")).intersect(ends.select(F.col("a.*")))  # at most a key per part
    sums = placed.join(F.broadcast(border), key, "left_semi").groupBy(*key, "_part").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.broadcast(sums.select(*key, "_part", F.sum("_sum").over(before).alias("_carry")))
    inside = Window.partitionBy("_part", *key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_inside", F.sum("_value").over(inside))
    total = F.coalesce("_inside", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    return cut(local.join(carry, [*key, "_part"], "left").withColumn(name, total).select(*rows.columns, name))
