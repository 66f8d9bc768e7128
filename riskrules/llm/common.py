"""What the text operators share: rows for Python workers, word hashes, running totals, components.

Workers see texts as UTF-8 bytes. ``bytes.lower`` changes A-Z only and ``bytes.split`` splits on the
ASCII blanks x09-x0D and x20 only, which is the definition of a word in several contracts.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrules.session import configure, cut

# Rows and bytes per Arrow batch: with texts of megabytes a batch of Spark's default 10,000 rows is too large.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
# Entries a worker remembers of a word function, twice: those of late and those before them.
REMEMBERED = 200_000


def _ship(spark: SparkSession) -> None:
    """Hand the library's sources to the Python workers, once per application: they need not have it."""
    context, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(context, "_riskrules_shipped", False):
        return
    made = os.path.join(tempfile.mkdtemp(prefix="riskrules-"), "riskrules.zip")  # only the driver reads it, to serve it
    with zipfile.ZipFile(made, "w") as out:
        for base, _, files in sorted(os.walk(root)):
            for name in sorted(f for f in files if f.endswith(".py")):
                out.write(os.path.join(base, name), os.path.join("riskrules", os.path.relpath(os.path.join(base, name), root)))
    context.addPyFile(made)
    context._riskrules_shipped = True


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the run-time settings of the library, small Arrow batches, and Bloom filters in
    front of shuffles at any size: documents are often joined with a part of their ids."""
    configure(spark)
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1g")
    return spark


def chosen_rows(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose id is among ``ids`` (a written table of one column).

    The comparison on the ids is always true; the optimizer builds a Bloom filter only from a side that
    it takes for selective. Rows that the filter rules out are not shuffled.
    """
    return rows.join(ids.filter(F.col(key) >= F.lit(-(2**63))), key, "left_semi")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key long, text binary): only these columns travel, so others may have any name."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))


def per_text(df: DataFrame, work: Callable[[Iterator[tuple[list, list]]], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``work`` over (ids, texts) batches of ``keyed_texts``; a null text arrives as b"".

    ``work`` yields a dict of columns per batch, of any length.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for b in batches:
                yield b.column(0).to_pylist(), [t or b"" for t in b.column(1).to_pylist()]

        for columns in work(pairs()):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, arrow.field(n).type) for n, c in ((f.name, columns[f.name]) for f in arrow)], schema=arrow
            )

    return df.mapInArrow(run, schema)


class Remembered(dict):
    """A function of a word, remembered for the words met lately."""

    def __init__(self, function: Callable, size: int = REMEMBERED):
        super().__init__()
        self.function, self.size, self.before = function, size, {}

    def __missing__(self, word):
        value = self.before[word] if word in self.before else self.function(word)
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[word] = value
        return value


def word_hashes() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest, 100_000)


_ODD = np.uint64(0x9E3779B97F4A7C15)  # an odd 64-bit multiplier (golden ratio)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` word hashes; a shorter text is one window."""
    n = len(words)
    size = min(width, n)
    if n == 0:
        return words
    total = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        total = total * _ODD + words[j : n - size + 1 + j]
    return mixed(total + np.uint64(size))


def doc_crc(key: str = "doc_id"):
    """crc32 of the id as text (a null id as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def part_starts(parts: DataFrame, order: str, value: str) -> DataFrame:
    """(order, start): the sum of ``value`` over smaller ``order``. One row per part of a written table:
    as many rows as that write had tasks, so one window is enough at any size."""
    from pyspark.sql import Window

    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.groupBy(order).agg(F.sum(value).alias("_sum")).select(order, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("start"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the links (a, b).

    Contraction: every node moves to the neighbour (or itself) of smallest hash, links are renamed and
    those inside a node drop out; by the random order a constant share of nodes goes per round. All
    steps are grouped minima and joins on tables in the shared folder.
    """
    edges = cut(edges.select("a", "b").filter("a != b").distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = cut(nodes.select("node", F.col("node").alias("label")))
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        rank = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n"))
        near = both.groupBy("a").agg(F.min(rank).alias("m"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("n"))
        moved = cut(near.select(F.col("a").alias("old"), F.least(F.col("m"), own)["n"].alias("new")))
        first = moved.select(F.col("old").alias("a"), F.col("new").alias("a2"))
        second = moved.select(F.col("old").alias("b"), F.col("new").alias("b2"))
        edges = edges.join(first, "a").join(second, "b").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        edges = cut(edges.filter("a != b").distinct())
        labels = cut(labels.join(moved.withColumnRenamed("old", "label"), "label", "left").select("node", F.coalesce("new", "label").alias("label")))
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return cut(labels.join(smallest, "label").select("node", "component"))


def kept_rows(docs: DataFrame, text: str, keep: Callable[[Iterator[list[bytes]]], Iterator[list[bool]]]) -> DataFrame:
    """The rows of ``docs`` that ``keep`` is true for, with all columns as they are."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def texts():
            for b in batches:
                held.append(b)
                yield [t or b"" for t in b.column(place).cast(pa.binary()).to_pylist()]

        for mask in keep(texts()):
            yield held.pop(0).filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
