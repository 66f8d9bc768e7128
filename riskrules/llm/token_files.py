"""Token ids in binary blocks: every document compressed by itself with one shared zstandard dictionary.

Layout of a written folder, both parts plain tables so that any store Spark can write to will do and a
task that is run again replaces its own output:

- ``dictionary``: one row (hash, dictionary). The dictionary is trained on the serialized ids of a
  bounded sample of documents; its SHA-256 is kept in every block.
- ``blocks``: (part, seq, first_id, last_id, n_docs, n_ids, block), documents in ascending id order.

A block is little-endian: magic ``TIDB``, version, bytes per id, number of documents, dictionary hash;
per document its id, whether the id is null, its number of ids, and the offset table; then one
zstandard frame per document. One document is read by its offset, without the others.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrules.llm.common import keyed_texts, part_starts, per_text
from riskrules.llm.subwords import encoder
from riskrules.session import shared_folder

MAGIC, VERSION = b"TIDB", 1
END_ID = 1
BLOCK_BYTES = 1 << 20  # compressed bytes after which a block is closed
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 1_000  # documents the dictionary is trained on, the first by hash of their ids
SAMPLE_PIECE = 32 << 10  # bytes of serialized ids that one sample document may add
_HEAD = struct.Struct("<4sHHQ32s")


def trained(samples: list[bytes]) -> bytes:
    """A dictionary from serialized ids; with too few samples to train on, their raw content, if any."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def pack(kind: str, used: bytes, docs: list[tuple[int | None, int, bytes]]) -> bytes:
    """A block of (id, number of ids, frame)."""
    n = len(docs)
    offsets = np.concatenate(([0], np.cumsum([len(f) for _, _, f in docs]))).astype("<u8")
    return b"".join(
        [
            _HEAD.pack(MAGIC, VERSION, np.dtype(kind).itemsize, n, used),
            np.array([d or 0 for d, _, _ in docs], "<i8").tobytes(),
            np.array([d is None for d, _, _ in docs], "u1").tobytes(),
            np.array([m for _, m, _ in docs], "<u8").tobytes(),
            offsets.tobytes(),
            *[f for _, _, f in docs],
        ]
    )


class Block:
    """The documents of a block, each read on its own."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, version, width, self.n, used = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of token ids")
        if used != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        at = _HEAD.size
        self.ids = np.frombuffer(data, "<i8", self.n, at)
        self.null = np.frombuffer(data, "u1", self.n, at + 8 * self.n)
        self.sizes = np.frombuffer(data, "<u8", self.n, at + 9 * self.n)
        self.offsets = np.frombuffer(data, "<u8", self.n + 1, at + 17 * self.n)
        self.begin, self.data, self.kind = at + 25 * self.n + 8, data, f"<u{width}"
        self.reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def tokens(self, k: int) -> np.ndarray:
        a, b = self.begin + int(self.offsets[k]), self.begin + int(self.offsets[k + 1])
        return np.frombuffer(self.reader.decompress(self.data[a:b]), self.kind)


def _sample(texts: DataFrame, path: str) -> list[bytes]:
    """Serialized ids of the sample's documents, at most 32 MB in all."""
    chosen = texts.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(SAMPLE_DOCS)
    chosen = texts.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")  # at most SAMPLE_DOCS numbers

    def work(batches):
        for _, bodies in batches:
            yield {"ids": [encoder(path).encode(t)[:SAMPLE_PIECE] for t in bodies]}

    rows = per_text(chosen, work, "ids binary").orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE_DOCS)
    return [bytes(r.ids) for r in rows.collect()]


def write(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text and write the blocks in ascending id order.

    A null text counts as empty: only the end id. Null ids come first; rows that share an id follow one
    another in the order of a hash of their text, then of the text.
    """
    texts = keyed_texts(docs, key, text)
    dictionary = trained(_sample(texts, path))
    used = hashlib.sha256(dictionary).digest()
    spark = docs.sparkSession
    spark.createDataFrame([(used, dictionary)], "hash binary, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def work(batches) -> Iterator[dict]:
        subwords, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        if end_id >= 1 << 16 and subwords.kind == "<u2":
            raise ValueError("the end id does not fit the file's width")
        end = np.array([end_id], subwords.kind).tobytes()
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        width = np.dtype(subwords.kind).itemsize
        waiting: list[tuple[int | None, int, bytes]] = []

        def out():
            nonlocal seq, waiting
            row = {
                "part": [part],
                "seq": [seq],
                "first_id": [waiting[0][0]],
                "last_id": [waiting[-1][0]],
                "n_docs": [len(waiting)],
                "n_ids": [sum(m for _, m, _ in waiting)],
                "block": [pack(subwords.kind, used, waiting)],
            }
            seq, waiting = seq + 1, []
            return row

        size = 0
        for ids, bodies in batches:
            for d, t in zip(ids, bodies):
                e = subwords.encode(t) + end
                waiting.append((d, len(e) // width, writer.compress(e)))
                size += len(waiting[-1][2])
                if size >= BLOCK_BYTES:
                    yield out()
                    size = 0
        if waiting:
            yield out()

    ordered = texts.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    blocks = per_text(ordered.select("doc_id", "text"), work, "part int, seq int, first_id long, last_id long, n_docs long, n_ids long, block binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def dictionary_of(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.parquet(f"{folder}/dictionary").first().dictionary)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, n_bytes) of every document, from the written blocks.

    ``start`` counts the ids of all documents before it, ``n_bytes`` is the size of its frame and the
    checksum is that of the ids as unsigned 32-bit integers.
    """
    dictionary = dictionary_of(spark, folder)
    written = spark.read.parquet(f"{folder}/blocks")

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            for part, seq, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                block = Block(data, dictionary)
                before = np.concatenate(([0], np.cumsum(block.sizes)[:-1])).astype(np.int64)
                sums = np.array([zlib.crc32(block.tokens(k).astype("<u4").tobytes()) for k in range(block.n)], np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(block.ids, mask=block.null.astype(bool)),
                        "part": pa.array(np.full(block.n, part, np.int32)),
                        "seq": pa.array(np.full(block.n, seq, np.int32)),
                        "before": before,
                        "n_tokens": block.sizes.astype(np.int64),
                        "ids_crc32": sums,
                        "n_bytes": np.diff(block.offsets.astype(np.int64)),
                    }
                )

    rows = written.select("part", "seq", "block").mapInArrow(
        work, "doc_id long, part int, seq int, before long, n_tokens long, ids_crc32 long, n_bytes long"
    )
    from pyspark.sql import Window

    sizes = written.select("part", "seq", "n_ids")
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("inside", inside).join(part_starts(sizes, "part", "n_ids"), "part")
    starts = starts.select("part", "seq", (F.col("start") + F.col("inside")).alias("base"))
    start = (F.col("base") + F.col("before")).alias("start")
    return rows.join(starts, ["part", "seq"]).select("doc_id", start, "n_tokens", "ids_crc32", "n_bytes")


def one(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents of one id, decompressing nothing else."""
    dictionary, out = dictionary_of(spark, folder), []
    rows = spark.read.parquet(f"{folder}/blocks").filter((F.col("last_id") >= doc_id) & (F.coalesce("first_id", F.lit(doc_id)) <= doc_id))
    for row in rows.orderBy("part", "seq").toLocalIterator():
        block = Block(bytes(row.block), dictionary)
        out += [block.tokens(int(k)).tolist() for k in np.flatnonzero((block.ids == doc_id) & (block.null == 0))]
    return out


def folder_for(spark: SparkSession) -> str:
    """A new folder for written ids in the cluster's shared folder."""
    import uuid

    return f"{shared_folder(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
