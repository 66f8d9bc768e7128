"""A training corpus from ``documents``: toxic texts out, one text per near-duplicate class, benchmark
passages out, sources mixed to their weights, token ids written.

Every stage takes (session, documents, folder of the tables) and works on all rows it is given; its
result is written as Parquet in the shared folder and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskrules.llm import decontaminate, mixing, near_dedup, token_files, toxicity
from riskrules.llm.common import prepared, table
from riskrules.session import cut


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score leaves in; the score learns from their labels."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class, that of the smallest id."""
    prepared(spark)
    return near_dedup.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    prepared(spark)
    return mixing.repeated(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The written and reread ids: a row per document taken, with its place, size and checksum."""
    prepared(spark)
    written = token_files.folder_for(spark)
    token_files.write(docs, written, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read(spark, written)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

# Fitted scores, hashed tables and file checksums are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
