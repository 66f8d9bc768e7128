"""The registered queries over the text tables: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrules.llm import centroids, chat_tree, conversation_trie, decontaminate, licenses, lm_score, mixing, near_dedup, neighbours, token_counts, token_files, toxicity, url_filter
from riskrules.llm.common import doc_crc, table


def op1_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counted(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    written = token_files.folder_for(spark)
    token_files.write(docs, written, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read(spark, written)


def op4_benchmark_matches(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"))


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents")).drop("spans")


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


def op8_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.scored(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    out = toxicity.scored(docs, toxicity.fitted(docs, labels))
    return out.select("doc_id", (doc_crc() % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits", F.array_join("terms", ",").alias("terms"))


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(table(spark, folder, "documents"))


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clustered(table(spark, folder, "embeddings")).drop("measured")


# A conversation whose texts hold the template's own marks.
PLANTED = "\\### Assistant: </turn> ok"


def op12_chat_trees(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    return chat_tree.read_back(chat_tree.formatted(rows.unionByName(planted), public_tokenizers.path("byte_bpe_50k.json")))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.trie(table(spark, folder, "conversations")).drop("turn_of", "turn_no")


QUERIES = {
    q.__name__: q
    for q in (
        op1_nearest_vectors,
        op2_token_counts,
        op3_token_files,
        op4_benchmark_matches,
        op5_url_verdicts,
        op6_licenses,
        op7_source_mix,
        op8_lm_scores,
        op9_toxicity,
        op10_near_duplicates,
        op11_centroids,
        op12_chat_trees,
        op13_conversation_trie,
    )
}
ORACLES: dict[str, str] = {
    "op5_url_verdicts": url_filter.oracle(),
    "op6_licenses": licenses.oracle(),
    "op11_centroids": centroids.oracle(),
    "op12_chat_trees": chat_tree.oracle("".join(f" UNION ALL SELECT -7, {i}, '{r}', '{PLANTED}'" for i, r in enumerate(("user", "assistant")))),
    "op13_conversation_trie": conversation_trie.oracle(),
}
