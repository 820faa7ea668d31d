"""Registered queries of the operators for training text: each runs over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outbreaklens.llm import (
    bpe, langid, lexical, lmscore, mixing, prefixtrie, quality, sharding, simhash, substrings, topk, toxicity, warc,
)
from outbreaklens.llm.batches import bound_batches

Query = Callable[[SparkSession, str], DataFrame]
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    left = F.array_join(quality.words("kept_text"), " ").cast("binary")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(left, 256).alias("kept_sha256")
    )


def op2_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(table(spark, folder, "pages"))


def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(table(spark, folder, "documents"), RANK_FILE, public_tokenizers.PATTERN)


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return langid.identify(documents, langid.fit(documents.where(~langid.held_out())))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lmscore.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, folder, "conversations"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(lexical.index(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    run.__name__: run
    for run in (
        op1_substring_dedup,
        op2_warc_round_trip,
        op3_exact_top_k,
        op4_bpe_round_trip,
        op5_source_mixing,
        op6_simhash_near_dedup,
        op7_language_id,
        op8_quality_rules,
        op9_lm_scoring,
        op10_sharding,
        op11_toxicity,
        op12_conversation_trie,
        op13_lexical_search,
    )
}
