"""Registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import (
    conversation_repair, decontaminate, language_id, line_quality, line_runs, near_duplicates, packing, posting_lists, prefix_trie, sharding, token_counts, toxicity,
    warc)
from quillon.session import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
BYTE_BPE = "byte_bpe_50k.json"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    cache = token_counts.TokenCache(spark, scratch.path("token_counts"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), cache, scratch)


@query()
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    shuffled = sharding.shuffle_into_shards(rows, 24, Scratch(spark), seed=20)
    return shuffled.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), Scratch(spark))


@query()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").alias("n_items"), "items", "distances")


@query()
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"), Scratch(spark))


@query(line_quality.SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.judge(table(spark, sf_dir, "documents"), Scratch(spark))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")
    return judged.select("doc_id", *[F.col(f"__q_{n}").alias(n) for n in names])


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query(near_duplicates.SQL)
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))


@query(line_runs.SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_runs.remove_repeated_runs(table(spark, sf_dir, "documents"), Scratch(spark))
    return done.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.size("__removed").cast("bigint").alias("n_removed"),
        F.array_join(F.col("__removed").cast("array<string>"), ",").alias("removed_lines"), F.col("__text").alias("text"))


@query()
def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), Scratch(spark))


@query(prefix_trie.SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), Scratch(spark))


@query(conversation_repair.SQL)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(table(spark, sf_dir, "conversations"), Scratch(spark))
