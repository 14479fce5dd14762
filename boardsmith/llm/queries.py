"""One registered query for each operator, over its whole table, and the DuckDB text where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardsmith.llm import chat, hard_negatives, lexical, mixing, near_dedup, neighbours, packing, piece_encoding, quality, secret_scan, suffix_dedup, token_counts, twins, url_filter
from boardsmith.llm.common import prepare, read_table
from boardsmith.session import scratch_dir


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, similarity=(85, 100))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.encode_pieces(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


# The conversation that the query adds.
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    return chat.digests(chat.read_back(chat.format_conversations(turns.unionByName(extra))))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(read_table(spark, sf_dir, "documents"), least=400)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(read_table(spark, sf_dir, "documents"), by_language=False)  # as its DuckDB text says
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    cache = scratch_dir(spark, "token-cache")  # each call starts an empty cache, so that no run lives on an earlier one
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(rows.withColumn("label", hard_negatives.relabelled(F.col("label"), F.col("vec_id"))))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


_QUERIES = (op1_neighbours, op2_near_dedup, op3_packing, op4_pieces, op5_secrets, op6_chat, op7_urls, op8_suffix_dedup, op9_quality, op10_token_counts, op11_lexical, op12_hard_negatives, op13_mixing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(twins.SQL)
