"""The corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and returns a DataFrame;
all but the last return the columns of ``documents``.  ``run`` writes each stage as Parquet in the shared
checkpoint folder and reads it again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from boardsmith.llm import near_dedup, packing, quality, secret_scan, suffix_dedup
from boardsmith.llm.common import prepare, read_table
from boardsmith.session import materialize

REPEATED_BYTES = 200  # shorter than any passage of fifty words
TOKENIZER = "word_bpe_49k.json"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that fail a quality rule."""
    return quality.keep_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates, the smallest id (five-word shingles, similarity of 0.8 or more)."""
    # A copy without an id goes too: beside the kept row, the next stage would cut the text out of both.
    return near_dedup.keep_one_of_each(docs, width=5, similarity=(4, 5), keep_unnamed=False)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that occur elsewhere too out of the texts."""
    return suffix_dedup.remove_repeats(docs, REPEATED_BYTES)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by their kinds."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences: one row per piece."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # tokenization and suffix sorting are beyond SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
