"""Token counts through a digest cache.

The cache is a Parquet table (content digest, tokenizer digest, count), partitioned by the tokenizer's digest, the
SHA-256 of its file.  Texts whose digest is not in the cache are reduced to one copy of each, encoded
and appended; then every document joins its count by digest.  Copies collapse in the map side of the
reduction, so the text that many rows share crosses the network once for each task at most.

Normalisation folds white-space runs only for files that drop white space, where it cannot change a count.

Defined cases: null text counts as empty (0 bytes, 0 tokens); null or repeated ids give one row each; an empty
table gives no rows; other columns are ignored.  Two runs that append the same digest do no harm: equal digests
have equal counts and the join reads each digest once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.llm import tokens
from boardsmith.llm.common import WORD_GAP, prepare

CACHE_SCHEMA = "content_digest binary, n_tokens bigint, tokenizer_digest string"


def _count(path: str):
    def run(batches):
        enc = tokens.encoder(path)
        for b in batches:
            texts = b.column("content").cast(pa.binary())
            counts = [len(enc.ids(t.as_py())) // enc.width for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("content_digest"), pa.array(counts, pa.int64())], ["content_digest", "n_tokens"])

    return run


def read_cache(spark, cache_dir: str, version: str) -> DataFrame:
    """(content_digest, n_tokens) of one tokenizer version, each digest once; empty when nothing has been stored yet."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(cache_dir)
    if not where.getFileSystem(conf).exists(where):
        return spark.createDataFrame([], "content_digest binary, n_tokens bigint")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).where(F.col("tokenizer_digest") == version)
    return stored.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_dir: str, id_col: str = "doc_id", text_col: str = "text",
                 fold_space: bool = True, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; new counts are appended to the cache at ``cache_dir``.

    ``fold_space``: fold white space before the digest; only for files that drop white space.
    """
    spark = docs.sparkSession
    prepare(spark)
    version = tokens.file_digest(tokenizer_path)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    content = F.btrim(F.regexp_replace(text, WORD_GAP, " ")) if fold_space else text
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), content.alias("content"))
    rows = rows.withColumn("content_digest", F.unhex(F.sha2(F.encode("content", "UTF-8"), 256)))
    distinct = rows.select("content_digest", "content").dropDuplicates(["content_digest"])
    misses = distinct.join(read_cache(spark, cache_dir, version), "content_digest", "left_anti")
    counted = misses.mapInArrow(_count(tokenizer_path), "content_digest binary, n_tokens bigint")
    counted.withColumn("tokenizer_digest", F.lit(version)).write.mode("append").partitionBy("tokenizer_digest").parquet(cache_dir)
    counts = read_cache(spark, cache_dir, version)
    return rows.drop("content").join(counts, "content_digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
