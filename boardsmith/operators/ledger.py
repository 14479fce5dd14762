"""U3 with a ledger: calls to the hook are stored by the digest of their prompt and never made twice.

A ledger is a Parquet folder of (digest, response, error), one row for each call that was made.  A run takes the distinct prompts that
have no stored response and asks for them in waves: a wave's calls are written before the next one starts, so what is stored survives
a killed task or job, and a second run calls nothing that succeeded.  Failed prompts are asked again, at most ``attempts`` times in a run.
Inside a task at most ``calls`` calls are under way at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardsmith.functions.util import pieces
from boardsmith.session import materialize

LEDGER = "digest string, response string, error string"


def prompt_digest(prompt: Column, version: str = "") -> Column:
    """The key of a call: the prompt and the version of the hook behind it."""
    return F.sha2(F.concat_ws("\x1f", F.lit(version), prompt), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The calls made so far; empty where there is no ledger yet."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def replies(ledger: DataFrame) -> DataFrame:
    """(digest, response, error, n_calls): a stored response where there is one, else the last error told first in text order."""
    return ledger.groupBy("digest").agg(
        F.min("response").alias("response"), F.when(F.count("response") == 0, F.min("error")).alias("error"), F.count(F.lit(1)).alias("n_calls"))


def _called(fn: Callable[[int, str], str], calls: int):
    def ask(batch_id, prompt):
        try:
            reply = fn(batch_id, prompt)
            if not isinstance(reply, str):
                raise TypeError(f"the hook returned {type(reply).__name__}, not text")
            return reply, None
        except Exception as e:  # noqa: BLE001 - the hook isolates any failure
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(calls) as pool:
            for b in (p for whole in batches for p in pieces(whole, 1_000_000)):
                told = list(pool.map(ask, b.column("batch_id").to_pylist(), b.column("prompt").to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column("digest"), *(pa.array(t, pa.string()) for t in ([r for r, _ in told], [e for _, e in told]))], names=["digest", "response", "error"])

    return run


def enrich_with_ledger(prompts: DataFrame, fn: Callable[[int, str], str], path: str, attempts: int = 3, calls: int = 4, wave_rows: int = 100_000,
                       version: str = "", batch_col: str = "batch_id", prompt_col: str = "prompt") -> DataFrame:
    """(batch_id, response, error, n_calls) for every prompt, through the ledger at ``path``.

    Equal prompts are one call.  A prompt without a response after ``attempts`` calls of this run keeps its error: a reject.
    """
    spark = prompts.sparkSession
    keyed = materialize(prompts.select(F.col(batch_col).alias("batch_id"), F.col(prompt_col).alias("prompt"), prompt_digest(F.col(prompt_col), version).alias("digest")), "prompts")
    for _ in range(attempts):
        answered = read_ledger(spark, path).where("response IS NOT NULL").select("digest").distinct()
        todo = materialize(keyed.join(answered, "digest", "left_anti").groupBy("digest").agg(F.min("batch_id").alias("batch_id"), F.first("prompt").alias("prompt")), "calls")
        n = todo.count()
        if not n:
            break
        waves = -(-n // wave_rows)
        for wave in range(waves):
            part = todo.where(F.pmod(F.xxhash64("digest"), F.lit(waves)) == wave)
            part.mapInArrow(_called(fn, calls), LEDGER).write.mode("append").parquet(path)
    return keyed.join(replies(read_ledger(spark, path)), "digest", "left").select("batch_id", "response", "error", F.coalesce("n_calls", F.lit(0)).alias("n_calls"))
