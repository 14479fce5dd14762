"""Incremental ingest of landed listing pages, one row per post id.

File source -> event time cast to ``timestamp`` (a watermark needs it) -> watermark ->
``dropDuplicatesWithinWatermark(post_id)``.  State is bounded by the watermark delay: a
post that reappears later than ``delay`` after its first sighting is kept again (Spark evicts the
state at the end of a micro-batch, with the watermark of the previous one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest_posts(stream: DataFrame, id_col: str, ts_col: str, delay: str) -> DataFrame:
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withColumnRenamed(id_col, "post_id")
    return s.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(["post_id"])


def read_landed(spark: SparkSession, folder: str, schema: T.StructType | str, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format("parquet").schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def run_to_table(df: DataFrame, out_path: str, checkpoint: str) -> None:
    """Drain everything available into a Parquet folder (``availableNow``), exactly once."""
    q = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", out_path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
