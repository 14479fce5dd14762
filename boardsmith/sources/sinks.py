"""A10: replay-safe incremental sink keyed by batch.

The reference rewrites its whole output file after every batch (O(n^2) bytes).  Here a write is a folder of its own (``run``), with
folders of ``span`` batches in it (``batch_range``), so the number of files follows the writes and the data, not the batches.
A run is written in a hidden folder and appears by one rename; then the folders of earlier runs that hold batches of this one are removed,
after their other batches were written into the new run.  So a write replaces exactly the batches it
carries, and re-running a batch (or replaying a stream epoch) replaces it instead of duplicating it.  A write that
was cut off loses nothing: what it left behind twice is settled by the next write, where the latest run of a batch holds.  One writer at a time.
A batch job that has all batches at hand may write folders of many batches (``replace_batches``), a stream one folder an
epoch (``append_epoch``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASHED = 64  # folders of a run whose batches are not numbered


def _range_of(df: DataFrame, batch_col: str, span: int) -> Column:
    batch = F.col(f"`{batch_col}`")
    numbered = isinstance(df.schema[batch_col].dataType, T.NumericType)
    return (F.floor(batch / F.lit(span)) if numbered else F.pmod(F.xxhash64(batch), F.lit(HASHED))).cast("bigint")


def _runs(spark: SparkSession, path: str):
    """(file system, maker of paths, numbers of the runs that are there)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f.getPath().getName() for f in fs.listStatus(hadoop(path))] if fs.exists(hadoop(path)) else []
    return fs, hadoop, [int(n[4:]) for n in found if n.startswith("run=")]


def append_batches(df: DataFrame, path: str, batch_col: str = "batch_id", fmt: str = "parquet", span: int = 10_000) -> None:
    spark = df.sparkSession
    fs, hadoop, runs = _runs(spark, path)
    staged, number = f"{path}/_staged/{uuid.uuid4().hex}", max(runs, default=-1) + 1
    df.withColumn("batch_range", _range_of(df, batch_col, span)).write.partitionBy("batch_range").format(fmt).save(staged)
    old = []
    if runs:
        parts = T.StructType([*df.schema.fields, T.StructField("batch_range", T.LongType())])
        batch = F.col(f"`{batch_col}`")
        new = spark.read.schema(parts).format(fmt).load(staged).select(batch.alias("_batch")).distinct().withColumn("_new", F.lit(True))
        live = spark.read.schema(T.StructType([*parts.fields, T.StructField("run", T.LongType())])).format(fmt).load(path)
        held = live.select(batch.alias("_batch"), "batch_range", "run").distinct()
        latest = held.groupBy("_batch").agg(F.max("run").alias("_latest"))
        told = held.alias("h").join(latest.alias("l"), F.col("h._batch").eqNullSafe(F.col("l._batch"))).join(new.alias("n"), F.col("h._batch").eqNullSafe(F.col("n._batch")), "left")
        stays = F.col("n._new").isNull() & (F.col("h.run") == F.col("l._latest"))
        old = told.groupBy("h.run", "h.batch_range").agg(F.count_if(~stays).alias("gone"), F.count_if(stays).alias("left")).where("gone > 0").collect()  # one row for each folder that changes
        if any(r["left"] for r in old):
            folders = spark.createDataFrame([(r["run"], r["batch_range"]) for r in old if r["left"]], "_run bigint, _range bigint")
            rest = live.join(F.broadcast(folders), (F.col("run") == F.col("_run")) & F.col("batch_range").eqNullSafe(F.col("_range")), "left_semi")
            rest = rest.join(latest, batch.eqNullSafe(F.col("_batch"))).where("run = _latest").drop("_batch", "_latest")
            rest = rest.join(new, batch.eqNullSafe(F.col("_batch")), "left_anti").select(*[F.col(f"`{c}`") for c in df.columns], "batch_range")
            rest.write.mode("append").partitionBy("batch_range").format(fmt).save(staged)
    if not fs.rename(hadoop(staged), hadoop(f"{path}/run={number}")):
        raise OSError(f"{staged} could not be renamed to {path}/run={number}")
    for r in old:
        name = "__HIVE_DEFAULT_PARTITION__" if r["batch_range"] is None else r["batch_range"]
        fs.delete(hadoop(f"{path}/run={r['run']}/batch_range={name}"), True)


def append_epoch(df: DataFrame, path: str, epoch: int, fmt: str = "parquet") -> None:
    """A stream's epoch as one folder: a replayed epoch replaces its own rows and no others."""
    own = df.withColumn("epoch", F.lit(epoch).cast("bigint"))
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").format(fmt).save(path)


def replace_batches(df: DataFrame, path: str, batch_col: str = "batch_id", span: int = 1000, fmt: str = "parquet") -> None:
    """A whole run: folders of ``span`` batches (``batch_range``); batches of an earlier run that this one lacks are removed."""
    ranged = df.withColumn("batch_range", F.floor(F.col(batch_col) / F.lit(span)).cast("bigint"))
    ranged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch_range").format(fmt).save(path)
