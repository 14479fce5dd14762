"""Spark session defaults and small session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, app: str = "boardsmith", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder is set by the deployment and is only read here.  Only when
    it is unset under a local master (tests) a private scratch folder is created and used;
    on any other master a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if fallback is None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = fallback or tempfile.mkdtemp(prefix="boardsmith-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread an under-partitioned scan over the cluster's cores.

    A few large files (or one row group) give fewer scan tasks than cores, and every
    row-local text step after the scan would run on that handful of tasks.  Only in that
    case the rows are hash-partitioned on ``key`` (the first column by default;
    deterministic, so a retried task sees the same rows).  A scan that is already split
    at least ``defaultParallelism`` ways - the normal case on a large table - is returned
    untouched, so no shuffle is added at scale.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave the scan as it is
        return df
    return df.repartition(target, df[key or df.columns[0]])


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = True) -> DataFrame:
    """One driver table, e.g. ``table(spark, '/root/testdata/sf0.01', 'documents')``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One computation (``Dataset.checkpoint`` would compute an unpersisted plan twice: once for
    its action, once to write), and a lost executor re-reads files instead of recomputing
    the upstream plan.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows (checked with a bounded
    ``limit(max_rows + 1).count()``); otherwise leave the join strategy to AQE's runtime
    size check, which falls back to a shuffle join with skew splitting."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``boardsmith`` importable on executors (Python workers import operator code by
    reference): zip the package once per application and register it with ``addPyFile``."""
    import zipfile

    import boardsmith

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(boardsmith.__file__))
    folder = tempfile.mkdtemp(prefix="boardsmith-pyfiles-")  # on the driver, which serves it to the executors
    zpath = os.path.join(folder, "boardsmith.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
