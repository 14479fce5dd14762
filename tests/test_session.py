"""Session helpers: spread, bounded broadcast, materialize, checkpoint folder, compute-once filter."""

from pyspark.sql import functions as F

from boardsmith.functions.util import with_columns_where
from boardsmith.session import broadcast_if_small, ensure_checkpoint_dir, materialize, scratch_dir, spread


def test_spread_only_when_under_partitioned(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many) is many


def test_broadcast_if_small(spark):
    small = spark.range(5)
    big = spark.range(50)
    plan_small = spark.range(1000).join(broadcast_if_small(small, 10), "id")._jdf.queryExecution().optimizedPlan().toString()
    plan_big = spark.range(1000).join(broadcast_if_small(big, 10), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_small.lower() and "broadcast" not in plan_big.lower()


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    m = materialize(df, "t")
    assert sorted(r.x for r in m.collect()) == [2 * i for i in range(10)]
    assert "FileScan" in m._jdf.queryExecution().executedPlan().toString() or "Scan parquet" in m._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_folder_is_read_not_replaced(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_with_columns_where_computes_once(spark):
    df = spark.createDataFrame([(1, "aaaa"), (2, "a")], "id int, t string")
    out = with_columns_where(df, {"n": F.length("t")}, lambda r: r["n"] > 2)
    assert [(r.id, r.n) for r in out.collect()] == [(1, 4)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("length(") == 1


def test_ship_package_once_per_application(spark):
    import glob
    import os
    import tempfile
    import zipfile

    from boardsmith import session as S

    S._SHIPPED.discard(spark.sparkContext.applicationId)
    S.ship_package(spark)
    S.ship_package(spark)  # second call is a no-op
    zips = [p for p in glob.glob(os.path.join(tempfile.gettempdir(), "boardsmith-pyfiles-*", "boardsmith.zip"))]
    assert zips
    names = zipfile.ZipFile(sorted(zips, key=os.path.getmtime)[-1]).namelist()
    assert "boardsmith/operators/enrich.py" in names and "boardsmith/__init__.py" in names
