"""Category store (A5, A8, A9): ``{"categories": [{name, description, related_keywords[]}]}``.

A store is one document, or one document a line; a line's categories carry their ``ord``, so a category whose keywords fill
several rows spreads over lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardsmith.operators.ranking import with_rank

CATEGORY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("related_keywords", T.ArrayType(T.StringType())),
    T.StructField("ord", T.IntegerType()),
    T.StructField("chunk_no", T.LongType()),
])
STORE = T.StructType([T.StructField("categories", T.ArrayType(CATEGORY))])


LINE_ROWS = 50  # rows of the store in one document


def scan_categories(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A5: (ord, chunk_no, name, description, related_keywords) of a store: one document, or one a line.

    A document without ``ord`` numbers its categories by their 1-based position.
    """
    store = spark.read.schema(STORE).option("multiLine", not lines).json(path)
    return store.select(F.posexplode("categories").alias("pos", "c")).select(
        F.coalesce("c.ord", F.col("pos") + 1).cast("int").alias("ord"), F.coalesce("c.chunk_no", F.lit(0)).cast("bigint").alias("chunk_no"),
        "c.name", "c.description", "c.related_keywords"
    )


def sink_categories_json(categories: DataFrame, path: str) -> None:
    """The store in the order of its categories, in documents of at most ``LINE_ROWS`` rows, one a line, non-ASCII kept.

    A small store is one document, as the reference writes it.
    """
    categories = categories if "chunk_no" in categories.columns else categories.withColumn("chunk_no", F.lit(0).cast("bigint"))
    row = F.struct("name", "description", "related_keywords", "ord", "chunk_no")
    placed = with_rank(categories, ["ord", "chunk_no"], "_place")
    docs = placed.groupBy(F.floor(F.col("_place") / LINE_ROWS).alias("_doc")).agg(
        F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("_place", row.alias("c")))), lambda x: x["c"]).alias("categories"))).alias("value"))
    docs.orderBy("_doc").select("value").write.mode("overwrite").text(path)


def categories_flat(categories: DataFrame) -> DataFrame:
    """The store as a flat table, keyword list as JSON text."""
    return categories.withColumn("related_keywords", F.to_json("related_keywords"))
