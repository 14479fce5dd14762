"""CSV edges (A1, A2, A7): quoted fields with doubled-quote escapes and embedded newlines.

CSV is only the edge format; an explicit schema is always passed on read (no inference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NA = "N/A"
BOM = "\ufeff"

POSTS_CSV_SCHEMA = T.StructType([
    T.StructField("talkNo", T.StringType()),
    T.StructField("Title", T.StringType()),
    T.StructField("Contents", T.StringType()),
    T.StructField("Date", T.StringType()),
    T.StructField("ViewCount", T.StringType()),
    T.StructField("Comments", T.StringType()),
])


def _reader(spark: SparkSession, null_value: str | None):
    r = (
        spark.read.option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE").option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    # Without a mark of its own, a null is an unquoted empty field; a quoted one is an empty text.
    return r.option("nullValue", "\u0000" if null_value is None else null_value)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, null_value: str | None = NA) -> DataFrame:
    """A1/A2: quoted CSV with header; a UTF-8 BOM before the header is dropped by the reader.

    With ``schema`` the columns are typed by position; without it the header names are
    kept and every column is a string.  An empty field reads as null (as a pandas re-read
    of the reference's files gives NaN).
    """
    r = _reader(spark, null_value)
    return r.schema(schema).csv(path) if schema is not None else r.csv(path)


def scan_posts_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: crawled-posts CSV -> posts (ids and counts typed, ``'N/A'`` -> null)."""
    raw = scan_csv(spark, path)  # by header name: another crawl's file is refused, not misread
    missing = [f.name for f in POSTS_CSV_SCHEMA if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(
        F.col("talkNo").try_cast("bigint").alias("post_id"),
        F.col("Title").alias("title"), F.col("Contents").alias("contents"), F.col("Date").alias("date_text"),
        F.regexp_replace("ViewCount", ",", "").try_cast("bigint").alias("views"),
        F.col("Comments").alias("comments"),
    )


# The headers of the other two crawls' files.
LISTING_COLUMNS = ("talkNo", "Title", "Contents", "Date", "ViewCount", "ReplyCount")
DETAIL_COLUMNS = ("talkNo", "title", "content", "content_date", "comments")
COMMENTS_SCHEMA = T.ArrayType(T.StructType([T.StructField("comment_date", T.StringType()), T.StructField("comment_text", T.StringType())]))


def _by_header(spark: SparkSession, path: str, names) -> DataFrame:
    raw = scan_csv(spark, path)
    missing = [n for n in names if n not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw


def _count(name: str):
    return F.regexp_replace(name, ",", "").try_cast("bigint")


def scan_listing_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: the API crawl's CSV -> (post_id, title, contents, date_text, views, reply_count)."""
    raw = _by_header(spark, path, LISTING_COLUMNS)
    return raw.select(
        F.col("talkNo").try_cast("bigint").alias("post_id"), F.col("Title").alias("title"), F.col("Contents").alias("contents"),
        F.col("Date").alias("date_text"), _count("ViewCount").alias("views"), _count("ReplyCount").alias("reply_count"))


def scan_detail_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: the detail crawl's CSV, whose comments are a JSON list -> (post_id, title, contents, date_text, views, comments).

    ``comments`` is an array of (comment_date, comment_text); a list that does not decode is null.
    """
    raw = _by_header(spark, path, DETAIL_COLUMNS)
    return raw.select(
        F.col("talkNo").try_cast("bigint").alias("post_id"), F.col("title"), F.col("content").alias("contents"), F.col("content_date").alias("date_text"),
        F.lit(None).cast("bigint").alias("views"), F.from_json("comments", COMMENTS_SCHEMA).alias("comments"))


def scan_any_posts_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of any of the three crawls, told by its header, with the columns that ``refine`` reads (comments as text)."""
    names = set(scan_csv(spark, path).columns)
    if set(DETAIL_COLUMNS) <= names:
        return scan_detail_csv(spark, path).withColumn("comments", F.to_json("comments"))
    if set(LISTING_COLUMNS) <= names:
        return scan_listing_csv(spark, path).withColumn("comments", F.lit(None).cast("string"))
    return scan_posts_csv(spark, path)


def sink_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "overwrite", null_value: str | None = None) -> None:
    """Header CSV, quotes doubled, no index column; ``bom`` puts ``EF BB BF`` before the
    header of every part file (the first column's header name carries it)."""
    out = df
    if bom and df.columns:
        first = df.columns[0]
        out = df.withColumnRenamed(first, BOM + first)
    w = out.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", '""')
    if null_value is not None:
        w = w.option("nullValue", null_value)
    w.csv(path)
