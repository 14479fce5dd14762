"""Crawled-post shaping: defaults, required fields, ids and URLs, ordering, unions, joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardsmith.functions.text import py_strip
from boardsmith.functions.util import as_col

# The missing-value marker the crawler writes, and its URL layouts.
NA = "N/A"
DETAIL_URL = "https://forum.example/talk/%d?sortType=CREATED_DATE"
LISTING_URL = "https://forum.example/talk?pageIndex=%d&sortType=CREATED_DATE"


def with_defaults(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """Missing field -> default (``'N/A'``); apply at the output edge only."""
    defaults = defaults or {}
    cols = []
    for c in df.columns:
        if c in defaults:
            cols.append(F.coalesce(F.col(c), F.lit(defaults[c])).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def required(df: DataFrame, title: str = "title", contents: str = "contents", date: str = "date_text") -> DataFrame:
    """Keep rows whose title is present and non-blank, and whose contents/date are not empty.

    A *missing* contents/date node reads as ``'N/A'`` in the reference and is kept; only an
    empty one drops the row.
    """
    t, c, d = as_col(title), as_col(contents), as_col(date)
    return df.where(t.isNotNull() & (py_strip(t) != "") & (F.coalesce(c, F.lit(NA)) != "") & (F.coalesce(d, F.lit(NA)) != ""))


def rejected(df: DataFrame, title: str = "title", contents: str = "contents", date: str = "date_text") -> DataFrame:
    """Rows ``required`` drops, with a reason (the crawler's silent ``continue``)."""
    t, c, d = as_col(title), as_col(contents), as_col(date)
    reason = (
        F.when(t.isNull(), F.lit("no_title"))
        .when(py_strip(t) == "", F.lit("blank_title"))
        .when(F.coalesce(c, F.lit(NA)) == "", F.lit("empty_contents"))
        .when(F.coalesce(d, F.lit(NA)) == "", F.lit("empty_date"))
    )
    return df.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


def to_count(c) -> Column:
    """View/reply count text (``'1,234'``, ``'N/A'``) -> bigint, null when not a number."""
    return F.regexp_replace(py_strip(as_col(c)), ",", "").try_cast("bigint")


def post_id_from_url(c) -> Column:
    """B2: last ``/`` part of the URL, cut at ``?`` and ``#``, as bigint (null if not a number)."""
    return url_tail(c).try_cast("bigint")


def url_tail(c) -> Column:
    tail = F.element_at(F.split(as_col(c), "/"), -1)
    return F.split_part(F.split_part(tail, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))


def with_url(df: DataFrame, id_col: str, template: str = DETAIL_URL, out: str = "url") -> DataFrame:
    """B1: page URL from an id or page number."""
    return df.withColumn(out, F.format_string(template, F.col(id_col)))


def ok_pages(df: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by HTTP status; a non-200 page yields no rows."""
    s = F.col(status)
    return df.where(s == 200), df.where(s.isNull() | (s != 200))


def newest_first(df: DataFrame, id_col: str = "post_id") -> DataFrame:
    """global order by id descending (range-partitioned sort)."""
    return df.orderBy(F.col(id_col).desc())


def head(df: DataFrame, n: int = 10, order_col: str = "post_id") -> DataFrame:
    """first ``n`` rows by ``order_col`` (TakeOrderedAndProject: per-partition top-n, then merge)."""
    return df.orderBy(F.col(order_col).asc()).limit(n)


def union_pages(dfs: list[DataFrame]) -> DataFrame:
    """G1: append listing pages, duplicates kept (bag union)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def posts_with_comments(posts: DataFrame, comments: DataFrame, key: str = "post_id") -> DataFrame:
    """Inner equi-join on the post id (shuffle join; AQE splits a hot post's partition)."""
    return posts.join(comments, key, "inner")


def frontier(spark: SparkSession, start: int, stop: int, step: int = -1) -> DataFrame:
    """Ids (or page numbers) ``start, start+step, …``; ``stop`` is exclusive like Python ``range``."""
    return spark.range(start, stop, step)


def id_bounds(listing: DataFrame, id_col: str = "post_id") -> DataFrame:
    """Newest (max) and oldest (min) id of a listing, plus its row count."""
    return listing.agg(
        F.max(id_col).alias("newest_id"), F.min(id_col).alias("oldest_id"), F.count(id_col).cast("bigint").alias("n_ids")
    )


def crawl_frontier(spark: SparkSession, listing: DataFrame, id_col: str = "post_id", extra: int = 0) -> DataFrame:
    """A6 driven by D6: descending ids from ``newest + extra`` down to (not including) ``oldest``.

    Only the two bounds reach the driver; the id range itself is generated on executors.
    """
    b = id_bounds(listing, id_col).first()
    if b is None or b["newest_id"] is None:
        return spark.range(0).select(F.col("id"))
    return frontier(spark, int(b["newest_id"]) + extra, int(b["oldest_id"]), -1)


def missing_ids(frontier_df: DataFrame, posts: DataFrame, id_col: str = "post_id") -> DataFrame:
    """Ids asked for that produced no post (left anti join)."""
    p = posts.select(F.col(id_col).alias("id"))
    return frontier_df.join(p, "id", "left_anti")


def to_refined(df: DataFrame) -> DataFrame:
    """Crawled posts -> the refined stage's column names and types."""
    return df.select(
        F.col("post_id").alias("id"),
        F.col("contents").alias("content"),
        F.col("title"),
        to_count("views_text").alias("views"),
        F.col("date_text").alias("date"),
    )


COMMENT_CHUNK = 1000


def comments_json(comments: DataFrame, post_col: str = "post_id", pos_col: str = "pos", date_col: str = "comment_date",
                  text_col: str = "comment_text", chunk_size: int = COMMENT_CHUNK) -> DataFrame:
    """H6: a post's comments as JSON arrays of ``{comment_date, comment_text}`` in position
    order, non-ASCII kept.  Every ``chunk_size`` comments of a post are one array, whatever their positions
    (``chunk`` counts from 0; null positions first), so a post with a third of all comments still spreads over bounded
    groups: comments are numbered inside ranges of positions, and a range's offset is a running sum over the
    post's ranges.
    """
    span = F.coalesce(F.floor(F.col(pos_col) / F.lit(chunk_size)).cast("bigint"), F.lit(-(2**63)))
    rows = comments.withColumn("_span", span)
    before = Window.partitionBy(post_col).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(post_col, "_span").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(post_col).alias("_post"), F.col("_span").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(post_col, "_span").orderBy(pos_col, date_col, text_col)
    rows = rows.withColumn("_place", F.row_number().over(inside))
    rows = rows.join(offsets, F.col(post_col).eqNullSafe(F.col("_post")) & (F.col("_span") == F.col("_at")))
    chunk = F.floor((F.col("_off") + F.col("_place") - 1) / F.lit(chunk_size)).cast("bigint")
    item = F.struct(F.col(pos_col).alias("p"), F.col(date_col).alias("comment_date"), F.col(text_col).alias("comment_text"))
    arr = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["comment_date"].alias("comment_date"), x["comment_text"].alias("comment_text")))
    return rows.groupBy(F.col(post_col).alias(post_col), chunk.alias("chunk")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_comments"), F.to_json(arr).alias("comments_json")
    )
