"""Landed pages (A4), posts extracted from them (B3-B5) and landed API listing pages (A3).  No HTTP: crawling is done elsewhere."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardsmith.functions import html as H
from boardsmith.functions.html import Step, step
from boardsmith.functions.json import whole_object
from boardsmith.functions.text import relative_date

API_ITEM = T.StructType([
    T.StructField("talkNo", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("contents", T.StringType()),
    T.StructField("createdDate", T.StringType()),
    T.StructField("viewCount", T.LongType()),
    T.StructField("replyCount", T.LongType()),
])
API_PAGE = T.StructType([T.StructField("collection", T.ArrayType(API_ITEM))])


def scan_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A4: landed pages.  ``parquet``: (page_id, url, html); ``html``: one file per page,
    read whole (``wholetext``), url = file path."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "html":
        return spark.read.text(path, wholetext=True).select(
            F.input_file_name().alias("url"), F.col("value").alias("html")
        )
    raise ValueError(f"unknown page format {fmt}")


# Where the fields of a detail page lie (class names of the forum's markup).
TITLE = "DetailTitle_detail__header--title__Bbp40"
CONTENTS = "Detail_content__content__hJ5M7"
INFOS = "CommonInfos_info__wrapper__aGcEl"
VIEWS = "experience__span--view"
COMMENTS = "CommentList_comment-contents__YVrtF"
COMMENT_DATE = "comment-list__detail-override"
COMMENT_TEXT = "comment-list__text-override"


@dataclass(frozen=True)
class Layout:
    """Paths to the fields of a detail page; the comment fields are looked for inside each comment."""

    title: Sequence[Step] = (step(None, TITLE),)
    contents: Sequence[Step] = (step(None, CONTENTS),)
    date: Sequence[Step] = (step(None, INFOS), step("div", nth=2))
    views: Sequence[Step] = (step(None, VIEWS),)
    comments: Sequence[Step] = (step(None, COMMENTS), step("ul", child=True), step("li"))
    comment_fields: dict[str, Sequence[Step]] = field(default_factory=lambda: {"comment_date": (step(None, COMMENT_DATE),), "comment_text": (step(None, COMMENT_TEXT),)})


def extract_posts(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id",), layout: Layout | None = None, default: str | None = None) -> DataFrame:
    """Landed detail pages -> (keep..., title, contents, date_text, views_text, comments), a row for each page.

    ``comments`` is an array of structs of texts in page order.  A missing element gives ``default``; a null page has
    null texts and no comments.
    """
    at = layout or Layout()
    pg = F.col("_page")
    text = lambda path: H.text_at(pg, list(path), None, default)
    rows = pages.select(*keep, H.page(F.coalesce(F.col(html_col), F.lit(""))).alias("_page"))
    return rows.select(
        *keep, text(at.title).alias("title"), text(at.contents).alias("contents"), text(at.date).alias("date_text"), text(at.views).alias("views_text"),
        H.html_structs(pg, list(at.comments), {k: list(p) for k, p in at.comment_fields.items()}, default).alias("comments"))


def api_rejects(pages: DataFrame, json_col: str = "response", keep: Sequence[str] = ()) -> DataFrame:
    """A3: (keep..., reject_reason) of the listing pages that give no rows: ``no_response``, ``undecodable``, ``no_collection``."""
    r = F.col(json_col)
    page = whole_object(r, API_PAGE)
    reason = F.when(r.isNull() | (F.trim(r) == ""), "no_response").when(page.isNull(), "undecodable").when(page["collection"].isNull(), "no_collection")
    return pages.select(*keep, reason.alias("reject_reason")).where(F.col("reject_reason").isNotNull())


def _items(df: DataFrame, struct_col: str, asof, keep: list[str]) -> DataFrame:
    it = df.select(*keep, F.explode(f"{struct_col}.collection").alias("it"))
    date = F.col("it.createdDate") if asof is None else relative_date(F.col("it.createdDate"), asof)
    return it.select(
        *keep,
        F.col("it.talkNo").alias("talk_no"),
        F.col("it.title").alias("title"),
        F.col("it.contents").alias("contents"),
        date.alias("date"),
        F.col("it.viewCount").alias("view_count"),
        F.col("it.replyCount").alias("reply_count"),
    )


def api_items(pages: DataFrame, json_col: str = "response", asof=None, keep: list[str] | None = None) -> DataFrame:
    """A3: one row per ``collection[]`` item of a JSON listing page held in a string column;
    missing fields stay null (``'N/A'`` only at the CSV edge); relative dates -> ``asof``.
    Pages that do not decode are told by ``api_rejects``."""
    keep = keep or []
    j = pages.select(*keep, whole_object(json_col, API_PAGE).alias("_p"))
    return _items(j, "_p", asof, keep)


def scan_api_pages(spark: SparkSession, path: str, asof=None, multi_line: bool = True) -> DataFrame:
    """A3 from landed files: one page object per file (``multi_line``) or per line."""
    raw = spark.read.schema(API_PAGE).option("multiLine", multi_line).json(path)
    return _items(raw.select(F.struct("collection").alias("_p")), "_p", asof, [])
