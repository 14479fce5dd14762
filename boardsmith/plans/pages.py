"""A4, B3-B6 on ``pages``; A3 on API listing pages assembled from ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardsmith.functions import html as H
from boardsmith.plans import register
from boardsmith.plans.fixtures import BASE_TS, RELATIVE_DATE_SOURCE
from boardsmith.session import spread, table
from boardsmith.sources.pages import api_items, api_rejects, extract_posts, scan_pages

ASOF = "2025-02-02"
PAGE_ROWS = 20


# The twins cut the pages with plain string functions, written for the markup of this table.
def _sql_texts(x: str) -> str:
    nodes = f"string_split_regex(regexp_replace({x}, '</?[a-z][^<>]*$', ''), '</?[a-z][^<>]*>')"
    plain = "replace(replace(replace(replace(replace(n, '&quot;', chr(34)), '&copy;', chr(169)), '&middot;', chr(183)), '&nbsp;', chr(160)), '&amp;', '&')"
    return f"array_to_string(list_transform({nodes}, lambda n: trim({plain}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '')"


def _sql_between(start: str, end: str, x: str = "html") -> str:
    return f"CASE WHEN contains({x}, '{start}') THEN {_sql_texts(f'split_part(split_part({x}, {chr(39)}{start}{chr(39)}, 2), {chr(39)}{end}{chr(39)}, 1)')} ELSE 'N/A' END"


def parsed(spark, sf_dir):
    return spread(scan_pages(spark, f"{sf_dir}/pages.parquet")).select("page_id", H.page("html").alias("pg"))


@register("scan_pages", oracle="SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def scan_pages_q(spark, sf_dir):
    """A4: landed pages (whole HTML per row)."""
    p = scan_pages(spark, f"{sf_dir}/pages.parquet")
    return p.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@register("html_fields", oracle=f"""
SELECT page_id, {_sql_between('<title>', '</title>')} AS title, {_sql_between('<h1>', '</h1>')} AS h1, {_sql_between('<div class="ad">', '</div>')} AS ad,
       {_sql_between('<footer>', '</footer>')} AS footer, CAST(length({_sql_between('<article>', '</article>')}) AS BIGINT) AS article_chars
FROM pages
""")
def html_fields_q(spark, sf_dir):
    """Title, headline, ad box, footer and article text length of every page; 'N/A' when absent."""
    t = lambda tag, cls=None: H.text_at(F.col("pg"), tag, cls)
    return parsed(spark, sf_dir).select(
        "page_id", t("title").alias("title"), t("h1").alias("h1"), t(None, "ad").alias("ad"),
        t("footer").alias("footer"), F.length(t("article")).cast("bigint").alias("article_chars"),
    )


_ITEMS_SQL = "string_split(split_part(split_part(html, '<ul>', 2), '</ul>', 1), '<li>')[2:]"


@register("html_items", oracle=f"""
SELECT page_id, CAST(len(items) AS BIGINT) AS n_items, array_to_string(list_transform(items, lambda i: {_sql_texts('i')}), '; ') AS items
FROM (SELECT page_id, {_ITEMS_SQL} AS items FROM pages)
""")
def html_items_q(spark, sf_dir):
    """The navigation list (``nav ul li``) of every page as an array."""
    p = spread(scan_pages(spark, f"{sf_dir}/pages.parquet"))
    c = p.select("page_id", H.html_items("html", [H.step("nav"), H.step("ul", child=True)]).alias("items"))
    return c.select("page_id", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", "; ").alias("items"))


@register("html_rows", oracle=f"""
SELECT page_id, CAST(pos AS BIGINT) - 1 AS pos, {_sql_texts('i')} AS item, CASE WHEN contains(i, '<a ') THEN {_sql_texts('i')} ELSE 'N/A' END AS link
FROM (SELECT page_id, unnest(range(1, len(items) + 1)) AS pos, unnest(items) AS i FROM (SELECT page_id, {_ITEMS_SQL} AS items FROM pages))
""")
def html_rows_q(spark, sf_dir):
    """One row per navigation list item of every page, with the link text found inside the item."""
    p = spread(scan_pages(spark, f"{sf_dir}/pages.parquet"))
    rows = H.html_rows(p, "html", "ul", "li", fields={"link": ("a", None)}, keep=["page_id"])
    return rows.select("page_id", "pos", F.col("text").alias("item"), "link")


@register("html_count", oracle="""
SELECT page_id, CAST((length(html) - length(replace(html, '<p>', ''))) / 3 AS BIGINT) AS n_paragraphs FROM pages
""")
def html_count_q(spark, sf_dir):
    """Paragraphs per page (a ``</p>`` or ``<p>`` inside a script does not count)."""
    p = spread(scan_pages(spark, f"{sf_dir}/pages.parquet"))
    return p.select("page_id", H.html_count("html", "p").alias("n_paragraphs"))


# ---- landed detail pages -> posts -----------------------------------------------------------
def _markup(c, place):
    """``c`` as the text of a page: escaped, and with some letters as decimal, hexadecimal or named entities, by the row."""
    out = F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return (F.when(place % 4 == 0, F.replace(out, F.lit("e"), F.lit("&#101;"))).when(place % 4 == 1, F.replace(out, F.lit("o"), F.lit("&#x6F;")))
            .when(place % 4 == 2, F.replace(out, F.lit("é"), F.lit("&eacute;"))).otherwise(out))


def forum_pages(spark, sf_dir):
    """Detail pages as a forum serves them, (page_id, html): a conversation's first turn is the post, its others are comments.

    Every third page has no title, dates of comments are missing on assistant turns, comments lie in two containers, every second one
    in a nested list, attributes come in both kinds of quotes and beside other classes, contents lie in nested boxes.
    """
    c = table(spark, sf_dir, "conversations").where("conv_id IS NOT NULL")
    text, n = F.coalesce("text", F.lit("")), F.col("turn")
    shown = F.when(F.col("role") != "assistant", F.concat(F.lit("<span class='date comment-list__detail-override'> day "), n.cast("string"), F.lit("</span>"))).otherwise("")
    body = F.concat(shown, F.lit('<p data-a="a>b" class="comment-list__text-override x">\n '), _markup(text, n), F.lit("<br>&nbsp;</p>"))
    item = F.struct(n.alias("turn"), F.concat(F.lit("<li>"), body, F.lit("</li>")).alias("html"))
    first, later = F.col("turn") == 0, F.collect_list(F.when(F.col("turn") > 0, item))
    pages = c.groupBy("conv_id").agg(F.max(F.when(first, F.struct("role", "text"))).alias("post"), F.array_sort(later).alias("items"))
    html_of = lambda keep: F.array_join(F.transform(F.filter("items", keep), lambda i: i["html"]), "")
    nested = F.regexp_replace(html_of(lambda i: i["turn"] % 3 == 2), r"</li>\z", "")
    title = F.when(F.col("conv_id") % 3 != 0, F.concat(F.lit('<h2 class="a DetailTitle_detail__header--title__Bbp40">'), F.coalesce("post.role", F.lit("")), F.lit("<b> !</b></h2>"))).otherwise("")
    content = F.concat(F.lit("<div class='Detail_content__content__hJ5M7'><div><div>"), _markup(F.coalesce("post.text", F.lit("")), F.col("conv_id")), F.lit("</div> tail </div>&hellip;</div>"))
    info = F.concat(F.lit("<div class=CommonInfos_info__wrapper__aGcEl><span>by</span><div> 2025-02-0"), (F.col("conv_id") % 9 + 1).cast("string"),
                    F.lit("</div><div>other</div></div><span class=\"experience__span--view\">1,0"), (F.col("conv_id") % 90 + 10).cast("string"), F.lit("</span>"))
    listed = lambda keep, end="": F.concat(F.lit('<div class="w CommentList_comment-contents__YVrtF"><ul>'), html_of(keep), F.lit(end), F.lit("</ul></div>"))
    comments = F.concat(listed(lambda i: i["turn"] % 3 == 0), F.lit("<ul><li>not a comment</li></ul>"), listed(lambda i: i["turn"] % 3 == 1),
                        F.lit("<div class='CommentList_comment-contents__YVrtF'><ul><li>more<ul>"), nested, F.lit("</ul></ul></div>"))
    return pages.select(F.col("conv_id").alias("page_id"), F.concat(F.lit("<html><body><script>'<li>'</script>"), title, content, info, comments, F.lit("</body>")).alias("html"))


@register("extract_posts", oracle="""
WITH t AS (
  SELECT conv_id, turn, role, trim(coalesce("text", ''), ' ' || chr(9) || chr(10) || chr(13)) AS txt,
         CASE WHEN role <> 'assistant' THEN 'day ' || turn ELSE 'N/A' END AS day
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id,
         list(day || '|' || txt ORDER BY turn % 3, turn) FILTER (turn > 0 AND turn % 3 < 2) AS flat,
         list(day || '|' || txt ORDER BY turn) FILTER (turn > 0 AND turn % 3 = 2) AS nested,
         coalesce(min_by(day, turn) FILTER (turn > 0 AND turn % 3 = 2 AND day <> 'N/A'), 'N/A') || '|' ||
           coalesce(min_by(txt, turn) FILTER (turn > 0 AND turn % 3 = 2), 'N/A') AS outside
  FROM t GROUP BY conv_id)
SELECT c.conv_id AS page_id, CASE WHEN c.conv_id % 3 <> 0 THEN coalesce(p.role, '') || '!' END AS title,
       coalesce(p.txt, '') || 'tail' || chr(8230) AS contents, '2025-02-0' || (c.conv_id % 9 + 1) AS date_text, '1,0' || (c.conv_id % 90 + 10) AS views_text,
       CAST(coalesce(len(flat), 0) + 1 + coalesce(len(nested), 0) AS BIGINT) AS n_comments,
       array_to_string(coalesce(flat, []) || [outside] || coalesce(nested, []), chr(10)) AS comments
FROM c LEFT JOIN t p ON p.conv_id = c.conv_id AND p.turn = 0
""")
def extract_posts_q(spark, sf_dir):
    """Detail pages -> title, contents, date, views and dated comments.  A list item that holds a nested list is a
    comment too: its fields are the first found inside it."""
    posts = extract_posts(forum_pages(spark, sf_dir), keep=["page_id"], default=H.DEFAULT)
    told = F.transform("comments", lambda c: F.concat(c["comment_date"], F.lit("|"), c["comment_text"]))
    title = F.when(F.col("title") != H.DEFAULT, F.col("title"))
    return posts.select("page_id", title.alias("title"), "contents", "date_text", "views_text", F.size("comments").cast("bigint").alias("n_comments"),
                        F.array_join(told, "\n").alias("comments"))


# ---- A3 -------------------------------------------------------------------------------------
def api_pages(spark, sf_dir):
    """Listing pages as the API returns them: ``{"collection": [...]}``, 20 items a page;
    every 7th item lacks ``viewCount``; one source carries relative dates."""
    d = table(spark, sf_dir, "documents")
    date_txt = F.expr(f"date_format(TIMESTAMP_NTZ'{BASE_TS}' + make_dt_interval(0, 0, CAST(n_chars AS INT), 0), 'yyyy-MM-dd HH:mm')")
    created = F.when(F.col("source") == RELATIVE_DATE_SOURCE, F.concat((F.col("n_chars") % 24).cast("string"), F.lit("시간전"))).otherwise(date_txt)
    item = F.struct(
        F.col("doc_id").alias("talkNo"), F.col("source").alias("title"), F.col("text").alias("contents"),
        created.alias("createdDate"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("n_chars")).alias("viewCount"),
        F.length("lang").cast("bigint").alias("replyCount"),
    )
    page = (F.col("doc_id") / PAGE_ROWS).cast("bigint") + 1
    g = d.groupBy(page.alias("page_index")).agg(F.array_sort(F.collect_list(item)).alias("collection"))
    return g.select("page_index", F.to_json(F.struct("collection")).alias("response"))


@register("scan_api_json", oracle=f"""
SELECT doc_id // {PAGE_ROWS} + 1 AS page_index, doc_id AS talk_no, source AS title, text AS contents,
       CASE WHEN source = '{RELATIVE_DATE_SOURCE}' THEN '{ASOF}'
            ELSE strftime(TIMESTAMP '{BASE_TS}' + to_minutes(CAST(n_chars AS BIGINT)), '%Y-%m-%d %H:%M') END AS date,
       CASE WHEN doc_id % 7 = 0 THEN NULL ELSE n_chars END AS view_count, CAST(length(lang) AS BIGINT) AS reply_count
FROM documents
""")
def scan_api_json_q(spark, sf_dir):
    """A3: API listing pages (JSON text) -> one row per post; missing ``viewCount`` -> null."""
    return api_items(api_pages(spark, sf_dir), "response", asof=ASOF, keep=["page_index"])


@register("api_rejects", oracle=f"""
SELECT p AS page_index, CASE p % 4 WHEN 0 THEN 'no_response' WHEN 1 THEN 'undecodable' WHEN 2 THEN 'undecodable' ELSE 'no_collection' END AS reject_reason
FROM (SELECT DISTINCT doc_id // {PAGE_ROWS} + 1 AS p FROM documents) WHERE p % 5 = 0
""")
def api_rejects_q(spark, sf_dir):
    """A3: listing pages that give no rows, with the reason: every fifth page is null, cut, followed by other text, or has no list."""
    p = api_pages(spark, sf_dir)
    n, r = F.col("page_index"), F.col("response")
    bad = (F.when(n % 4 == 0, F.lit(None).cast("string")).when(n % 4 == 1, r.substr(F.lit(1), F.length(r) - 3)).when(n % 4 == 2, F.concat(r, F.lit(' {"x": 1}')))
           .otherwise(F.lit('{"error": "busy"}')))
    return api_rejects(p.withColumn("response", F.when(n % 5 == 0, bad).otherwise(r)), "response", keep=["page_index"])
