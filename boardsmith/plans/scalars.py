"""Scalar functions (H1-H4, H6, H8, H11) and post shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardsmith.functions import text as T
from boardsmith.operators import posts as P
from boardsmith.plans import register
from boardsmith.plans.fixtures import RAW_POSTS_SQL, raw_posts, sql_strip
from boardsmith.session import table

ASOF = "2025-02-02"


def _s(x):
    return sql_strip(x)


# ---- H1 -------------------------------------------------------------------------------------
_INJECT_SQL = "replace(replace(text, '. ', '.. '), ', ', ' , ') || chr(9) || '. .  end'"


@register("normalize_text", oracle=f"""
SELECT doc_id, out AS content, CAST(length(out) AS BIGINT) AS n_chars FROM (
  SELECT doc_id, {_s("replace(replace(replace(regexp_replace(" + _s("regexp_replace(" + _INJECT_SQL + ", '\\s+', ' ', 'g')") + ", '. ,', '', 'g'), '..', '.'), '. .', '.'), chr(10), '')")} AS out
  FROM documents)
""")
def normalize_text_q(spark, sf_dir):
    """H1 on whole documents with ``..``, `` ,`` and tabs injected."""
    d = table(spark, sf_dir, "documents")
    inj = F.concat(F.replace(F.replace("text", F.lit(". "), F.lit(".. ")), F.lit(", "), F.lit(" , ")), F.lit("\t. .  end"))
    out = T.normalize_text(inj)
    return d.select("doc_id", out.alias("content")).withColumn("n_chars", F.length("content").cast("bigint"))


# ---- H2 -------------------------------------------------------------------------------------
@register("relative_date", oracle=f"""
SELECT event_id, raw_date,
       CASE WHEN contains(raw_date, '분전') OR contains(raw_date, '시간전') THEN '{ASOF}' ELSE raw_date END AS date_text
FROM (SELECT event_id,
             CASE event_type WHEN 'click' THEN CAST(minute(ts) AS VARCHAR) || '분전'
                             WHEN 'view' THEN CAST(hour(ts) AS VARCHAR) || '시간전'
                             ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS raw_date
      FROM events)
""")
def relative_date_q(spark, sf_dir):
    """H2 on all events: clicks as "N분전", views as "N시간전", others absolute; as-of day fixed."""
    e = table(spark, sf_dir, "events")
    raw = (
        F.when(F.col("event_type") == "click", F.concat(F.minute("ts").cast("string"), F.lit("분전")))
        .when(F.col("event_type") == "view", F.concat(F.hour("ts").cast("string"), F.lit("시간전")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    )
    return e.select("event_id", raw.alias("raw_date")).withColumn("date_text", T.relative_date("raw_date", ASOF))


# ---- H3 / H4 --------------------------------------------------------------------------------
@register("split_keywords", oracle=f"""
SELECT doc_id, CAST(len(items) AS BIGINT) AS n_items, array_to_string(items, '; ') AS items FROM (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '[.,]', ';', 'g'), ';'), lambda x: {_s('x')}), lambda x: x <> '') AS items
  FROM documents)
""")
def split_keywords_q(spark, sf_dir):
    """H3 on whole documents, sentence and clause marks turned into ``;``."""
    d = table(spark, sf_dir, "documents")
    arr = T.split_list(F.regexp_replace("text", "[.,]", ";"), ";")
    return d.select("doc_id", F.size(arr).cast("bigint").alias("n_items"), T.join_list(arr).alias("items"))


@register("join_list", oracle="""
SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda x: length(x) > 12), '; ') AS joined FROM documents
""")
def join_list_q(spark, sf_dir):
    """H4: words longer than 12 characters joined with ``'; '`` (many rows give the empty list -> ``''``)."""
    d = table(spark, sf_dir, "documents")
    arr = F.filter(F.split("text", " "), lambda x: F.length(x) > 12)
    return d.select("doc_id", T.join_list(arr).alias("joined"))


# ---- H6 -------------------------------------------------------------------------------------
@register("to_json_comments", oracle=f"""
SELECT conv_id, CAST(place // {P.COMMENT_CHUNK} AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n_comments,
       CAST(to_json(list({{'comment_date': '2025-01-01 00:0' || CAST(turn AS VARCHAR), 'comment_text': text}} ORDER BY turn)) AS VARCHAR) AS comments_json
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS place FROM conversations WHERE turn >= 1)
GROUP BY conv_id, place // {P.COMMENT_CHUNK}
""")
def to_json_comments_q(spark, sf_dir):
    """H6: a post's comments (turns >= 1) as a JSON array of ``{comment_date, comment_text}``, non-ASCII kept."""
    c = table(spark, sf_dir, "conversations").where(F.col("turn") >= 1).select(
        "conv_id", "turn", F.concat(F.lit("2025-01-01 00:0"), F.col("turn").cast("string")).alias("comment_date"), F.col("text").alias("comment_text")
    )
    return P.comments_json(c, "conv_id", "turn")


# ---- H8 -------------------------------------------------------------------------------------
@register("strip_marker", oracle="""
SELECT doc_id, CAST(pos AS BIGINT) AS line_no, regexp_replace(marked, '^\\s*(-|[0-9]+\\.)\\s*', '') AS line FROM (
  SELECT doc_id, pos,
         CASE pos % 6 WHEN 0 THEN '- ' || line WHEN 3 THEN '- ' || line WHEN 1 THEN CAST(pos + 1 AS VARCHAR) || '. ' || line WHEN 4 THEN '* ' || line
                      WHEN 5 THEN CAST(pos AS VARCHAR) || ') ' || line ELSE line END AS marked
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents))
""")
def strip_marker_q(spark, sf_dir):
    """H8 on every line of every document, with ``- `` and ``N. `` marks injected, and ``* `` and ``N) ``, which stay."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    pm = F.col("pos") % 6
    marked = (
        F.when(pm.isin(0, 3), F.concat(F.lit("- "), "line"))
        .when(pm == 1, F.concat((F.col("pos") + 1).cast("string"), F.lit(". "), "line"))
        .when(pm == 4, F.concat(F.lit("* "), "line"))
        .when(pm == 5, F.concat(F.col("pos").cast("string"), F.lit(") "), "line"))
        .otherwise(F.col("line"))
    )
    return d.select("doc_id", F.col("pos").cast("bigint").alias("line_no"), T.strip_marker(marked).alias("line"))


# ---- H11 ------------------------------------------------------------------------------------
_NONE_RAW_SQL = "CASE source WHEN 'src1' THEN '' WHEN 'src2' THEN '없음' WHEN 'src4' THEN NULL ELSE regexp_replace(text, '[.]', ';', 'g') END"


@register("none_marker", oracle=f"""
SELECT doc_id, CAST(len(arr) AS BIGINT) AS n_comments, array_to_string(arr, '; ') AS comments FROM (
  SELECT doc_id, CASE WHEN raw IS NULL OR {_s('raw')} IN ('', '없음') THEN []::VARCHAR[]
                      ELSE list_filter(list_transform(string_split(raw, ';'), lambda x: {_s('x')}), lambda x: x <> '') END AS arr
  FROM (SELECT doc_id, {_NONE_RAW_SQL} AS raw FROM documents))
""")
def none_marker_q(spark, sf_dir):
    """``''``, ``없음`` and null comments all become the empty list."""
    d = table(spark, sf_dir, "documents")
    raw = (
        F.when(F.col("source") == "src1", F.lit(""))
        .when(F.col("source") == "src2", F.lit(T.NONE_MARKER))
        .when(F.col("source") == "src4", F.lit(None).cast("string"))
        .otherwise(F.regexp_replace("text", "[.]", ";"))
    )
    arr = T.none_marker(raw)
    return d.select("doc_id", F.size(arr).cast("bigint").alias("n_comments"), T.join_list(arr).alias("comments"))


# ---- B7 / B8 / B12 --------------------------------------------------------------------------
_REQ_SQL = f"title IS NOT NULL AND {_s('title')} <> '' AND coalesce(contents, 'N/A') <> '' AND coalesce(date_text, 'N/A') <> ''"


@register("defaults", oracle=f"""
WITH {RAW_POSTS_SQL}
SELECT post_id, coalesce(title, 'N/A') AS title, coalesce(contents, 'N/A') AS contents,
       coalesce(date_text, 'N/A') AS date_text, coalesce(views_text, 'N/A') AS views_text
FROM raw_posts
""")
def defaults_q(spark, sf_dir):
    """Missing title/contents/date/views -> ``'N/A'``."""
    return P.with_defaults(raw_posts(spark, sf_dir), {c: P.NA for c in ("title", "contents", "date_text", "views_text")})


@register("required_filter", oracle=f"""
WITH {RAW_POSTS_SQL}
SELECT post_id, title, date_text FROM raw_posts WHERE {_REQ_SQL}
""")
def required_filter_q(spark, sf_dir):
    """Drop rows with missing/blank title or empty contents/date; missing contents is kept."""
    return P.required(raw_posts(spark, sf_dir)).select("post_id", "title", "date_text")


@register("required_rejects", oracle=f"""
WITH {RAW_POSTS_SQL}
SELECT post_id, CASE WHEN title IS NULL THEN 'no_title' WHEN trim(title) = '' THEN 'blank_title' WHEN contents = '' THEN 'empty_contents' ELSE 'empty_date' END AS reject_reason
FROM raw_posts WHERE NOT ({_REQ_SQL})
""")
def required_rejects_q(spark, sf_dir):
    """The rows that are dropped, each with its reason."""
    return P.rejected(raw_posts(spark, sf_dir)).select("post_id", "reject_reason")


@register("project_refined", oracle=f"""
WITH {RAW_POSTS_SQL}
SELECT post_id AS id, contents AS content, title, TRY_CAST(replace({_s('views_text')}, ',', '') AS BIGINT) AS views, date_text AS date
FROM raw_posts WHERE {_REQ_SQL}
""")
def project_refined_q(spark, sf_dir):
    """Kept posts in the refined stage's names and types (views ``'1,234'`` -> 1234, ``'N/A'`` -> null)."""
    return P.to_refined(P.required(raw_posts(spark, sf_dir)))


# ---- B1 / B2 / D6 ---------------------------------------------------------------------------
@register("url_build", oracle=f"""
SELECT doc_id, printf('{P.DETAIL_URL}', doc_id) AS detail_url, printf('{P.LISTING_URL}', doc_id // 20 + 1) AS listing_url FROM documents
""")
def url_build_q(spark, sf_dir):
    """B1: detail URL per id and listing URL per page (20 rows a page)."""
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id").cast("bigint") / 20).cast("bigint").alias("_p"))
    d = P.with_url(d, "doc_id", P.DETAIL_URL, "detail_url")
    d = d.withColumn("listing_url", F.format_string(P.LISTING_URL, F.col("_p") + 1))
    return d.select("doc_id", "detail_url", "listing_url")


_TAIL_SQL = "split_part(split_part(string_split(url, '/')[-1], '?', 1), '#', 1)"


@register("post_id_from_url", oracle=f"""
SELECT page_id, {_TAIL_SQL} AS url_tail, TRY_CAST({_TAIL_SQL} AS BIGINT) AS post_id FROM pages
""")
def post_id_from_url_q(spark, sf_dir):
    """B2: last URL part cut at ``?`` and ``#``; not a number -> null."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", P.url_tail("url").alias("url_tail"), P.post_id_from_url("url").alias("post_id"))


@register("id_bounds", oracle=f"""
SELECT max(post_id) AS newest_id, min(post_id) AS oldest_id, CAST(count(post_id) AS BIGINT) AS n_ids
FROM (SELECT TRY_CAST({_TAIL_SQL} AS BIGINT) AS post_id FROM pages)
""")
def id_bounds_q(spark, sf_dir):
    """Newest and oldest post id of the landed listing pages."""
    p = table(spark, sf_dir, "pages").select(P.post_id_from_url("url").alias("post_id"))
    return P.id_bounds(p)


# ---- F2 / F3 / G1 / B9 ----------------------------------------------------------------------
@register("head10", oracle=f"""
WITH {RAW_POSTS_SQL}
SELECT post_id, title FROM raw_posts WHERE {_REQ_SQL} ORDER BY post_id LIMIT 10
""")
def head10_q(spark, sf_dir):
    """first 10 kept posts by id (the limit is the feature)."""
    return P.head(P.required(raw_posts(spark, sf_dir)).select("post_id", "title"), 10)


@register("newest_first", oracle=f"""
WITH {RAW_POSTS_SQL}
SELECT post_id, title FROM raw_posts WHERE {_REQ_SQL} ORDER BY post_id DESC
""")
def newest_first_q(spark, sf_dir):
    """kept posts, newest (highest id) first."""
    return P.newest_first(P.required(raw_posts(spark, sf_dir)).select("post_id", "title"))


@register("union_pages", oracle="""
SELECT doc_id, doc_id // 20 + 1 AS page_no, 'first' AS fetch FROM documents
UNION ALL
SELECT doc_id, doc_id // 20 + 1 AS page_no, 'second' AS fetch FROM documents WHERE lang = 'en'
""")
def union_pages_q(spark, sf_dir):
    """G1: two fetches of the listing (the second re-reads the English pages), duplicates kept."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("doc_id").cast("bigint") / 20).cast("bigint").alias("_p"))
    page = lambda df, tag: df.select("doc_id", (F.col("_p") + 1).alias("page_no"), F.lit(tag).alias("fetch"))
    return P.union_pages([page(d, "first"), page(d.where(F.col("lang") == "en"), "second")])


_STATUS_SQL = "CASE WHEN lang = 'de' THEN 404 WHEN lang = 'es' AND n_chars < 500 THEN 500 ELSE 200 END"


@register("status_filter", oracle=f"""
SELECT doc_id, lang, status FROM (SELECT doc_id, lang, {_STATUS_SQL} AS status FROM documents) WHERE status = 200
""")
def status_filter_q(spark, sf_dir):
    """Landed responses with a status; only 200 pages give rows."""
    return P.ok_pages(_landed(spark, sf_dir))[0]


def _landed(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    status = F.when(F.col("lang") == "de", F.lit(404)).when((F.col("lang") == "es") & (F.col("n_chars") < 500), F.lit(500)).otherwise(F.lit(200))
    return d.select("doc_id", "lang", status.alias("status"))


@register("status_rejects", oracle=f"""
SELECT doc_id, lang, status FROM (SELECT doc_id, lang, {_STATUS_SQL} AS status FROM documents) WHERE status <> 200
""")
def status_rejects_q(spark, sf_dir):
    """Landed responses that give no rows, with their status."""
    return P.ok_pages(_landed(spark, sf_dir))[1]


# ---- C2 / A6 / C5 ---------------------------------------------------------------------------
@register("posts_join_comments", oracle="""
SELECT p.conv_id AS post_id, CAST(length(p.text) AS BIGINT) AS post_chars, c.turn, c.role, c.text AS comment_text
FROM (SELECT conv_id, text FROM conversations WHERE turn = 0) p
JOIN (SELECT conv_id, turn, role, text FROM conversations WHERE turn >= 1) c ON c.conv_id = p.conv_id
""")
def posts_join_comments_q(spark, sf_dir):
    """Turn 0 of a conversation is the post, later turns its comments; inner join on the post id."""
    c = table(spark, sf_dir, "conversations")
    posts = c.where(F.col("turn") == 0).select(F.col("conv_id").alias("post_id"), F.length("text").cast("bigint").alias("post_chars"))
    comments = c.where(F.col("turn") >= 1).select(F.col("conv_id").alias("post_id"), "turn", "role", F.col("text").alias("comment_text"))
    return P.posts_with_comments(posts, comments)


FRONTIER_EXTRA = 50


@register("frontier", oracle=f"""
SELECT unnest(range(mx + {FRONTIER_EXTRA}, mn, -1)) AS id FROM (SELECT max(doc_id) AS mx, min(doc_id) AS mn FROM documents)
""")
def frontier_q(spark, sf_dir):
    """Descending ids from newest + 50 down to (not including) the oldest id."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"))
    return P.crawl_frontier(spark, d, extra=FRONTIER_EXTRA)


@register("missing_ids", oracle=f"""
WITH {RAW_POSTS_SQL},
kept AS (SELECT post_id FROM raw_posts WHERE {_REQ_SQL}),
fr AS (SELECT unnest(range(mx + {FRONTIER_EXTRA}, mn, -1)) AS id FROM (SELECT max(post_id) AS mx, min(post_id) AS mn FROM kept))
SELECT id FROM fr WHERE id NOT IN (SELECT post_id FROM kept)
""")
def missing_ids_q(spark, sf_dir):
    """Ids in the crawl frontier without a kept post (dropped by B8, or beyond the newest)."""
    kept = P.required(raw_posts(spark, sf_dir)).select("post_id")
    return P.missing_ids(P.crawl_frontier(spark, kept, extra=FRONTIER_EXTRA), kept)
