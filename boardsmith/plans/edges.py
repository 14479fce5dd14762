"""Edges: CSV scan/sink round trips (A1, A2, A7), category store (A5, A8, A9), batch sink (A10).

Every round trip writes into a fresh folder under the session's checkpoint folder
(``spark.checkpoint.dir``, the cluster's shared storage) and reads the files back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from boardsmith.operators import batches as B
from boardsmith.operators import categories as C
from boardsmith.plans import register
from boardsmith.plans.keywords import CATS_SQL, N_CATEGORIES, refined
from boardsmith.plans.refine import TEXT_BATCH, _PROMPT_SQL, numbered_input
from boardsmith.session import scratch_dir, table
from boardsmith.sources import categories as SC
from boardsmith.sources import csv as SV
from boardsmith.sources.sinks import append_batches


@register("scan_csv", oracle="""
SELECT doc_id AS post_id, source AS title, text AS contents, CAST(n_chars AS BIGINT) AS views FROM documents
""")
def scan_csv_q(spark, sf_dir):
    """A1: crawled-post CSV (quotes, embedded newlines) written and scanned with an explicit schema."""
    d = table(spark, sf_dir, "documents")
    posts = d.select(
        F.col("doc_id").cast("string").alias("talkNo"), F.col("source").alias("Title"), F.col("text").alias("Contents"),
        F.lit("2025-01-01 00:00").alias("Date"), F.format_number("n_chars", 0).alias("ViewCount"), F.concat(F.lit("['"), "lang", F.lit("']")).alias("Comments"),
    )
    path = scratch_dir(spark, "scan_csv")
    SV.sink_csv(posts, path, bom=False)
    return SV.scan_posts_csv(spark, path).select("post_id", "title", "contents", "views")


@register("scan_listing_csv", oracle="""
SELECT doc_id AS post_id, source AS title, text AS contents, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE n_chars END AS views, CAST(length(lang) AS BIGINT) AS reply_count FROM documents
""")
def scan_listing_csv_q(spark, sf_dir):
    """A1: the API crawl's CSV with ReplyCount, ``'N/A'`` for missing counts, read back by header."""
    d = table(spark, sf_dir, "documents")
    views = F.when(F.col("doc_id") % 7 == 0, F.lit("N/A")).otherwise(F.format_number("n_chars", 0))
    rows = d.select(F.length("lang").cast("string").alias("ReplyCount"), F.col("doc_id").cast("string").alias("talkNo"), F.col("source").alias("Title"),
                    F.col("text").alias("Contents"), F.lit("2025-01-01").alias("Date"), views.alias("ViewCount"))
    path = scratch_dir(spark, "scan_listing_csv")
    SV.sink_csv(rows, path)
    return SV.scan_listing_csv(spark, path).select("post_id", "title", "contents", "views", "reply_count")


@register("scan_detail_csv", oracle="""
SELECT doc_id AS post_id, source AS title, text AS contents, CAST(CASE WHEN lang = 'de' THEN 0 ELSE 2 END AS BIGINT) AS n_comments,
       CASE WHEN lang = 'de' THEN '' ELSE 'N/A|' || lang || '; 2025-01-02|"' || source || '", ' || text END AS comments
FROM documents
""")
def scan_detail_csv_q(spark, sf_dir):
    """A1: the detail crawl's CSV, comments as a JSON list of (date, text), read back as structs."""
    d = table(spark, sf_dir, "documents")
    item = lambda date, text: F.struct(F.lit(date).alias("comment_date"), text.alias("comment_text"))
    comments = F.array(item("N/A", F.col("lang")), item("2025-01-02", F.concat(F.lit('"'), "source", F.lit('", '), "text")))
    rows = d.select(F.col("doc_id").cast("string").alias("talkNo"), F.col("source").alias("title"), F.col("text").alias("content"), F.lit("2025-01-01").alias("content_date"),
                    F.to_json(F.when(F.col("lang") == "de", F.slice(comments, 1, 0)).otherwise(comments)).alias("comments"))
    path = scratch_dir(spark, "scan_detail_csv")
    SV.sink_csv(rows, path)
    back = SV.scan_detail_csv(spark, path)
    told = F.array_join(F.transform("comments", lambda c: F.concat(c["comment_date"], F.lit("|"), c["comment_text"])), "; ")
    return back.select("post_id", "title", "contents", F.size("comments").cast("bigint").alias("n_comments"), told.alias("comments"))


@register("scan_csv_bom", oracle="SELECT doc_id, text FROM documents")
def scan_csv_bom_q(spark, sf_dir):
    """A2: a CSV with a UTF-8 BOM read by header names: the first column is ``doc_id``, not ``\\ufeffdoc_id``."""
    path = scratch_dir(spark, "scan_csv_bom")
    SV.sink_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path, bom=True)
    back = SV.scan_csv(spark, path, schema=None, null_value=None)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


@register("sink_csv_roundtrip", oracle="SELECT doc_id, text, source FROM documents")
def sink_csv_roundtrip_q(spark, sf_dir):
    """Documents (newlines, quotes) through the BOM CSV sink and back; no row lost or split."""
    path = scratch_dir(spark, "sink_csv")
    SV.sink_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), path, bom=True)
    return SV.scan_csv(spark, path, "doc_id bigint, text string, source string", null_value=None)


_CATS_OUT_SQL = f"""
WITH {CATS_SQL}
SELECT ord, chunk_no, name, description, array_to_string(related_keywords, '; ') AS related_keywords FROM cats
"""


def _built_categories(spark, sf_dir):
    return C.build_categories(refined(spark, sf_dir), N_CATEGORIES)


@register("sink_json_roundtrip", oracle=_CATS_OUT_SQL)
def sink_json_roundtrip_q(spark, sf_dir):
    """A8 + A5: built categories written as a store and scanned back."""
    path = scratch_dir(spark, "category_store")
    SC.sink_categories_json(_built_categories(spark, sf_dir), path)
    back = SC.scan_categories(spark, path, lines=True)
    return back.select("ord", "chunk_no", "name", "description", F.array_join("related_keywords", "; ").alias("related_keywords"))


@register("scan_categories", oracle=f"""
WITH {CATS_SQL}
SELECT ord, name, CAST(sum(len(related_keywords)) AS BIGINT) AS n_keywords FROM cats GROUP BY ALL
""")
def scan_categories_q(spark, sf_dir):
    """A5: a landed category store -> one row per category."""
    path = scratch_dir(spark, "category_store_scan")
    SC.sink_categories_json(_built_categories(spark, sf_dir), path)
    back = SC.scan_categories(spark, path, lines=True)
    return back.groupBy("ord", "name").agg(F.sum(F.size("related_keywords")).cast("bigint").alias("n_keywords"))


@register("categories_flat", oracle=f"""
WITH {CATS_SQL}
SELECT ord, chunk_no, name, description, CAST(to_json(related_keywords) AS VARCHAR) AS related_keywords FROM cats
""")
def categories_flat_q(spark, sf_dir):
    """Category table as flat CSV (keywords as JSON text), written and read back."""
    path = scratch_dir(spark, "categories_csv")
    SV.sink_csv(SC.categories_flat(_built_categories(spark, sf_dir).drop("n_keywords")), path, bom=True)
    return SV.scan_csv(spark, path, "ord int, chunk_no bigint, name string, description string, related_keywords string", null_value=None)


@register("append_batches", oracle=f"""
WITH p AS ({_PROMPT_SQL.format(size=TEXT_BATCH)})
SELECT batch_id, CAST(length(prompt) AS BIGINT) AS n_chars FROM p
""")
def append_batches_q(spark, sf_dir):
    """A10: prompts written batch-keyed, then the whole run replayed; each batch is present once."""
    path = scratch_dir(spark, "batches")
    prompts = B.build_prompts(numbered_input(spark, sf_dir, TEXT_BATCH))
    append_batches(prompts, path)
    append_batches(prompts, path)
    back = spark.read.parquet(path)
    return back.select(F.col("batch_id").cast("bigint").alias("batch_id"), F.length("prompt").cast("bigint").alias("n_chars"))
