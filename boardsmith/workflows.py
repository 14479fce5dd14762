"""End-to-end flows matching the reference's stages, built from the operators.

* ``extract_pages``    landed detail pages -> posts with dated comments (+ pages without a post, with the reason)
* ``refine_posts``     crawled posts -> numbered batches -> prompts -> caller's function -> parsed replies
                       -> aligned refined rows (+ rows that break the reply contract)
* ``categorize_posts`` refined rows -> built categories -> primary/secondary category per post
* ``search_posts``     refined rows -> normalised, length-capped text -> vectors -> top-k per question
                       -> grounding context

Replies from the caller's function are written once to the shared checkpoint folder before
they are parsed, so recomputation after a failure never calls the function again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.functions.text import normalize_text
from boardsmith.operators import batches as B
from boardsmith.operators import categories as C
from boardsmith.operators import posts as P
from boardsmith.operators import replies as R
from boardsmith.operators.enrich import enrich_batches
from boardsmith.operators.rules import cap_tokens
from boardsmith.operators.search import rag_context, search
from boardsmith.operators.vector_hook import hook_vectors
from boardsmith.operators.vectorize import fit_text_vectors
from boardsmith.session import materialize
from boardsmith.sources.pages import Layout, extract_posts
from boardsmith.sources.sinks import append_batches

TEXT_BATCH, JSON_BATCH = 10, 20


def extract_pages(pages: DataFrame, status: str | None = None, layout: Layout | None = None) -> tuple[DataFrame, DataFrame]:
    """(posts: post_id, title, contents, date_text, views, comments array; rejects: the page's columns but the markup, reject_reason).

    The post's id is the end of ``url``, or ``page_id`` where there is no url.  Every page is in one of both tables.
    """
    taken, refused = (pages, None) if status is None else P.ok_pages(pages, status)
    ids = [c for c in ("url", "page_id") if c in pages.columns]
    named = F.coalesce(*[P.post_id_from_url("url") if c == "url" else F.col(c).try_cast("bigint") for c in ids]) if ids else F.lit(None).cast("bigint")
    found = materialize(extract_posts(taken.withColumn("post_id", named), keep=["post_id", *ids], layout=layout), "extracted")
    posts = P.required(found).select("post_id", "title", "contents", "date_text", P.to_count("views_text").alias("views"), "comments")
    rejects = P.rejected(found).select("post_id", *ids, "reject_reason")
    if refused is not None:
        rejects = rejects.unionByName(refused.select(named.alias("post_id"), *ids, F.lit("status").alias("reject_reason")))
    return posts, rejects


def posts_csv(posts: DataFrame) -> DataFrame:
    """Extracted posts in the columns of the crawl's CSV: missing values as ``'N/A'``, comments as JSON."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(P.NA))
    comment = lambda c: F.struct(*[F.coalesce(c[f], F.lit(P.NA)).alias(f) for f in ("comment_date", "comment_text")])
    return posts.select(text("post_id").alias("talkNo"), text("title").alias("Title"), text("contents").alias("Contents"), text("date_text").alias("Date"),
                        text("views").alias("ViewCount"), F.to_json(F.transform("comments", comment)).alias("Comments"))


@dataclass
class Refined:
    refined: DataFrame     # id, content, comments, keywords, tendency, views, date (rows missing a key dropped)
    rejects: DataFrame     # every row that was lost or breaks the reply contract: id, batch_id, reject_reason, kept
    responses: DataFrame   # batch_id, response, error (written once)


def refine_posts(posts: DataFrame, fn: Callable[[int, str], str], mode: str = "text", size: int | None = None,
                 strict_position: bool = False, out_path: str | None = None) -> Refined:
    """``posts``: post_id, title, contents, comments, views, date_text.

    Rows are numbered once and written, so that rows which repeat an id keep their own numbers; rows without an id
    are rejects (``null_id``).  Input rows = refined rows + rejects that are not ``kept``.
    """
    size = size or (TEXT_BATCH if mode == "text" else JSON_BATCH)
    numbered = materialize(B.with_batches(posts.where("post_id IS NOT NULL"), "post_id", size), "numbered")
    responses = materialize(enrich_batches(B.build_prompts(numbered), fn), "responses")
    if mode == "text":
        parsed = R.parse_text_replies(responses, size, strict_position=strict_position)
    elif mode == "json":
        parsed = R.parse_json_replies(responses, size)
    else:
        raise ValueError(f"unknown reply mode {mode}")
    aligned = R.align(parsed, numbered.select("row_idx", "post_id", "views", "date_text"))
    checked = aligned.withColumn("reject_reason", R.validation_reason())
    # Rows that only break the declared contract (tendency label, keyword count) are kept, as
    # the reference keeps them; a row missing a key would be half-written there and is dropped.
    kept = checked.where(F.col("reject_reason").isNull() | (F.col("reject_reason") != "missing_key"))
    refined = R.to_refined_rows(kept)
    if out_path:
        append_batches(R.to_refined_rows(kept, keep=["batch_id"]), out_path)
    no_id = posts.where("post_id IS NULL").select(
        F.col("post_id").alias("id"), F.lit(None).cast("bigint").alias("batch_id"), F.lit("null_id").alias("reject_reason"), F.lit(False).alias("kept"))
    rejects = R.reject_table(parsed, numbered, responses).unionByName(no_id)
    return Refined(refined, rejects, responses)


def categorize_posts(refined: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(categories, refined rows + primary_category, secondary_category)."""
    members = materialize(C.category_members(refined, n), "members")
    return C.category_store(members), C.assign_categories(refined, members)


def search_posts(refined: DataFrame, questions: DataFrame, k: int = 3, dims: int = 256, load: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """``questions``: query_id, text.  Returns (hits: query_id, rank, id, similarity; context per question).

    ``load`` gives the caller's model (``operators.vector_hook``), whose vectors have ``dims`` components; without it texts become tf-idf vectors.
    """
    corpus = cap_tokens(refined.withColumn("content", normalize_text("content")), "content")
    if load is not None:
        vecs = hook_vectors(corpus.select("id", "content", "comments"), load, dims, "content", "content_vector")
        qv = hook_vectors(questions.select("query_id", "text"), load, dims, "text", "query_vec")
    else:
        model = fit_text_vectors(corpus, "content", dims)
        vecs, qv = model.transform(corpus, "content"), model.transform(questions, "text", "query_vec")
    vecs = materialize(vecs.select("id", "content", "comments", "content_vector"), "vectors")
    qv = materialize(qv.select("query_id", "query_vec"), "question-vectors")
    hits = search(vecs.select("id", F.col("content_vector").alias("vec")), qv, k=k)
    ctx = rag_context(hits, vecs.select(F.col("id").alias("post_id"), "content", "comments"))
    return hits, ctx
