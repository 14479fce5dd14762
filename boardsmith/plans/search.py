"""C4, F1, H9, D5 over ``embeddings`` (and ``documents`` for the context).

Probe vectors: the lowest ``vec_id`` of each ``label`` (one query per label, so the query
set is bounded by the label count); the corpus is the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from boardsmith.operators.search import rag_context, search, similarity
from boardsmith.functions.vectors import cosine
from boardsmith.plans import register
from boardsmith.session import table

TOPK = 4


def probes(emb):
    first = emb.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return emb.join(first, ["label", "vec_id"], "left_semi").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec")
    )


def corpus(emb):
    return emb.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


_PROBES_SQL = """
probes AS (SELECT vec_id AS query_id, embedding AS query_vec FROM embeddings
           WHERE (label, vec_id) IN (SELECT (label, min(vec_id)) FROM embeddings GROUP BY label))
"""

_SIM_SQL = """
scored AS (
  SELECT p.query_id, e.vec_id AS id,
         list_dot_product(e.embedding::DOUBLE[], p.query_vec::DOUBLE[])
           / nullif(sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))
                    * sqrt(list_dot_product(p.query_vec::DOUBLE[], p.query_vec::DOUBLE[])), 0) AS similarity
  FROM embeddings e, probes p)
"""


@register("cosine_scan", oracle=f"""
WITH {_PROBES_SQL}, {_SIM_SQL}
SELECT query_id, id, round(similarity, 6) AS similarity FROM scored
""")
def cosine_scan(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    s = similarity(corpus(emb), probes(emb))
    return s.select("query_id", "id", F.round("similarity", 6).alias("similarity"))


_TOPK_SQL = f"""
WITH {_PROBES_SQL}, {_SIM_SQL},
ranked AS (SELECT query_id, id, round(similarity, 6) AS similarity,
                  row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 6) DESC NULLS LAST, id) AS rank
           FROM scored)
"""


@register("cosine_topk", oracle=f"""
{_TOPK_SQL}
SELECT query_id, CAST(rank AS BIGINT) AS rank, id, similarity FROM ranked WHERE rank <= {TOPK}
""")
def cosine_topk(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return search(corpus(emb), probes(emb), k=TOPK)


@register("cosine_topk_all", oracle=f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS x, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
ranked AS (
  SELECT q.vec_id AS query_id, v.vec_id AS id, round(list_dot_product(q.x, v.x) / nullif(q.n * v.n, 0), 6) AS similarity,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.x, v.x) / nullif(q.n * v.n, 0), 6) DESC NULLS LAST, v.vec_id) AS rank
  FROM v q, v WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, id, similarity FROM ranked WHERE rank <= {TOPK}
""")
def cosine_topk_all(spark, sf_dir):
    """F1 for many questions: every vector whose id is divisible by 20 against all vectors, in blocks."""
    emb = table(spark, sf_dir, "embeddings")
    asked = emb.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return search(corpus(emb), asked, k=TOPK)


@register("cosine_pairs", oracle="""
SELECT a.vec_id AS vec_id, b.vec_id AS next_id,
       round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
             / nullif(sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]))
                      * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 0), 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def cosine_pairs(spark, sf_dir):
    """H9 on consecutive vectors (an equi-join on ``vec_id + 1``)."""
    a = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    b = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("b"))
    return a.join(b, F.col("next_id") == F.col("vec_id") + 1).select(
        "vec_id", "next_id", F.round(cosine("a", "b"), 6).alias("similarity")
    )


@register("rag_context", oracle=f"""
WITH {_PROBES_SQL}, {_SIM_SQL},
ranked AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 6) DESC NULLS LAST, id) AS rank
           FROM scored),
hits AS (SELECT * FROM ranked WHERE rank <= 3),
posts AS (SELECT doc_id AS post_id, text AS content, CASE WHEN doc_id % 2 = 1 THEN NULL ELSE source END AS comments FROM documents)
SELECT h.query_id, CAST(count(*) AS BIGINT) AS n_hits,
       string_agg('id:' || CAST(h.id AS VARCHAR) || ', 내용:' || coalesce(p.content, '') || ', 답변:' || coalesce(p.comments, '') || '  ' || chr(10), '' ORDER BY h.rank) AS context
FROM hits h LEFT JOIN posts p ON p.post_id = h.id
GROUP BY h.query_id
""")
def rag_context_q(spark, sf_dir):
    """Top-3 hits joined to documents (``doc_id = vec_id``); odd ids carry no comments."""
    emb = table(spark, sf_dir, "embeddings")
    hits = search(corpus(emb), probes(emb), k=3)
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("post_id"),
        F.col("text").alias("content"),
        F.when(F.col("doc_id") % 2 == 1, F.lit(None)).otherwise(F.col("source")).alias("comments"),
    )
    return rag_context(hits, docs)
