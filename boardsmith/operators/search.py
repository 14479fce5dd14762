"""Exact cosine search: similarity scan (C4), top-k (F1), grounding context.

Corpus and questions are both dealt into blocks by a hash of their ids, and a cell holds one block of either, so its size is
fixed by two parameters whatever the tables hold: one plan for every size, nothing broadcast, no join of all rows with
all rows.  A cell multiplies its two matrices in Arrow-fed NumPy, in double precision, ``SCORES`` similarities at a time.  For a top-k it keeps the k best of
each question, so k rows for each question and block of the corpus are shuffled, and a ``row_number`` filter merges them.

Defined cases: a null or zero vector, or one with a null or NaN component, has a null similarity to everything; vectors of
different lengths pair up to the shorter; rows without an id are no hits, questions without an id are not asked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardsmith.functions.util import ordered_concat

VECTOR_BLOCK, QUERY_BLOCK = 16_384, 4_096  # rows of a cell of a top-k
SCAN_BLOCK, SCAN_QUERIES = 8_192, 64  # rows of a cell that returns every similarity
SCORES = 1 << 21  # similarities held at once in a cell: 16 MB
NONE = -3.0  # a similarity that is null, below any cosine


def _cells(corpus: DataFrame, queries: DataFrame, id_col: str, vec_col: str, qid_col: str, qvec_col: str, block: int, query_block: int):
    """Both tables grouped by the cells (corpus block, question block)."""
    c = corpus.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("id IS NOT NULL")
    q = queries.select(F.col(qid_col).alias("query_id"), F.col(qvec_col).cast("array<double>").alias("vec")).where("query_id IS NOT NULL")
    n_c, n_q = c.count(), q.count()
    q_blocks = max(1, -(-n_q // query_block))
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    c_blocks = max(1, -(-n_c // block), min(-(-cores // q_blocks), -(-n_c // 1024)))
    deal = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    c = c.withColumn("cb", deal("id", c_blocks)).withColumn("qb", every(q_blocks))
    q = q.withColumn("qb", deal("query_id", q_blocks)).withColumn("cb", every(c_blocks))
    return c.groupBy("cb", "qb").cogroup(q.groupBy("cb", "qb"))


def _unit(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of unit length, NaN where there is none."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        if v is None:
            out[i] = np.nan
        else:
            out[i, :len(v)] = v  # a null component arrives as NaN
    with np.errstate(invalid="ignore", divide="ignore"):
        return out / np.sqrt((out * out).sum(1))[:, None]


def _matrices(c: pd.DataFrame, q: pd.DataFrame):
    """(question ids, cosines: questions by corpus rows, ``NONE`` where there is none) for a few questions at a time."""
    width = max((len(v) for part in (c["vec"], q["vec"]) for v in part if v is not None), default=0)
    corpus, ids, step = _unit(c["vec"], width).T, q["query_id"].to_numpy(), max(1, SCORES // max(1, len(c)))
    for at in range(0, len(q), step):
        with np.errstate(invalid="ignore"):
            s = _unit(q["vec"].iloc[at:at + step], width) @ corpus
        s[np.isnan(s)] = NONE
        yield ids[at:at + step], s


def _frame(query_ids, ids, s) -> pd.DataFrame:
    return pd.DataFrame({"query_id": query_ids, "id": ids, "similarity": np.where(s == NONE, np.nan, s)})


def similarity(corpus: DataFrame, queries: DataFrame, id_col: str = "id", vec_col: str = "vec", qid_col: str = "query_id", qvec_col: str = "query_vec",
               block: int = SCAN_BLOCK, query_block: int = SCAN_QUERIES) -> DataFrame:
    """C4: (query_id, id, similarity) for every query x corpus row, which is what the operator is for; use ``search`` for the best few."""
    def every(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        parts = [_frame(np.repeat(asked, len(c)), np.tile(c["id"].to_numpy(), len(asked)), s.ravel()) for asked, s in _matrices(c, q)]
        return pd.concat(parts) if parts else _frame(q["query_id"].to_numpy(), c["id"].to_numpy()[:0], np.zeros(0))

    found = _cells(corpus, queries, id_col, vec_col, qid_col, qvec_col, block, query_block).applyInPandas(every, _schema(corpus, queries, id_col, qid_col))
    return found.withColumn("similarity", F.nanvl("similarity", F.lit(None).cast("double")))


def _schema(corpus: DataFrame, queries: DataFrame, id_col: str, qid_col: str) -> str:
    return f"query_id {queries.schema[qid_col].dataType.simpleString()}, id {corpus.schema[id_col].dataType.simpleString()}, similarity double"


def _k_best(k: int, digits: int):
    def run(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        c = c.sort_values("id")  # ties go to the smaller id: the first column of equal ones
        ids = c["id"].to_numpy()
        if not len(c) or not len(q):
            return _frame(q["query_id"].to_numpy()[:0], ids[:0], np.zeros(0))
        parts = []
        for asked, s in _matrices(c, q):
            order = np.argsort(-np.round(s, digits), axis=1, kind="stable")[:, :k] if k > 16 else _by_maximum(np.round(s, digits), k)
            rows = np.repeat(np.arange(len(asked)), order.shape[1])
            parts.append(_frame(asked[rows], ids[order.ravel()], s[rows, order.ravel()]))
        return pd.concat(parts)

    return run


def _by_maximum(s: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k greatest of each row, in falling order, the first of equal ones first."""
    out, every = [], np.arange(len(s))
    for _ in range(min(k, s.shape[1])):
        out.append(s.argmax(1))
        s[every, out[-1]] = -np.inf
    return np.stack(out, 1)


def top_k(scored: DataFrame, k: int = 3, digits: int = 6) -> DataFrame:
    """best ``k`` rows per query by similarity (rounded to ``digits``) desc, ties by id asc.

    Null similarities (zero vectors) sort last and are only returned when fewer than k
    real hits exist.  ``rank`` is 1-based.
    """
    s = F.round("similarity", digits)
    w = Window.partitionBy("query_id").orderBy(s.desc_nulls_last(), F.col("id").asc())
    return (
        scored.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("bigint").alias("rank"), "id", s.alias("similarity"))
    )


def search(corpus: DataFrame, queries: DataFrame, k: int = 3, id_col: str = "id", vec_col: str = "vec", qid_col: str = "query_id", qvec_col: str = "query_vec",
           block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK, digits: int = 6) -> DataFrame:
    """(query_id, rank, id, similarity), the k best of the corpus for every question."""
    cells = _cells(corpus, queries, id_col, vec_col, qid_col, qvec_col, block, query_block)
    found = cells.applyInPandas(_k_best(k, digits), _schema(corpus, queries, id_col, qid_col))
    return top_k(found.withColumn("similarity", F.nanvl("similarity", F.lit(None).cast("double"))), k, digits)


# The grounding-context line layout (id, content, answer) and its terminator.
CONTEXT_ID = "id:"
CONTEXT_CONTENT = ", 내용:"
CONTEXT_ANSWER = ", 답변:"
CONTEXT_END = "  \n"


def rag_context(hits: DataFrame, posts: DataFrame, post_id: str = "post_id", content: str = "content", comments: str = "comments") -> DataFrame:
    """Per query, hit rows concatenated in rank order as ``id:…, 내용:…, 답변:…  \\n``.

    ``hits`` = (query_id, rank, id); joined to ``posts`` on ``id = post_id`` (left: a hit whose post is missing keeps its
    line, with empty texts).  A null comment becomes ``''`` (the reference would raise).  Groups are k rows wide.
    """
    p = posts.select(F.col(post_id).alias("id"), F.col(content).alias("_content"), F.col(comments).alias("_comments"))
    line = F.concat(
        F.lit(CONTEXT_ID), F.col("id").cast("string"),
        F.lit(CONTEXT_CONTENT), F.coalesce("_content", F.lit("")),
        F.lit(CONTEXT_ANSWER), F.coalesce("_comments", F.lit("")),
        F.lit(CONTEXT_END),
    )
    return (
        hits.join(p, "id", "left")
        .withColumn("_line", line)
        .groupBy("query_id")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("n_hits"),
            ordered_concat("_line", "rank").alias("context"),
        )
    )
