"""Re-aimed text rules: lexicon replace (H12), tendency (H13), merged comments (D8), token cap.

The reference leaves these to a model's rewriting; here they are deterministic rules with
the same output shape, not the model's results.

A lexicon is a table of any size (``phrases``); texts never leave their rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardsmith.functions.text import NONE_MARKER, WS_CLASS, py_strip, token_estimate
from boardsmith.functions.util import as_col, with_columns_where
from boardsmith.operators.phrases import phrase_replace

# Whole-reply rules of the refine instructions - agreement phrases become one
# phrase, bare yes/no answers are dropped.
AGREE_PHRASES = ("저도 그래요", "맞아요", "공감합니다")
AGREE_CANON = "동의합니다"
BARE_ANSWERS = ("네", "아니오", "아니요")

# Tendency marker weights (question +, experience -); labels experience/question.
QUESTION_MARKERS = (
    ("?", 3), ("how", 1), ("what", 1), ("why", 1), ("which", 1), ("who", 1), ("when", 1), ("where", 1),
    ("can", 1), ("could", 1), ("should", 1), ("is", 1), ("are", 1), ("do", 1), ("does", 1),
    ("comment", 1), ("pourquoi", 1), ("quel", 1), ("quelle", 1), ("qui", 1),
    ("wie", 1), ("warum", 1), ("welche", 1), ("wer", 1), ("wann", 1),
    ("cómo", 1), ("qué", 1), ("cuál", 1), ("quién", 1), ("por", 1),
)
EXPERIENCE_MARKERS = (
    ("i", -1), ("my", -1), ("me", -1), ("we", -1), ("our", -1), ("was", -1), ("were", -1), ("had", -1),
    ("je", -1), ("mon", -1), ("ma", -1), ("ich", -1), ("mein", -1), ("war", -1), ("yo", -1), ("mi", -1), ("fue", -1),
)
# Korean words take endings, so these count wherever they stand inside a word.
INSIDE_MARKERS = (
    ("어떻게", 1), ("왜", 1), ("무엇", 1), ("궁금", 2), ("질문", 2), ("까요", 2), ("나요", 2), ("인가", 1),
    ("했어요", -1), ("했습니다", -1), ("었어요", -1), ("았어요", -1), ("었습니다", -1), ("았습니다", -1), ("경험", -2), ("후기", -2),
)
TENDENCY_QUESTION, TENDENCY_EXPERIENCE = "질문성", "경험성"


def reply_rules(c) -> Column:
    """H12 (whole reply): agreement phrase -> one phrase; bare yes/no -> null (drop the row)."""
    t = py_strip(as_col(c))
    return F.when(t.isin(*BARE_ANSWERS), F.lit(None).cast("string")).when(t.isin(*AGREE_PHRASES), F.lit(AGREE_CANON)).otherwise(as_col(c))


def lexicon_replace(df: DataFrame, text_col: str, lexicon: DataFrame, out: str = "text_out", **kw) -> DataFrame:
    """Lexicon of words and phrases, then whole-reply rules; rows that are only a bare yes/no are dropped."""
    r = phrase_replace(df, text_col, lexicon, out, **kw)
    bare = F.coalesce(py_strip(F.col(out)).isin(*BARE_ANSWERS), F.lit(False))
    return r.where(~bare).withColumn(out, reply_rules(out))


def _counted(text: Column, markers, left: str = "", right: str = "") -> Column:
    """Sum of weights over the occurrences of the markers: one count for each weight, by one alternation."""
    by_weight: dict[int, list[str]] = {}
    for marker, weight in markers:
        by_weight.setdefault(weight, []).append(marker)
    out = F.lit(0)
    for weight, own in by_weight.items():
        either = "|".join(sorted((re.escape(m) for m in own), key=len, reverse=True))
        out = out + F.regexp_count(text, F.lit(f"{left}(?:{either}){right}")) * weight
    return out


def tendency_score(c) -> Column:
    """H13 helper: sum of marker weights over the text's words, question marks, and Korean markers wherever they stand."""
    text = F.lower(F.coalesce(as_col(c), F.lit("")))
    whole = [m for m in QUESTION_MARKERS + EXPERIENCE_MARKERS if m[0] != "?"]
    asked = (F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))) * dict(QUESTION_MARKERS)["?"]
    inside = F.when(text.rlike("[가-힣]"), _counted(text, INSIDE_MARKERS)).otherwise(0)
    return (asked + _counted(text, whole, r"(?<![\p{L}'])", r"(?![\p{L}'])") + inside).cast("bigint")


def tendency(c) -> Column:
    """H13: '질문성' (question) when question markers outweigh experience markers, else '경험성'."""
    return F.when(tendency_score(c) > 0, F.lit(TENDENCY_QUESTION)).otherwise(F.lit(TENDENCY_EXPERIENCE))


def comment_key(c) -> Column:
    """D8 helper: a comment's duplicate key (lower case, whitespace collapsed, trimmed)."""
    return py_strip(F.regexp_replace(F.lower(as_col(c)), f"{WS_CLASS}+", " "))


def merge_comments(comments: DataFrame, post_col: str = "post_id", pos_col: str = "pos", text_col: str = "text") -> DataFrame:
    """Repeated comments of a post merged; keeps the first position, its text and the count.

    Grouped on (post, normalised text): a post with a third of all comments still spreads
    over its distinct texts, and the count is a partial aggregate.  Empty and ``없음``
    comments are not comments and are dropped.
    """
    k = comment_key(F.col(text_col))
    c = comments.withColumn("_k", k).where((F.col("_k") != "") & (F.col("_k") != NONE_MARKER))
    return c.groupBy(post_col, "_k").agg(
        F.min(pos_col).alias("first_pos"),
        F.min_by(F.col(text_col), F.col(pos_col)).alias("comment"),
        F.count(F.lit(1)).cast("bigint").alias("n_copies"),
    ).drop("_k")


TOKEN_LIMIT = 8192


def cap_tokens(df: DataFrame, text_col: str, limit: int = TOKEN_LIMIT, out: str = "n_tokens") -> DataFrame:
    """Keep rows whose estimated token count is strictly below ``limit`` (count computed once)."""
    return with_columns_where(df, {out: token_estimate(F.col(text_col))}, lambda r: r[out] < limit)
