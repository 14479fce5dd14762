"""Enrichment replies back onto rows: filters (B10), JSON decode (H5), the free-text reply
parser (H7), positional alignment (C1), last write wins (W2), validation (B13), and the
refined projection (B12 / H4).

The text parser is a single ``aggregate`` fold over an entry's lines: a row-local
expression, so parsing never shuffles and a long reply never meets another reply's data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardsmith.functions.json import whole_object
from boardsmith.functions.text import LIST_SEP, NONE_MARKER, join_list, py_strip

# Section headers of the free-text reply, the entry and line separators, and
# the allowed tendency labels (experience, question).
COMMENTS_HEADER = "댓글:"
KEYWORDS_HEADER = "키워드:"
TENDENCY_HEADER = "성향:"
NONE_HEADER_LINE = "댓글: 없음"
ENTRY_SEP = "\n\n"
LINE_SEP = "\n"
TENDENCIES = ("경험성", "질문성")
MIN_KEYWORDS, MAX_KEYWORDS = 3, 5

REFINE_REPLY_SCHEMA = T.StructType([
    T.StructField("posts", T.ArrayType(T.StructType([
        T.StructField("content", T.StringType()),
        T.StructField("comments", T.ArrayType(T.StringType())),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("tendency", T.StringType()),
    ]))),
])

CLASSIFY_REPLY_SCHEMA = T.StructType([
    T.StructField("primary_category", T.StringType()),
    T.StructField("secondary_category", T.StringType()),
])


def ok_replies(replies: DataFrame, response: str = "response") -> DataFrame:
    """A failed call (null or empty reply) contributes no rows."""
    r = F.col(response)
    return replies.where(r.isNotNull() & (r != ""))


def parse_json(c, schema: T.StructType = REFINE_REPLY_SCHEMA) -> Column:
    """H5: decode a JSON reply; malformed text, or text around the object, gives null, a missing key a null field, never an error."""
    return whole_object(c, schema)


def _is_digit_first(x: Column) -> Column:
    return F.substring(x, 1, 1).rlike("^[0-9]$")


def _after_first_dot(x: Column) -> Column:
    return py_strip(F.regexp_replace(x, r"^[^.]*\.", ""))


def _fold_line(st: Column, x: Column, strict: bool = True) -> Column:
    sec = st["sec"]
    is_c = x.startswith(COMMENTS_HEADER)
    is_k = ~is_c & x.startswith(KEYWORDS_HEADER)
    is_t = ~is_c & ~is_k & x.startswith(TENDENCY_HEADER)
    header = is_c | is_k | is_t
    is_item = ~header & (x.startswith("-") | ((sec == "comments") & _is_digit_first(x)))
    none_only = F.array(F.lit(NONE_MARKER))

    comment_text = F.when(
        _is_digit_first(x), F.when(F.contains(x, F.lit(".")), _after_first_dot(x)).otherwise(x)
    ).otherwise(py_strip(F.substring(x, 2, 1 << 30)))
    comments = (
        F.when(is_c, F.when(x == NONE_HEADER_LINE, none_only).otherwise(F.array().cast("array<string>")))
        .when(is_item & (sec == "comments") & (st["comments"] != none_only), F.array_append(st["comments"], comment_text))
        .otherwise(st["comments"])
    )
    keywords = (
        F.when(is_k, F.array().cast("array<string>"))
        .when(is_item & (sec == "keywords"), F.array_append(st["keywords"], py_strip(F.substring(x, 2, 1 << 30))))
        .otherwise(st["keywords"])
    )
    tendency = F.when(is_t, py_strip(F.split_part(x, F.lit(":"), F.lit(2)))).otherwise(st["tendency"])
    if strict:  # the reference: a digit-first line containing '. ' loses everything up to its first '.'
        content_line = F.when(_is_digit_first(x) & F.contains(x, F.lit(". ")), _after_first_dot(x)).otherwise(x)
    else:       # default: only a real list number ('12. ') is removed, so '3.3% ...' stays whole
        content_line = F.regexp_replace(x, r"^[0-9]+\.\s+", "")
    content = F.when(~header & ~is_item & (sec == "content"), content_line).otherwise(st["content"])
    new_sec = F.when(is_c, F.lit("comments")).when(is_k, F.lit("keywords")).when(is_t, F.lit("tendency")).otherwise(sec)
    return F.struct(
        new_sec.alias("sec"), content.alias("content"), comments.alias("comments"),
        keywords.alias("keywords"), tendency.alias("tendency"),
    )


def parse_entry(entry: Column, strict: bool = True) -> Column:
    """H7 for one entry: struct(content, comments array, keywords array, tendency).

    Rules (strict, as the reference): lines are stripped and blank ones skipped; ``댓글:``,
    ``키워드:``, ``성향:`` switch section and reset their list (``댓글: 없음`` sets ``[없음]``);
    ``-`` lines, and digit lines inside comments, are items (digit items lose everything up
    to the first ``.``; ``-`` items lose the first character); items are ignored once the
    comments are ``[없음]``; the tendency is the text between the first and second colon; in
    the content section the last plain line wins, a leading number with ``'. '`` cut off
    (``strict``: up to the first ``.``, as the reference; otherwise only ``^\\d+\\.\\s+``).
    """
    lines = F.filter(F.transform(F.split(entry, LINE_SEP), lambda l: py_strip(l)), lambda l: l != F.lit(""))
    init = F.struct(
        F.lit("content").alias("sec"), F.lit("").alias("content"),
        F.array().cast("array<string>").alias("comments"), F.array().cast("array<string>").alias("keywords"),
        F.lit("").alias("tendency"),
    )
    st = F.aggregate(lines, init, lambda acc, x: _fold_line(acc, x, strict))
    return F.struct(st["content"].alias("content"), st["comments"].alias("comments"), st["keywords"].alias("keywords"), st["tendency"].alias("tendency"))


def parse_text_replies(replies: DataFrame, size: int, strict_position: bool = False, batch_col: str = "batch_id", response: str = "response") -> DataFrame:
    """H7 + C1 positions: (batch_id, entry_no, row_idx, content, comments, keywords, tendency).

    ``strict_position=True`` is the reference's behaviour: blank pieces count when numbering
    entries (a blank piece shifts the rest of the batch onto later rows) and content numbers
    are cut up to the first ``.``.  The default drops blank pieces before numbering and only
    removes a real list number from content lines.
    """
    pieces = F.split(F.col(response), ENTRY_SEP)
    if not strict_position:
        pieces = F.filter(pieces, lambda p: py_strip(p) != F.lit(""))
    e = ok_replies(replies, response).select(batch_col, F.posexplode(pieces).alias("entry_no", "entry"))
    e = e.where(py_strip("entry") != "")
    parsed = parse_entry(F.col("entry"), strict=strict_position)
    return e.select(
        batch_col,
        F.col("entry_no").cast("bigint").alias("entry_no"),
        (F.col(batch_col) * size + F.col("entry_no")).cast("bigint").alias("row_idx"),
        parsed["content"].alias("content"),
        parsed["comments"].alias("comments"),
        parsed["keywords"].alias("keywords"),
        parsed["tendency"].alias("tendency"),
    )


def parse_json_replies(replies: DataFrame, size: int, batch_col: str = "batch_id", response: str = "response") -> DataFrame:
    """H5 + C1 positions for JSON replies ``{"posts": [...]}``; a reply that does not decode gives no rows."""
    d = ok_replies(replies, response).select(batch_col, parse_json(F.col(response)).alias("_j"))
    d = d.select(batch_col, F.posexplode_outer("_j.posts").alias("entry_no", "p")).where(F.col("p").isNotNull())
    return d.select(
        batch_col,
        F.col("entry_no").cast("bigint").alias("entry_no"),
        (F.col(batch_col) * size + F.col("entry_no")).cast("bigint").alias("row_idx"),
        F.col("p.content").alias("content"),
        F.col("p.comments").alias("comments"),
        F.col("p.keywords").alias("keywords"),
        F.col("p.tendency").alias("tendency"),
    )


def latest_per_row(parsed: DataFrame, row_col: str = "row_idx", batch_col: str = "batch_id") -> DataFrame:
    """When a long reply runs into the next batch's rows, the later batch wins.

    ``max_by`` is a partial (map-side) aggregate, and its output is hash-partitioned on the
    row index, which the alignment join reuses without another shuffle.
    """
    payload = [c for c in parsed.columns if c != row_col]
    win = F.max_by(F.struct(*payload), F.col(batch_col))
    return parsed.groupBy(row_col).agg(win.alias("_w")).select(row_col, *[F.col(f"_w.{c}").alias(c) for c in payload])


def align(parsed: DataFrame, numbered_posts: DataFrame, row_col: str = "row_idx") -> DataFrame:
    """The n-th entry of batch b lands on input row ``b*size + n`` (inner equi-join).

    Rows past the end of the input find no partner and drop out (the reference's
    "stop at end of input"); rows without an entry are absent, as in its output.
    """
    latest = latest_per_row(parsed, row_col)
    keep = [c for c in numbered_posts.columns if c == row_col or c not in latest.columns]
    return latest.join(numbered_posts.select(*keep), row_col, "inner")


def to_refined_rows(aligned: DataFrame, id_col: str = "post_id", views: str = "views", date: str = "date_text",
                    keep: list[str] | None = None) -> DataFrame:
    """Id, content, comments, keywords (``'; '``-joined), tendency, views, date (+ ``keep``)."""
    return aligned.select(*(keep or []),
        F.col(id_col).alias("id"), "content",
        join_list("comments", LIST_SEP).alias("comments"),
        join_list("keywords", LIST_SEP).alias("keywords"),
        "tendency", F.col(views).alias("views"), F.col(date).alias("date"),
    )


def validation_reason(content="content", keywords="keywords", tendency="tendency") -> Column:
    """Why a refined row breaks the declared reply contract (null when it does not)."""
    n_kw = F.size(F.coalesce(F.col(keywords), F.array().cast("array<string>")))
    return (
        F.when(F.col(content).isNull() | F.col(keywords).isNull() | F.col(tendency).isNull(), F.lit("missing_key"))
        .when(~F.col(tendency).isin(*TENDENCIES), F.lit("bad_tendency"))
        .when((n_kw < MIN_KEYWORDS) | (n_kw > MAX_KEYWORDS), F.lit("keyword_count"))
    )


def reject_table(parsed: DataFrame, numbered: DataFrame, replies: DataFrame, id_col: str = "post_id", row_col: str = "row_idx",
                 batch_col: str = "batch_id", response: str = "response") -> DataFrame:
    """B13 for the whole input: (id, batch_id, reject_reason, kept) of every row with something wrong, each once.

    A row without an entry is ``failed_call`` (null or empty reply of its batch), ``undecodable`` (a reply without
    any entry) or ``short_reply``; other reasons are those of ``validation_reason``.  ``kept`` says whether the row is
    in the refined table all the same, so refined rows plus rejects that are not kept make up the input.
    """
    answered = parsed.select(batch_col).distinct().withColumn("_answered", F.lit(True))
    r = F.col(response)
    state = replies.join(answered, batch_col, "left").select(
        batch_col, F.when(r.isNull() | (r == ""), "failed_call").when(F.col("_answered").isNull(), "undecodable").otherwise("short_reply").alias("_lost"))
    landed = latest_per_row(parsed, row_col, batch_col).drop(batch_col).withColumn("_landed", F.lit(True))
    rows = numbered.select(row_col, batch_col, F.col(id_col).alias("id")).join(landed, row_col, "left").join(state, batch_col, "left")
    no_entry = F.col("_landed").isNull()
    reason = F.when(no_entry, F.coalesce("_lost", F.lit("failed_call"))).otherwise(validation_reason())
    out = rows.select("id", batch_col, reason.alias("reject_reason"), no_entry.alias("_none")).where("reject_reason IS NOT NULL")
    return out.select("id", batch_col, "reject_reason", (~F.col("_none") & (F.col("reject_reason") != "missing_key")).alias("kept"))


def validate_refined(df: DataFrame, **cols) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid-with-reason); nothing is dropped, rows are only routed."""
    r = df.withColumn("reject_reason", validation_reason(**cols))
    return r.where(F.col("reject_reason").isNull()).drop("reject_reason"), r.where(F.col("reject_reason").isNotNull())
