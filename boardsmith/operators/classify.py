"""W3 through the caller's model: one prompt for each row with keywords, a JSON reply with two category names.

A reply is read back onto its row by the row's id.  Rows without keywords, failed calls and replies that do not decode get ``''`` twice, as
a row without a result has in the reference; a name outside the store is kept and told as a reject.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.functions.json import whole_object
from boardsmith.functions.text import split_list
from boardsmith.operators.enrich import enrich_batches
from boardsmith.operators.ledger import enrich_with_ledger
from boardsmith.operators.replies import CLASSIFY_REPLY_SCHEMA
from boardsmith.session import materialize

# The layout of the prompt (post with these keywords, possible categories, choose one main and one further category).
PROMPT = "다음 키워드를 가진 게시글을 주어진 카테고리 중에서 분류해주세요.\n\n키워드: %s\n\n가능한 카테고리:\n%s\n\n가장 적합한 주요 카테고리 1개와 부가 카테고리 1개를 선택해주세요.\n"


def classify_prompts(refined: DataFrame, categories: DataFrame, id_col: str = "id", col: str = "keywords", sep: str = ";") -> DataFrame:
    """(id, prompt) for every row with a keyword; the category names, few, are one value beside every row."""
    names = categories.select("ord", "name").distinct().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda c: c["name"]), ", ")).first()[0]
    keywords = split_list(F.col(col), sep)
    rows = refined.where(F.size(F.coalesce(keywords, F.array())) > 0)
    return rows.select(F.col(id_col).alias("id"), F.format_string(PROMPT, F.array_join(keywords, ", "), F.lit(names or "")).alias("prompt"))


def classify_posts(refined: DataFrame, categories: DataFrame, fn: Callable[[int, str], str], ledger: str | None = None, id_col: str = "id", col: str = "keywords") -> tuple[DataFrame, DataFrame]:
    """(refined rows + primary_category, secondary_category; rejects: id, reject_reason).

    With ``ledger`` equal prompts are one call and stored replies are not asked for again.
    """
    prompts = classify_prompts(refined, categories, id_col, col).withColumnRenamed("id", "batch_id")
    replies = materialize(enrich_with_ledger(prompts, fn, ledger) if ledger else enrich_batches(prompts, fn), "class-replies")
    decoded = materialize(replies.select(F.col("batch_id").alias("_id"), "response", whole_object("response", CLASSIFY_REPLY_SCHEMA).alias("r")), "classes")
    chosen = decoded.groupBy("_id").agg(F.min(F.struct(F.col("r.primary_category").alias("p"), F.col("r.secondary_category").alias("s"))).alias("c"))
    out = refined.join(chosen, F.col(id_col) == F.col("_id"), "left").select(
        *[F.col(f"`{c}`") for c in refined.columns], F.coalesce("c.p", F.lit("")).alias("primary_category"), F.coalesce("c.s", F.lit("")).alias("secondary_category"))
    known = F.broadcast(categories.select(F.col("name").alias("_name")).distinct())
    told = decoded.select("_id", "response", "r", F.explode_outer(F.array("r.primary_category", "r.secondary_category")).alias("_given"))
    told = told.join(known.withColumn("_known", F.lit(True)), F.col("_given") == F.col("_name"), "left")
    reason = (F.when(F.col("response").isNull() | (F.col("response") == ""), "failed_call").when(F.col("r").isNull(), "undecodable")
              .when(F.col("_given").isNull(), "missing_key").when(F.col("_known").isNull() & (F.col("_given") != ""), "unknown_category"))
    return out, told.select(F.col("_id").alias("id"), reason.alias("reject_reason")).where("reject_reason IS NOT NULL").distinct()
