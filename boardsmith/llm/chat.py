"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, adjacent turns of one role merged by array
aggregation and concatenated into one training string.  Template of a message: ``<|role|>`` turn texts joined by
``[TURN]``, then ``</s>``.  Texts and roles are escaped with character entities, so a control string never
stands inside a text and reading back restores every turn exactly.

Defined cases: a null text or role counts as empty; null turns sort first, ties by role, then text; rows with a
null conversation id form one conversation; an empty table gives no rows; other columns are ignored.
One conversation is one output string, so its turns meet in one task by definition; everything inside it is
linear in its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardsmith.llm.common import sha256_hex

# Control strings of the template, and what stands for their first characters inside texts.
OPEN, CLOSE_ROLE, TURN, END = "<|", "|>", "[TURN]", "</s>"
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("|", "&#124;"))
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for char, entity in ENTITIES:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for char, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(conv_id, messages, formatted): one row per conversation; ``messages`` are the merged (role, texts)."""
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"),
            F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).alias("t"))
    t = F.col("t")
    runs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).withColumn(
        "first", F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])))
    until = lambda k: F.coalesce(F.get(F.col("first"), k + 1), F.size(t))
    merged = runs.select("conv_id", F.transform("first", lambda i, k: F.struct(
        F.get(t, i)["role"].alias("role"),
        F.transform(F.slice(t, i + 1, until(k) - i), lambda x: x["text"]).alias("texts"))).alias("messages"))
    message = lambda m: F.concat(
        F.lit(OPEN), escape(m["role"]), F.lit(CLOSE_ROLE), F.array_join(F.transform(m["texts"], escape), TURN), F.lit(END))
    return merged.withColumn("formatted", F.array_join(F.transform("messages", message), ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted): the turns (role, text) parsed from ``formatted`` alone, and all text under the loss mask."""
    body = r"<\|([^|]*+)\|>([^<]*+)</s>"
    turns = F.flatten(F.zip_with(
        F.regexp_extract_all("formatted", F.lit(body), F.lit(1)), F.regexp_extract_all("formatted", F.lit(body), F.lit(2)),
        lambda r, b: F.transform(F.split(b, r"\[TURN\]", -1), lambda x: F.struct(unescape(r).alias("role"), unescape(x).alias("text")))))
    read = formatted.select("conv_id", "formatted", turns.alias("turns"))
    trained = F.transform(F.filter("turns", lambda x: x["role"] == TRAINED_ROLE), lambda x: x["text"])
    return read.withColumn("loss_text", F.array_join(trained, ""))


def digests(read: DataFrame) -> DataFrame:
    """Digest columns of ``read_back`` rows."""
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha256_hex(lines).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), sha256_hex(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
