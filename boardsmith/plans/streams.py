"""Streams drained with ``availableNow`` and compared with the batch result."""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

from boardsmith.operators import batches as B
from boardsmith.operators.enrich import echo
from boardsmith.plans import register
from boardsmith.plans.refine import TEXT_BATCH, _PROMPT_SQL, numbered_input
from boardsmith.session import scratch_dir, table
from boardsmith.streaming.ingest import ingest_posts, read_landed, run_to_table
from boardsmith.streaming.missing import missing_ids_stream
from boardsmith.streaming.refine import LANDED, refine_rows_stream, refine_stream

LANDED_ROWS = 50_000  # posts of a landed file: a micro-batch, two files, does not grow with the table
WATERMARK = "3650 days"  # longer than the data: every repeat of a post id is a duplicate


@register("stream_ingest", oracle="SELECT DISTINCT user_id AS post_id FROM events")
def stream_ingest_q(spark, sf_dir):
    """Events as landed arrivals, ``user_id`` as the post id; one row per id survives."""
    schema = table(spark, sf_dir, "events").schema
    src = read_landed(spark, sf_dir, schema, glob="events.parquet")
    base = scratch_dir(spark, "stream_ingest")
    out, ck = os.path.join(base, "out"), os.path.join(base, "ckpt")
    run_to_table(ingest_posts(src, "user_id", "ts", WATERMARK).select("post_id", "ts", "event_id"), out, ck)
    return spark.read.parquet(out).select("post_id")


@register("stream_refine", oracle=f"""
WITH p AS ({_PROMPT_SQL.format(size=TEXT_BATCH)})
SELECT batch_id,
       CASE WHEN batch_id % 13 = 0 THEN NULL
            ELSE CAST(length(prompt) - length(replace(prompt, chr(10), '')) AS VARCHAR) || ' lines' || chr(10) || prompt END AS response,
       CASE WHEN batch_id % 13 = 0 THEN 'EchoFailure: batch ' || CAST(batch_id AS VARCHAR) || ' refused' END AS error
FROM p
""")
def stream_refine_q(spark, sf_dir):
    """Landed prompt batches streamed through the echo hook into the batch-keyed sink."""
    base = scratch_dir(spark, "stream_refine")
    landing, out, ck = (os.path.join(base, x) for x in ("landing", "out", "ckpt"))
    prompts = B.build_prompts(numbered_input(spark, sf_dir, TEXT_BATCH))
    prompts.write.mode("overwrite").parquet(landing)
    stream = read_landed(spark, landing, prompts.schema, max_files=2)
    refine_stream(stream, echo, out, ck)
    back = spark.read.parquet(out)
    return back.select(F.col("batch_id").cast("bigint").alias("batch_id"), "response", "error")


def titled_reply(batch_id: int, prompt: str) -> str:
    """Hook of the twin below: an entry for each prompt line, made of its title alone."""
    entries = []
    for number, title in re.findall(r"(?m)^([0-9]+)\. Title: (src[0-9]+-[0-9]+), Contents: ", prompt):
        label = "정보성" if title.startswith("src4-") else "경험성"
        entries.append(f"{number}. about {title}\n댓글:\n- seen\n- {title}\n키워드:\n- {title}\n- b\n- c\n성향: {label}")
    return "\n\n".join(entries)


@register("stream_refine_rows", oracle="""
SELECT doc_id AS id, 'about ' || source || '-' || doc_id AS content, 'seen; ' || source || '-' || doc_id AS comments,
       source || '-' || doc_id || '; b; c' AS keywords, CASE WHEN source = 'src4' THEN '정보성' ELSE '경험성' END AS tendency, n_chars AS views,
       CASE WHEN source = 'src4' THEN 'bad_tendency' END AS reject_reason
FROM documents
""")
def stream_refine_rows_q(spark, sf_dir):
    """S2 with state: posts landed in several files, numbered across micro-batches, refined and checked as they come."""
    base = scratch_dir(spark, "stream_refine_rows")
    landing = os.path.join(base, "landing")
    d = table(spark, sf_dir, "documents")
    posts = d.select(F.col("doc_id").alias("post_id"), F.concat("source", F.lit("-"), F.col("doc_id").cast("string")).alias("title"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("contents"),
                     F.col("lang").alias("comments"), F.col("n_chars").alias("views"), F.lit("2025-01-01").alias("date_text"), F.lit(False).alias("end"))
    posts.repartition(4, "post_id").write.option("maxRecordsPerFile", LANDED_ROWS).parquet(landing)
    run = lambda: refine_rows_stream(read_landed(spark, landing, LANDED, max_files=2), titled_reply, os.path.join(base, "out"), os.path.join(base, "ckpt"), size=TEXT_BATCH, lanes=8)
    run()
    spark.createDataFrame([(None, None, None, None, None, None, True)], LANDED).write.mode("append").parquet(landing)
    run()  # goes on where the first run ended; the end mark closes the short batches
    refined = spark.read.parquet(os.path.join(base, "out", "refined"))
    rejects = spark.read.parquet(os.path.join(base, "out", "rejects")).select("id", "reject_reason")
    return refined.join(rejects, "id", "left").select("id", "content", "comments", "keywords", "tendency", "views", "reject_reason")


ASKED_AT, ARRIVED_AT = "timestamp_seconds(1735689600 + 60 * doc_id)", "timestamp_seconds(1735689600 + 60 * (doc_id + n_chars % 90) - 60)"


@register("stream_missing_ids", oracle="""
SELECT doc_id AS id, CAST(1735689600 + 60 * doc_id AS BIGINT) AS asked_at FROM documents
WHERE doc_id % 7 = 0 OR n_chars % 90 < 1 OR n_chars % 90 > 61
""")
def stream_missing_ids_q(spark, sf_dir):
    """C5 as a stream: ids asked for whose post did not arrive within an hour; some never arrive, some come too early or too
    late, some arrive twice.  Event time comes from the ids; a last row on both sides moves the watermarks past all others."""
    base = scratch_dir(spark, "stream_missing_ids")
    d = table(spark, sf_dir, "documents")
    asked = d.select(F.col("doc_id").alias("id"), F.expr(ASKED_AT).alias("asked_at"))
    posts = d.where("doc_id % 7 <> 0").select(F.col("doc_id").alias("post_id"), F.expr(ARRIVED_AT).alias("arrived_at"))
    posts = posts.unionByName(posts.where("post_id % 5 = 0"))
    last = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.expr("timestamp_seconds(4000000000)").alias("at"))
    for name, rows in (("asked", asked), ("posts", posts)):
        rows.repartition(3).write.parquet(os.path.join(base, name))
    read = lambda name, schema: read_landed(spark, os.path.join(base, name), schema)
    run = lambda: run_to_table(
        missing_ids_stream(read("asked", asked.schema), read("posts", posts.schema), "60 MINUTES", "30 days"), os.path.join(base, "out"), os.path.join(base, "ckpt"))
    run()
    last.toDF("id", "asked_at").write.mode("append").parquet(os.path.join(base, "asked"))
    last.toDF("post_id", "arrived_at").write.mode("append").parquet(os.path.join(base, "posts"))
    run()
    return spark.read.parquet(os.path.join(base, "out")).where("id >= 0").select("id", F.unix_seconds("asked_at").alias("asked_at"))
