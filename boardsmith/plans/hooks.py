"""U3 with a ledger, U4 with a caller's model, W3 with a caller's model: deterministic hooks, so that twins can tell the results."""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import functions as F

from boardsmith.operators import batches as B
from boardsmith.operators import classify as CL
from boardsmith.operators.ledger import enrich_with_ledger
from boardsmith.operators.vector_hook import hook_vectors
from boardsmith.plans import register
from boardsmith.plans.keywords import REFINED_SQL, _SPLIT, refined
from boardsmith.plans.refine import TEXT_BATCH, _PROMPT_SQL, numbered_input
from boardsmith.session import scratch_dir, table


def counting_reply(batch_id: int, prompt: str) -> str:
    """Fails for every prompt of a multiple of 100 characters, else tells its length."""
    if len(prompt) % 100 == 0:
        raise ValueError("refused")
    return f"{len(prompt)} characters"


@register("enrich_ledger", oracle=f"""
WITH p AS ({_PROMPT_SQL.format(size=TEXT_BATCH)}),
e AS (SELECT *, length(prompt) % 100 = 0 AS bad, CASE WHEN length(prompt) % 100 = 0 THEN 4 ELSE 1 END AS calls FROM p)
SELECT batch_id, CASE WHEN NOT bad THEN length(prompt) || ' characters' END AS response, CASE WHEN bad THEN 'ValueError: refused' END AS error, CAST(calls AS BIGINT) AS n_calls FROM e
""")
def enrich_ledger_q(spark, sf_dir):
    """Prompts through a ledger, twice: the second run calls only what failed; failures are retried and then told."""
    path = scratch_dir(spark, "ledger")
    prompts = B.build_prompts(numbered_input(spark, sf_dir, TEXT_BATCH))
    enrich_with_ledger(prompts, counting_reply, path, attempts=2)
    return enrich_with_ledger(prompts, counting_reply, path, attempts=2)


LETTERS = "aeinorst"


def load_letters():
    """A model loaded once a worker: counts of eight letters; texts without any of them fail."""
    def encode(texts):
        out = np.array([[t.count(c) for c in LETTERS] for t in texts], np.float32)
        if (out.sum(1) == 0).any():
            raise ValueError("no letters")
        return out

    return encode


_COUNTS = [f"(length(text) - length(replace(text, '{c}', '')))" for c in LETTERS]


@register("hook_vectors", oracle=f"""
SELECT doc_id, CASE WHEN {' + '.join(_COUNTS)} > 0 THEN array_to_string([{', '.join(_COUNTS)}], ',') END AS vector,
       CASE WHEN {' + '.join(_COUNTS)} = 0 THEN 'ValueError: no letters' END AS vector_error
FROM documents
""")
def hook_vectors_q(spark, sf_dir):
    """U4: every whole text through the caller's model in Arrow batches; texts that fail are told alone."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    v = hook_vectors(d, load_letters, len(LETTERS), "text", "content_vector")
    return v.select("doc_id", F.array_join(F.transform("content_vector", lambda x: x.cast("int").cast("string")), ",").alias("vector"), "vector_error")


def classify_reply(_: int, prompt: str) -> str:
    """Chooses by the first keyword's first letter; some replies are cut, some name a category that is not there."""
    keywords, names = re.search(r"키워드: (.*)\n\n가능한 카테고리:\n(.*)\n", prompt).groups()
    first, known = keywords.split(", ")[0], names.split(", ")
    reply = json.dumps({"primary_category": known[ord(first[0]) % len(known)] if ord(first[0]) % 11 else "elsewhere", "secondary_category": known[0]}, ensure_ascii=False)
    return reply[:-1] if len(first) % 9 == 0 else reply


CLASSES = ("north", "south", "east")


@register("classify_replies", oracle=f"""
WITH {REFINED_SQL},
f AS (SELECT id, {_SPLIT} AS w FROM refined),
c AS (SELECT id, w[1] AS first, unicode(substr(w[1], 1, 1)) AS u FROM f)
SELECT id, CASE WHEN first IS NULL OR length(first) % 9 = 0 THEN '' WHEN u % 11 = 0 THEN 'elsewhere' ELSE list_value('north', 'south', 'east')[u % 3 + 1] END AS primary_category,
       CASE WHEN first IS NULL OR length(first) % 9 = 0 THEN '' ELSE 'north' END AS secondary_category,
       CASE WHEN length(first) % 9 = 0 THEN 'undecodable' WHEN u % 11 = 0 THEN 'unknown_category' END AS reject_reason
FROM c
""")
def classify_replies_q(spark, sf_dir):
    """W3 through a hook: two category names a post from JSON replies, with the replies that were no use."""
    r = refined(spark, sf_dir)
    categories = spark.createDataFrame([(i, n) for i, n in enumerate(CLASSES, 1)], "ord int, name string")
    out, rejects = CL.classify_posts(r, categories, classify_reply, ledger=scratch_dir(spark, "class-ledger"))
    return out.join(rejects, "id", "left").select("id", "primary_category", "secondary_category", "reject_reason")
