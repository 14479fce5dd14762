"""Nothing is lost in the refine stage, and numbering copes with null, date and other keys."""

import datetime
from collections import Counter

import pytest

from boardsmith import workflows as W
from boardsmith.operators import batches as B

POSTS = "post_id bigint, title string, contents string, comments string, views bigint, date_text string"


def test_input_is_refined_plus_rejects(spark):
    ids = [*range(1, 45), 7, None, None]
    posts = spark.createDataFrame([(i, "t", f"c{k}", None, k, "d") for k, i in enumerate(ids)], POSTS)

    def reply(batch, prompt):
        import json

        if batch == 1:
            raise RuntimeError("refused")
        n = prompt.count("\n") - (batch == 0)
        good = {"content": "c", "comments": [], "keywords": ["a", "b", "c"], "tendency": "경험성"}
        return "not json" if batch == 2 else json.dumps({"posts": [good] * n})

    out = W.refine_posts(posts, reply, mode="json", size=10)
    rejects = out.rejects.collect()
    assert Counter(r.reject_reason for r in rejects) == {"short_reply": 1, "failed_call": 10, "undecodable": 10, "null_id": 2}
    assert not any(r.kept for r in rejects)
    assert Counter([r.id for r in out.refined.collect()] + [r.id for r in rejects]) == Counter(ids)


def test_repeated_ids_keep_their_own_replies(spark):
    posts = spark.createDataFrame([(k % 50, "t", f"text {k}", None, k, "d") for k in range(500)], POSTS)

    def reply(batch, prompt):
        import json
        import re

        texts = re.findall(r"Contents: (text \d+)", prompt)
        return json.dumps({"posts": [{"content": t, "comments": [], "keywords": ["a", "b", "c"], "tendency": "경험성"} for t in texts]})

    rows = W.refine_posts(posts, reply, mode="json", size=20).refined.collect()
    assert sorted((r.views, r.content, r.id) for r in rows) == [(k, f"text {k}", k % 50) for k in range(500)]


@pytest.mark.parametrize("buckets", [4, 700])
def test_null_keys_come_first_whatever_the_bucket_form(spark, buckets):
    df = spark.createDataFrame([(k,) for k in [*range(2000), None, None]], "k bigint")
    rows = sorted((r.row_idx, r.k) for r in B.with_row_index(df, "k", num_buckets=buckets).collect())
    assert rows == [(i, None if i < 2 else i - 2) for i in range(2002)]


def test_other_kinds_of_keys(spark):
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=3 * k) for k in range(300)]
    df = spark.createDataFrame([(d,) for d in reversed(days)], "k date")
    assert [r.k for r in sorted(B.with_row_index(df, "k").collect(), key=lambda r: r.row_idx)] == days
    assert B.key_buckets(df, "k") is not None
    with pytest.raises(TypeError):
        B.key_buckets(df.selectExpr("cast(k AS string) AS k"), "k")  # texts have no quantiles: with_row_index ranks them
