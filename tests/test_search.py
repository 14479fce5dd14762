"""Zero and null vectors, ties, fewer rows than k, bounds."""

import math
import random

from pyspark.sql import functions as F

from boardsmith.functions.vectors import cosine
from boardsmith.operators.search import rag_context, search, similarity

CORPUS = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [-1.0, 0.0])]


def _dfs(spark):
    c = spark.createDataFrame(CORPUS, "id bigint, vec array<float>")
    q = spark.createDataFrame([(100, [1.0, 0.0]), (200, [0.0, 0.0])], "query_id bigint, query_vec array<float>")
    return c, q


def test_cosine_scalar(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 0.0]), (None, [1.0])], "a array<double>, b array<double>")
    got = [r.c for r in df.select(cosine("a", "b").alias("c")).collect()]
    assert abs(got[0] - 1.0) < 1e-12 and got[1] is None and got[2] is None


def test_similarity_bounds_and_nulls(spark):
    c, q = _dfs(spark)
    s = similarity(c, q).collect()
    assert len(s) == len(CORPUS) * 2
    for r in s:
        assert r.similarity is None or -1.0 - 1e-9 <= r.similarity <= 1.0 + 1e-9
    assert all(r.similarity is None for r in s if r.query_id == 200)


def test_topk_ties_by_id_and_short(spark):
    c, q = _dfs(spark)
    top = search(c, q, k=3).where(F.col("query_id") == 100).orderBy("rank").collect()
    assert [r.id for r in top] == [1, 3, 2]  # 1 and 3 tie at 1.0 -> lower id first
    small = spark.createDataFrame([(1, [1.0, 0.0])], "id bigint, vec array<float>")
    assert search(small, q, k=4).where(F.col("query_id") == 100).count() == 1


def test_blocks_do_not_change_results(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(3)]) for i in range(200)] + [(200, None), (201, [1.0]), (202, [1.0, 2.0, 3.0, 4.0]), (None, [1.0])]
    c = spark.createDataFrame(rows, "id bigint, vec array<double>")
    q = c.where("id % 7 = 0").selectExpr("id AS query_id", "vec AS query_vec")
    want = {}
    for qid, qv in rows:
        if qid is not None and qid % 7 == 0:
            own = []
            for i, v in rows:
                if i is not None:
                    n = math.sqrt(sum(x * x for x in qv)) * math.sqrt(sum(x * x for x in v)) if v else 0
                    own.append((-round(sum(x * y for x, y in zip(qv, v)) / n, 6) if n else 9, i))
            want[qid] = [i for _, i in sorted(own)[:5]]
    for block, query_block in ((16_384, 4_096), (7, 3), (50, 1)):
        got = {}
        for r in search(c, q, k=5, block=block, query_block=query_block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.id)
        assert got == want
    told = lambda **kw: sorted((r[0], r[1], r[2] is not None and round(r[2], 9)) for r in similarity(c, q, **kw).collect())
    assert told() == told(block=9, query_block=2)
    assert search(c, q, k=30).count() == 30 * len(want)  # the form for long lists
    assert search(c.limit(0), q).collect() == [] and search(c, q.limit(0)).collect() == []


def test_no_join_of_all_rows(spark):
    c, q = _dfs(spark)
    plan = search(c, q)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Broadcast" not in plan


def test_text_ids(spark):
    c = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0])], "id string, vec array<float>")
    q = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, query_vec array<float>")
    assert [tuple(r) for r in search(c, q, k=2).orderBy("rank").collect()] == [("q", 1, "a", 1.0), ("q", 2, "b", 1.0)]


def test_rag_context(spark):
    hits = spark.createDataFrame([(9, 1, 1), (9, 2, 2), (9, 3, 77)], "query_id bigint, rank bigint, id bigint")
    posts = spark.createDataFrame([(1, "내용1", None), (2, "내용2", "답")], "post_id bigint, content string, comments string")
    r = rag_context(hits, posts).first()
    assert r.n_hits == 3 and r.context == "id:1, 내용:내용1, 답변:  \nid:2, 내용:내용2, 답변:답  \nid:77, 내용:, 답변:  \n"


def test_a_cell_holds_a_bounded_number_of_similarities(monkeypatch):
    import numpy as np
    import pandas as pd

    from boardsmith.operators import search as S

    r = np.random.default_rng(3)
    c = pd.DataFrame({"id": np.arange(50), "vec": [None if i == 7 else v for i, v in enumerate(r.normal(size=(50, 6)))]})
    q = pd.DataFrame({"query_id": np.arange(33), "vec": list(r.normal(size=(33, 6)))})
    whole = S._k_best(4, 6)(c, q)
    monkeypatch.setattr(S, "SCORES", 500)
    assert max(s.size for _, s in S._matrices(c, q)) <= 500
    pd.testing.assert_frame_equal(whole.reset_index(drop=True), S._k_best(4, 6)(c, q).reset_index(drop=True))
