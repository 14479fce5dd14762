"""The three end-to-end flows on the smallest documents table."""

from pyspark.sql import functions as F

from boardsmith import workflows as W
from boardsmith.session import table

SF = "/root/testdata/sf0.001"


def _posts(spark):
    d = table(spark, SF, "documents")
    return d.select(F.col("doc_id").alias("post_id"), F.col("source").alias("title"), F.col("text").alias("contents"),
                    F.lit(None).cast("string").alias("comments"), F.col("n_chars").alias("views"), F.lit("2025-01-01 00:00").alias("date_text"))


def test_refine_categorize_search(spark, tmp):
    def reply_fn(batch_id, prompt):
        import re

        entries = []
        for m in re.finditer(r"(?m)^([0-9]+)\. Title: (.*?), Contents: ", prompt):
            num, title = m.group(1), m.group(2)
            entries.append(f"{num}. post from {title}\n댓글: 없음\n키워드:\n- {title}\n- forum\n- post\n성향: 경험성")
        return "\n\n".join(entries)

    posts = _posts(spark)
    r = W.refine_posts(posts, reply_fn, out_path=tmp)
    rows = {x.id: x for x in r.refined.collect()}
    assert len(rows) == posts.count()
    assert all(x.content == f"post from {x.keywords.split('; ')[0]}" and x.comments == "없음" for x in rows.values())
    assert r.rejects.count() == 0 and spark.read.parquet(tmp).count() == len(rows)
    cats, assigned = W.categorize_posts(r.refined, n=3)
    assert cats.count() == 3 and assigned.count() == len(rows)
    q = spark.createDataFrame([(1, "post from src3"), (2, "forum post")], "query_id bigint, text string")
    hits, ctx = W.search_posts(r.refined, q, k=3)
    assert hits.groupBy("query_id").count().where("count = 3").count() == 2
    assert ctx.count() == 2
    top1 = hits.where("query_id = 1 AND rank = 1").first()
    assert rows[top1.id].content == "post from src3" and abs(top1.similarity - 1.0) < 1e-6
    assert ctx.where("query_id = 1").first().context.startswith(f"id:{top1.id}, 내용:post from src3, 답변:없음  \n")


def test_refine_json_mode(spark):
    import json

    def fn(batch_id, prompt):
        import re

        n = len(re.findall(r"(?m)^[0-9]+\. Title: ", prompt))
        return json.dumps({"posts": [{"content": f"c{i}", "comments": [], "keywords": ["a", "b", "c"], "tendency": "질문성"} for i in range(n)]})

    r = W.refine_posts(_posts(spark), fn, mode="json")
    assert r.refined.count() == 200 and r.rejects.count() == 0


def test_refine_json_rejects(spark):
    import json

    def fn(batch_id, prompt):
        import re

        n = len(re.findall(r"(?m)^[0-9]+\. Title: ", prompt))
        posts = [{"content": f"c{i}", "comments": [], "keywords": ["a", "b", "c"], "tendency": "질문성"} for i in range(n)]
        posts[0] = {"content": "no keys"}                      # missing keys: dropped, rejected
        posts[1]["tendency"] = "정보성"                         # wrong label: kept, flagged
        return json.dumps({"posts": posts})

    r = W.refine_posts(_posts(spark), fn, mode="json")
    reasons = {x.reject_reason for x in r.rejects.collect()}
    assert reasons == {"missing_key", "bad_tendency"}
    assert r.refined.count() == 200 - 10 and r.rejects.count() == 20
