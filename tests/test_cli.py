"""The command line runs the three stages end to end on a small CSV."""

import os

from pyspark.sql import functions as F

from boardsmith.__main__ import main
from boardsmith.session import table


def test_cli_three_stages(spark, tmp):
    d = table(spark, "/root/testdata/sf0.001", "documents").limit(40)
    crawl = os.path.join(tmp, "crawl")
    d.select(F.col("doc_id").cast("string").alias("talkNo"), F.col("source").alias("Title"), F.col("text").alias("Contents"),
             F.lit("2025-01-01 00:00").alias("Date"), F.lit("1,234").alias("ViewCount"), F.lit("[]").alias("Comments")) \
        .coalesce(1).write.option("header", True).option("escape", '"').csv(crawl)
    refined, cats, hits = (os.path.join(tmp, x) for x in ("refined", "cat", "hits"))
    main(["refine", "--input", crawl, "--output", refined, "--hook", "tests_cli_hook:reply", "--csv"])
    assert spark.read.parquet(refined).count() == 40
    main(["categorize", "--input", refined, "--output", cats, "--n", "3"])
    assert spark.read.parquet(cats).count() == 40
    q = os.path.join(tmp, "q.txt")
    open(q, "w").write("post src3\n\nforum\n")
    main(["search", "--input", refined, "--questions", q, "--output", hits, "--k", "2"])
    assert spark.read.parquet(hits).count() == 4


def test_cli_extract(spark, tmp):
    from boardsmith.sources import pages as P
    from boardsmith.sources.csv import scan_posts_csv

    html = f'<h2 class="{P.TITLE}">T</h2><div class="{P.CONTENTS}"><div>a</div>b</div><div class="{P.COMMENTS}"><ul><li><p class="{P.COMMENT_TEXT}">c</p></li></ul></div>'
    pages, posts = os.path.join(tmp, "pages"), os.path.join(tmp, "posts")
    spark.createDataFrame([(1, html), (2, "<p>no post")], "page_id bigint, html string").write.parquet(pages)
    main(["extract", "--input", pages, "--output", posts, "--csv"])
    (row,) = spark.read.parquet(posts).collect()
    assert (row.post_id, row.title, row.contents, [c.comment_text for c in row.comments]) == (1, "T", "ab", ["c"])
    assert [r.reject_reason for r in spark.read.parquet(posts + "_rejects").collect()] == ["no_title"]
    assert scan_posts_csv(spark, posts + "_csv").first().comments == '[{"comment_date":"N/A","comment_text":"c"}]'
