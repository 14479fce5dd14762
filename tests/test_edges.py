"""Round trips into fresh folders."""

import glob
import os


from boardsmith.sources import categories as SC
from boardsmith.sources import csv as SV
from boardsmith.sources.pages import scan_api_pages, scan_pages
from boardsmith.sources.sinks import append_batches

ROWS = [(1, 'He said "hi"\nsecond line', "x"), (2, "", "y"), (3, "N/A", "z"), (4, "tab\there, comma", "w")]


def test_csv_roundtrip_and_bom(spark, tmp):
    df = spark.createDataFrame(ROWS, "id bigint, text string, tag string")
    SV.sink_csv(df, tmp, bom=True)
    part = sorted(glob.glob(os.path.join(tmp, "part-*.csv")))[0]
    assert open(part, "rb").read(3) == b"\xef\xbb\xbf"
    back = SV.scan_csv(spark, tmp, schema=None, null_value=None)
    assert back.columns == ["id", "text", "tag"]
    got = sorted((int(r.id), r.text, r.tag) for r in back.collect())
    assert got == sorted(ROWS)  # an empty text stays empty


def test_posts_csv_na(spark, tmp):
    df = spark.createDataFrame([("1", "t", "N/A", "d", "1,234", "[]"), ("x", "t", "c", "d", "N/A", None)],
                               "talkNo string, Title string, Contents string, Date string, ViewCount string, Comments string")
    SV.sink_csv(df, tmp, bom=True)
    r = sorted(SV.scan_posts_csv(spark, tmp).collect(), key=lambda r: str(r.post_id))
    assert (r[0].post_id, r[0].contents, r[0].views) == (1, None, 1234)
    assert (r[1].post_id, r[1].views) == (None, None)


def test_category_store_roundtrip(spark, tmp):
    cats = spark.createDataFrame([(2, "면접 전략", "설명", ["면접", "전략"]), (1, "아르바이트", "d", ["알바"])],
                                 "ord int, name string, description string, related_keywords array<string>")
    SC.sink_categories_json(cats, tmp)
    text = open(glob.glob(os.path.join(tmp, "part-*"))[0], encoding="utf-8").read()
    assert "아르바이트" in text and text.index("아르바이트") < text.index("면접 전략")
    back = SC.scan_categories(spark, tmp).orderBy("ord").collect()
    assert [(r.ord, r.name, list(r.related_keywords)) for r in back] == [(1, "아르바이트", ["알바"]), (2, "면접 전략", ["면접", "전략"])]
    flat = SC.categories_flat(cats).where("ord = 2").first()
    assert flat.related_keywords == '["면접","전략"]'


def test_append_batches_replaces_only_its_batches(spark, tmp):
    first = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "batch_id bigint, v string")
    append_batches(first, tmp)
    append_batches(spark.createDataFrame([(1, "B")], "batch_id bigint, v string"), tmp)
    got = sorted((r.batch_id, r.v) for r in spark.read.parquet(tmp).collect())
    assert got == [(0, "a"), (1, "B"), (2, "c")]


def test_scan_api_pages_files(spark, tmp):
    with open(os.path.join(tmp, "p1.json"), "w", encoding="utf-8") as f:
        f.write('{"collection": [{"talkNo": 5, "title": "t", "contents": "c", "createdDate": "3분전", "viewCount": 7, "replyCount": 1},\n'
                ' {"talkNo": 4, "title": "u"}]}')
    rows = sorted(scan_api_pages(spark, tmp, asof="2025-02-02").collect(), key=lambda r: r.talk_no)
    assert [(r.talk_no, r.date, r.view_count) for r in rows] == [(4, None, None), (5, "2025-02-02", 7)]


def test_scan_html_files(spark, tmp):
    for i in range(2):
        with open(os.path.join(tmp, f"{i}.html"), "w") as f:
            f.write(f"<html>\n<title>p{i}</title>\n</html>")
    rows = scan_pages(spark, os.path.join(tmp, "*.html"), fmt="html").collect()
    assert len(rows) == 2 and all("\n" in r.html for r in rows)


def test_csv_keeps_spaces_quotes_and_empty_values(spark, tmp):
    from boardsmith.sources import csv as C

    rows = [("  lead and trail  ", "a"), (" \tx\n", "b"), ("", "c"), ('say "hi", ok', "d"), (None, "e"), ("two\nlines", "f")]
    C.sink_csv(spark.createDataFrame(rows, "t string, k string"), tmp + "/out")
    got = C.scan_csv(spark, tmp + "/out", null_value=None)
    assert sorted(((r["t"], r["k"]) for r in got.collect()), key=lambda r: r[1]) == rows


def test_posts_csv_is_read_by_name(spark, tmp):
    import pytest

    from boardsmith.sources import csv as C

    names = "Comments string, talkNo string, Title string, Contents string, Date string, ViewCount string"
    C.sink_csv(spark.createDataFrame([("c", "7", "t", "x", "d", "1,200")], names), tmp + "/posts")
    (r,) = C.scan_posts_csv(spark, tmp + "/posts").collect()
    assert (r["post_id"], r["views"], r["comments"], r["title"]) == (7, 1200, "c", "t")
    C.sink_csv(spark.createDataFrame([("7", "3")], "talkNo string, ReplyCount string"), tmp + "/listing")
    with pytest.raises(ValueError, match="Comments"):
        C.scan_posts_csv(spark, tmp + "/listing")


def test_whole_runs_remove_stale_batches(spark, tmp):
    from boardsmith.sources.sinks import append_epoch, replace_batches

    run = lambda n: spark.range(n).selectExpr("id AS batch_id", "id * 2 AS v")
    replace_batches(run(25), tmp + "/b", span=10)
    assert sorted(f for f in os.listdir(tmp + "/b") if f.startswith("batch_range")) == ["batch_range=0", "batch_range=1", "batch_range=2"]
    replace_batches(run(7), tmp + "/b", span=10)
    assert spark.read.parquet(tmp + "/b").count() == 7
    append_epoch(run(3), tmp + "/e", 0)
    append_epoch(run(4), tmp + "/e", 1)
    append_epoch(run(2), tmp + "/e", 0)  # a replayed epoch replaces its own rows
    assert spark.read.parquet(tmp + "/e").groupBy("epoch").count().orderBy("epoch").collect() == [(0, 2), (1, 4)]


def test_append_batches_writes_folders_by_range_and_settles_cut_off_writes(spark, tmp):
    path = f"{tmp}/s"
    rows = lambda: sorted((r.batch_id, r.v) for r in spark.read.parquet(path).collect())
    append_batches(spark.range(300).selectExpr("id AS batch_id", "'a' AS v").coalesce(1), path, span=100)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) == 3  # a folder of each batch before
    append_batches(spark.createDataFrame([(5, "b"), (5, "c"), (300, "d")], "batch_id bigint, v string"), path, span=100)
    want = [(i, "a") for i in range(300) if i != 5] + [(5, "b"), (5, "c"), (300, "d")]
    assert rows() == sorted(want)
    # The write of run 2 was cut off before it removed what it replaces: the latest run holds after the next write.
    spark.createDataFrame([(200 + i, "x") for i in range(100)], "batch_id bigint, v string").write.parquet(f"{path}/run=2/batch_range=2")
    append_batches(spark.createDataFrame([(250, "y"), (7, "z")], "batch_id bigint, v string"), path, span=100)
    want = [(i, v) for i, v in want if i < 200 and i != 7 or i >= 300] + [(200 + i, "x") for i in range(100) if i != 50] + [(250, "y"), (7, "z")]
    assert rows() == sorted(want)
