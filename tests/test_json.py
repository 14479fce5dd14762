"""JSON that must be one whole object; listing pages that give no rows."""

import pytest

from boardsmith.operators import replies as R
from boardsmith.sources import csv as SV
from boardsmith.sources import pages as P

GOOD = '{"posts":[{"content":"c","comments":[],"keywords":["k"],"tendency":"t"}]}'


@pytest.mark.parametrize("text, ok", [
    (GOOD, True), (f" \n{GOOD}\n", True), (GOOD + ' {"x":1}', False), (GOOD + " junk }", False), (GOOD + "," + GOOD, False), (GOOD + "]", False),
    (GOOD + "]}", False), (GOOD[:-1], False), ("text " + GOOD, False), (GOOD.replace('"', "'"), False), ("[1]", False), ("", False), (None, False), ("{}", True),
])
def test_whole_objects_only(spark, text, ok):
    row = spark.createDataFrame([(text,)], "s string").select(R.parse_json("s").alias("j")).first()
    assert (row.j is not None) == ok
    if ok and text != "{}":
        assert row.j.posts[0].content == "c" and row.j.posts[0].keywords == ["k"]


def test_every_listing_page_has_rows_or_a_reason(spark):
    pages = [(1, '{"collection":[{"talkNo":1}]}'), (2, '{"collection":[]}'), (3, None), (4, '{"collection":[{"talkNo":1}'), (5, '{"error":1}'), (6, ' '), (7, '{"collection":[{"talkNo":2}]} x')]
    df = spark.createDataFrame(pages, "page int, response string")
    assert [r.talk_no for r in P.api_items(df, keep=["page"]).collect()] == [1]
    assert {(r.page, r.reject_reason) for r in P.api_rejects(df, keep=["page"]).collect()} == {(3, "no_response"), (4, "undecodable"), (5, "no_collection"), (6, "no_response"), (7, "undecodable")}


def test_the_three_crawls_are_told_by_their_headers(spark, tmp):
    detail = spark.createDataFrame([("7", "t", "c", "d", '[{"comment_date":"x","comment_text":"y"}]'), ("8", "t", "c", "d", "broken")], "talkNo string, title string, content string, content_date string, comments string")
    SV.sink_csv(detail, f"{tmp}/d")
    assert [(r.post_id, r.comments and [tuple(c) for c in r.comments]) for r in SV.scan_detail_csv(spark, f"{tmp}/d").orderBy("post_id").collect()] == [(7, [("x", "y")]), (8, None)]
    listing = spark.createDataFrame([("7", "t", "c", "d", "1,234", "N/A")], "talkNo string, Title string, Contents string, Date string, ViewCount string, ReplyCount string")
    SV.sink_csv(listing, f"{tmp}/l")
    assert tuple(SV.scan_listing_csv(spark, f"{tmp}/l").first()) == (7, "t", "c", "d", 1234, None)
    for name in ("d", "l"):
        assert {"post_id", "title", "contents", "comments", "views", "date_text"} <= set(SV.scan_any_posts_csv(spark, f"{tmp}/{name}").columns)
    with pytest.raises(ValueError):
        SV.scan_posts_csv(spark, f"{tmp}/l")
