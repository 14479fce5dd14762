"""Elements end at their own end tags; paths of steps; entities; detail pages to posts."""

import pytest
from pyspark.sql import functions as F

from boardsmith import workflows as W
from boardsmith.functions import html as H
from boardsmith.sources import pages as P

PAGE = (
    '<html><head><title> Hello &amp; <b>World</b> </title><script>var t="</p>";</script><style>p{}</style></head>'
    '<body><nav><ul><li><a href="/a">A &amp; B</a></li><li> <i>two</i> </li></ul></nav><!-- <p>hidden</p> -->'
    '<div class="box ad wide">Ad text</div><article><h1>Head</h1><p><b>bold<br><p>inner</p><p>x</p></article>'
)
CUT = "<html><body><article><h1>Only</h1><p>cut here<p"


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("x")).first()["x"]


def test_fields(spark):
    df = spark.createDataFrame([(PAGE,), (CUT,)], "html string")
    a, b = df.select(
        H.html_text("html", "title").alias("title"), H.html_text("html", "div", "ad").alias("ad"),
        H.html_text("html", "footer").alias("footer"), H.html_text("html", "article").alias("article"),
        H.html_count("html", "p").alias("n_p"),
    ).collect()
    assert a.title == "Hello &World" and a.ad == "Ad text" and a.footer == "N/A"
    assert a.article == "Headboldinnerx" and a.n_p == 3  # script and comment <p> not counted
    assert b.title == "N/A" and b.article == "Onlycut here" and b.n_p == 1  # unclosed article runs to the end, a cut tag is none


@pytest.mark.parametrize("html, cls, text", [
    ('<div class="c"><div>in</div>rest</div>after', "c", "inrest"),
    ("<div class='c'>single</div>", "c", "single"),
    ("<div class=c>bare</div>", "c", "bare"),
    ('<p class="cc c-d">no</p><p class="a c b">token</p>', "c", "token"),
    ('<div class="c">&nbsp; </div>', "c", ""),
    ('<p class="c">&#44032;&#xAC00;&hellip;&amp;lt;&unknown;&#0;</p>', "c", "가가…&lt;&unknown;�"),
    ('<div class="c"><b>x</div>y</b>', "c", "x"),  # an end tag closes what is open inside its element
    ('<div class="c">x</span>y</div>', "c", "xy"),  # an end tag of nothing open is ignored
    ('<div data-x="a>b" class="c">1 < 2</div>', "c", "1 < 2"),
    ('<br class="c"><i class="c">z</i>', "c", ""),  # a void element has no text
    ('<div class="c"><script>var a = "<div>";</script>s</div>', "c", "s"),
    ("no markup", "c", "N/A"), ("", "c", "N/A"), (None, "c", "N/A"),
    ('<DIV CLASS="c">case</DIV>', "c", "case"),
    ('<a href="x>t</a><p class="c">quote</p>', "c", "quote"),
])
def test_first_element(spark, html, cls, text):
    assert one(spark, html, H.html_text("html", None, cls)) == text


def test_items_of_every_container(spark):
    assert one(spark, "<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul><ul><li>d</li></ul><li>e</li>", H.html_items("html")) == ["ab", "b", "c", "d"]
    assert one(spark, PAGE, H.html_items("html")) == ["A & B", "two"]
    assert one(spark, CUT, H.html_items("html")) == []
    assert one(spark, "<ul><li>a<li>b</ul>", H.html_items("html")) == ["ab", "b"]  # unclosed items nest, as in a tree of tags


def test_steps(spark):
    html = '<div class="i"><span>0</span><div>1<div>deep</div></div><div>2</div></div><div class="i"><div>3</div></div>'
    path = [H.step(None, "i"), H.step("div", nth=2)]
    texts = lambda p: one(spark, html, F.transform(H.elements(H.page("html"), p), lambda o: H.span_text(H.page("html"), o)))
    assert texts(path) == ["1deep"]
    assert texts([H.step(None, "i"), H.step("div", child=True)]) == ["1deep", "2", "3"]
    assert texts([H.step(None, "i"), H.step("div")]) == ["1deep", "deep", "2", "3"]
    assert texts([H.step("div"), H.step("div")]) == ["1deep", "deep", "2", "3"]  # each element once
    assert texts([]) == ["01deep23"]


def test_html_rows_fields_per_item(spark):
    page = ('<ul class="list"><li><div class="title"><div>T1</div> more</div><div class="contents"><div>C1 &amp; more</div></div>'
            '<span class="date">2025-02-02 00:23</span></li><li><div class="title"><div>T2</div></div></li></ul><ul><li>x</li></ul>')
    df = spark.createDataFrame([(7, page)], "page_id bigint, html string")
    rows = H.html_rows(df, "html", [H.step("ul", "list")], fields={"title": ("div", "title"), "contents": [H.step(None, "contents"), H.step("div")], "date": ("span", "date")},
                       keep=["page_id"]).orderBy("pos").collect()
    assert [(r.pos, r.title, r.contents, r.date) for r in rows] == [(0, "T1more", "C1 & more", "2025-02-02 00:23"), (1, "T2", "N/A", "N/A")]


DETAIL = f"""<body><h2 class='x {P.TITLE}'>A title</h2><div class="{P.CONTENTS}"><div>one</div> <p>two</p></div>
<div class="{P.INFOS}"><span>by</span><div> 2025-02-02 00:23 </div><div>no</div></div><i class="{P.VIEWS}">1,234</i>
<div class="{P.COMMENTS}"><ul><li><span class="{P.COMMENT_DATE}">d1</span><p class="{P.COMMENT_TEXT}">c&#49;</p></li><li><p class="{P.COMMENT_TEXT}">c2</p></li></ul>
<section><ul><li>not a child list</li></ul></section></div><div class="{P.COMMENTS}"><ul><li></li></ul></div>"""


def test_detail_pages_to_posts(spark):
    rows = [(1, "https://f/talk/11?x", 200, DETAIL), (2, "https://f/talk/12", 404, DETAIL), (3, "https://f/talk/13", 200, "<p>nothing"), (4, None, 200, None),
            (5, "https://f/talk/15", 200, f'<h1 class="{P.TITLE}"> </h1>')]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, status int, html string")
    posts, rejects = W.extract_pages(pages, status="status")
    (post,) = posts.collect()
    assert (post.post_id, post.title, post.contents, post.date_text, post.views) == (11, "A title", "onetwo", "2025-02-02 00:23", 1234)
    assert [tuple(c) for c in post.comments] == [("d1", "c1"), (None, "c2"), (None, None)]
    assert {(r.page_id, r.reject_reason) for r in rejects.collect()} == {(2, "status"), (3, "no_title"), (4, "no_title"), (5, "blank_title")}
    (line,) = W.posts_csv(posts).collect()
    assert line.Comments == '[{"comment_date":"d1","comment_text":"c1"},{"comment_date":"N/A","comment_text":"c2"},{"comment_date":"N/A","comment_text":"N/A"}]'
