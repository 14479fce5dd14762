"""B1, B2, B7, B8, B12, C5, A6, D6 and W1, D3, D4 edge cases."""

import pytest
from pyspark.sql import functions as F

from boardsmith.operators import batches as B
from boardsmith.operators import posts as P

POSTS = [
    (1, None, "c", "2025-01-01 00:00", "1,234"),   # missing title -> dropped
    (2, "   ", "c", "2025-01-01 00:00", "5"),      # blank title -> dropped
    (3, "t", None, "2025-01-01 00:00", "N/A"),     # missing contents -> 'N/A', kept
    (4, "t", "", "2025-01-01 00:00", "7"),         # empty contents -> dropped
    (5, "t", "c", None, "8"),                      # missing date -> kept
    (6, "t", "c", "", "9"),                        # empty date -> dropped
    (7, "t", "N/A", "5분전", "1,234"),             # literal N/A contents kept
]
SCHEMA = "post_id bigint, title string, contents string, date_text string, views_text string"


def test_required_and_rejected(spark):
    df = spark.createDataFrame(POSTS, SCHEMA)
    assert sorted(r.post_id for r in P.required(df).collect()) == [3, 5, 7]
    rej = {r.post_id: r.reject_reason for r in P.rejected(df).collect()}
    assert rej == {1: "no_title", 2: "blank_title", 4: "empty_contents", 6: "empty_date"}


def test_defaults_and_counts(spark):
    df = P.with_defaults(spark.createDataFrame(POSTS, SCHEMA), {"contents": "N/A", "date_text": "N/A"})
    r = {x.post_id: x for x in df.collect()}
    assert r[3].contents == "N/A" and r[5].date_text == "N/A"
    views = {x.id: x.views for x in P.to_refined(df).collect()}
    assert views[1] == 1234 and views[3] is None and views[7] == 1234


@pytest.mark.parametrize("url,tail,pid", [
    ("https://a.example/x/825?page=2&ref=x", "825", 825),
    ("https://a.example/en/25#top", "25", 25),
    ("https://a.example/en/853/", "", None),
    ("https://a.example/en/474.html", "474.html", None),
])
def test_post_id_from_url(spark, url, tail, pid):
    r = spark.createDataFrame([(url,)], "url string").select(P.url_tail("url").alias("t"), P.post_id_from_url("url").alias("p")).first()
    assert (r.t, r.p) == (tail, pid)


def test_frontier_and_missing(spark):
    listing = spark.createDataFrame([(10,), (7,), (5,)], "post_id bigint")
    fr = P.crawl_frontier(spark, listing, extra=2)
    assert [r.id for r in fr.collect()] == [12, 11, 10, 9, 8, 7, 6]  # oldest id (5) is never asked for
    assert sorted(r.id for r in P.missing_ids(fr, listing).collect()) == [6, 8, 9, 11, 12]
    b = P.id_bounds(listing).first()
    assert (b.newest_id, b.oldest_id, b.n_ids) == (10, 5, 3)


@pytest.mark.parametrize("n", [0, 1, 10, 11, 257])
def test_row_index_dense_and_batches(spark, n):
    df = spark.range(n).select((F.col("id") * 7 + 3).alias("k"))
    out = B.with_batches(df, "k", 10).collect()
    assert sorted(r.row_idx for r in out) == list(range(n))
    assert all(r.row_idx == (r.k - 3) // 7 and r.batch_id == r.row_idx // 10 for r in out)
    ranges = {r.batch_id: (r.first_row, r.last_row, r.n_rows) for r in B.batch_ranges(B.with_batches(df, "k", 10)).collect()}
    assert len(ranges) == (n + 9) // 10
    if n == 11:
        assert ranges == {0: (1, 10, 10), 1: (11, 11, 1)}


def test_row_index_is_stable_across_evaluations(spark):
    df = spark.range(5000).select(F.expr("(id * 7919) % 5003").alias("k"), F.repeat(F.lit("x"), 50).alias("wide"))
    num = B.with_row_index(df, "k")
    a = {r.k: r.row_idx for r in num.select("k", "row_idx").collect()}
    b = {r.k: r.row_idx for r in num.collect()}
    assert a == b and sorted(a.values()) == list(range(5000))


def test_prompts(spark):
    df = spark.createDataFrame([(1, "t1", "c1", "['a']"), (2, None, "c2", None), (3, "t3", "c3", "[]")], "post_id bigint, title string, contents string, comments string")
    p = {r.batch_id: r.prompt for r in B.build_prompts(B.with_batches(df, "post_id", 2)).collect()}
    assert p[0] == "1. Title: t1, Contents: c1, Comments: ['a']\n2. Title: nan, Contents: c2, Comments: nan\n"
    assert p[1] == "3. Title: t3, Contents: c3, Comments: []\n"


def test_comments_json_chunks(spark):
    rows = [(1, p, f"d{p}", f"c{p}") for p in range(2500)] + [(2, 0, "d", 'é "q"')]
    df = spark.createDataFrame(rows, "post_id bigint, pos bigint, comment_date string, comment_text string")
    out = {(r.post_id, r.chunk): r for r in P.comments_json(df).collect()}
    assert sorted(out) == [(1, 0), (1, 1), (1, 2), (2, 0)]
    assert [out[(1, c)].n_comments for c in range(3)] == [1000, 1000, 500]
    assert out[(2, 0)].comments_json == '[{"comment_date":"d","comment_text":"é \\"q\\""}]'
    assert out[(1, 1)].comments_json.startswith('[{"comment_date":"d1000"')


def test_comments_json_chunks_count_comments_not_positions(spark):
    rows = [(1, 999, "d", "a"), (1, 1000, "d", "b"), (1, None, "d", "first"), (1, 5_000_000, "d", "last"), (None, 3, "d", "x"), (2, 4, "d", "p"), (2, 4, "d", "q")]
    df = spark.createDataFrame(rows, "post_id bigint, pos bigint, comment_date string, comment_text string")
    out = P.comments_json(df, chunk_size=3).collect()
    assert {(r.post_id, r.chunk, r.n_comments) for r in out} == {(1, 0, 3), (1, 1, 1), (None, 0, 1), (2, 0, 2)}
    text = {(r.post_id, r.chunk): r.comments_json for r in out}
    assert [text[(1, 0)].index(f'"{t}"') for t in ("first", "a", "b")] == sorted(text[(1, 0)].index(f'"{t}"') for t in ("first", "a", "b"))
    assert '"last"' in text[(1, 1)]



def test_row_index_many_buckets_binary_search(spark):
    df = spark.range(20000).select(((F.col("id") * 7919) % 20011).alias("k"))
    a = {r.k: r.row_idx for r in B.with_row_index(df, "k", num_buckets=8).collect()}
    b = {r.k: r.row_idx for r in B.with_row_index(df, "k", num_buckets=3000).collect()}
    assert a == b and sorted(a.values()) == list(range(20000))
    assert all(a[k1] < a[k2] for k1, k2 in zip(sorted(a)[:-1], sorted(a)[1:]))


def test_row_index_bucket_count_follows_data(spark, monkeypatch):
    monkeypatch.setattr(B, "TARGET_ROWS_PER_BUCKET", 500)   # 20,000 rows -> 40 buckets > 8 shuffle partitions
    df = spark.range(20000).select(((F.col("id") * 7919) % 20011).alias("k"))
    out = B.with_row_index(df, "k")
    assert out.select(F.countDistinct("row_idx"), F.min("row_idx"), F.max("row_idx")).first() == (20000, 0, 19999)
    b = df.select(B.key_buckets(df, "k").alias("b")).agg(F.countDistinct("b")).first()[0]
    assert b > 30


def test_numbering_newest_first(spark):
    ids = [*range(100, 160), None]
    df = spark.createDataFrame([(i,) for i in ids], "post_id bigint").repartition(4)
    for buckets in (1, 7):
        out = {r.post_id: r.row_idx for r in B.with_row_index(df, "post_id", num_buckets=buckets, descending=True).collect()}
        assert out == {i: 159 - i for i in range(100, 160)} | {None: 60}
    first = B.with_batches(df, "post_id", 10, descending=True).where("batch_id = 0").collect()
    assert sorted(r.post_id for r in first) == list(range(150, 160))
