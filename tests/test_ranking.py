"""Ranks over tuples of any orderable columns."""

import random

from pyspark.sql import functions as F

from boardsmith.operators import batches as B
from boardsmith.operators import keywords as K
from boardsmith.operators import ranking as R


def ranks(df, order, **kw):
    return sorted((r["rank"], r["n"], r["word"]) for r in R.with_rank(df, order, **kw).collect())


def test_mixed_directions_with_nulls(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), f"w{i:05d}" if i % 97 else None) for i in range(3000)]
    rows = list(dict.fromkeys(rows))
    df = spark.createDataFrame(rows, "n int, word string")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or ""))  # ascending, nulls first
    want.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))  # descending, nulls last
    for buckets in (1, 5, 80):  # one bucket, a tree of comparisons, a fold
        assert [(n, w) for _, n, w in ranks(df, [("n", True), "word"], buckets=buckets)] == want
    assert [r for r, _, _ in ranks(df, [("n", True), "word"], start=1)] == list(range(1, len(rows) + 1))
    assert ranks(df.limit(0), ["word"]) == []


def test_one_value_of_nine_in_ten_rows_is_split(spark):
    """90 % of the keywords have count 1: no bucket holds more than twice the median."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(1).alias("n"), F.sha1(F.col("id").cast("string")).alias("word"))
    order = [("n", True), "word"]
    cuts = R.splitters(df, order, 16, 20_000)
    sizes = sorted(r["count"] for r in df.groupBy(R.bucket_of(df, order, cuts).alias("b")).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_text_keys_number_rows(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "k string, v int")
    assert [(r["row_idx"], r["v"]) for r in B.with_row_index(df, "k").orderBy("row_idx").collect()] == [(0, 3), (1, 2), (2, 1), (3, 4)]
    assert [(r["row_idx"], r["v"]) for r in B.with_batches(df, "k", 2, descending=True).orderBy("row_idx").collect()] == [(0, 4), (1, 1), (2, 2), (3, 3)]


def test_keyword_rank_and_list(spark):
    df = spark.createDataFrame([(1, "b; a"), (2, "a"), (3, "c;"), (4, None)], "id int, keywords string")
    assert [tuple(r) for r in K.keyword_rank(df).orderBy("rank").collect()] == [(1, "a", 2), (2, "b", 1), (3, "c", 1)]
    assert [tuple(r) for r in K.keyword_list(df, 2).orderBy("chunk_no").collect()] == [(0, 2, "a; b"), (1, 1, "c")]
