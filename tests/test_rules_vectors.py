"""H12, H13, D8, B11, U4."""


from boardsmith.operators import rules as RU
from boardsmith.operators.vectorize import text_vectors


def test_lexicon(spark):
    rows = [(1, "Hello big World"), (2, "네"), (3, "맞아요"), (4, ""), (5, None), (None, "a  hello"), (None, "a  hello")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    lex = spark.createDataFrame([("hello", "HI"), ("world", "EARTH"), ("world", "GLOBE"), (None, "x"), ("hello", "HI")], "word string, replacement string")
    got = sorted(((r.id, r.text_out) for r in RU.lexicon_replace(df, "text", lex).collect()), key=repr)
    assert got == sorted([(1, "HI big EARTH"), (3, "동의합니다"), (4, ""), (5, None), (None, "a  HI"), (None, "a  HI")], key=repr)


def test_tendency(spark):
    df = spark.createDataFrame([("How do I apply?",), ("I was there, my shift was long",), ("",), (None,),
                                ("소득세 공제가 기록에 남을까요? 이유가 궁금합니다.",), ("퇴사하면 어떻게 되나요",), ("저는 작년에 신고를 했었어요.",), ("세무서에서 상담을 받았습니다",)], "t string")
    want = ["질문성", "경험성", "경험성", "경험성", "질문성", "질문성", "경험성", "경험성"]
    assert [r.o for r in df.select(RU.tendency("t").alias("o")).collect()] == want
    assert [r.s < 0 for r in df.select(RU.tendency_score("t").alias("s")).collect()][-2:] == [True, True]


def test_merge_comments(spark):
    df = spark.createDataFrame([(1, 0, "Good  job"), (1, 3, "good job"), (1, 1, "other"), (1, 2, "없음"), (2, 0, "good job")],
                               "post_id bigint, pos bigint, text string")
    got = sorted((r.post_id, r.first_pos, r.comment, r.n_copies) for r in RU.merge_comments(df).collect())
    assert got == [(1, 0, "Good  job", 2), (1, 1, "other", 1), (2, 0, "good job", 1)]


def test_cap_tokens(spark):
    df = spark.createDataFrame([(1, "a " * 10), (2, "a " * 20)], "id bigint, t string")
    assert [r.id for r in RU.cap_tokens(df, "t", limit=15).collect()] == [1]


def test_text_vectors_unit_norm(spark):
    df = spark.createDataFrame([(1, "apple banana"), (2, "banana cherry cherry"), (3, "")], "id bigint, content string")
    rows = {r.id: r.content_vector for r in text_vectors(df, dims=64).collect()}
    for i in (1, 2):
        assert len(rows[i]) == 64 and abs(sum(x * x for x in rows[i]) - 1.0) < 1e-5
    assert sum(abs(x) for x in rows[3]) == 0.0
