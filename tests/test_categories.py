"""D1, D2, D7, C3, W3, D9 properties and edge rows."""

from boardsmith.operators import categories as C
from boardsmith.operators import keywords as K
from boardsmith.sources import categories as SC

REFINED = [
    (1, "a; b; c"), (2, "a; b; d"), (3, "a; c; e;"), (4, " ;"), (5, None), (6, "b; b; z"), (7, "q"),
]


def _ref(spark):
    return spark.createDataFrame(REFINED, "id bigint, keywords string")


def test_distinct_and_union(spark):
    d = sorted(r.keyword for r in K.distinct_keywords(_ref(spark)).collect())
    assert d == ["a", "b", "c", "d", "e", "q", "z"]
    other = spark.createDataFrame([("a",), ("new",)], "keyword string")
    assert sorted(r.keyword for r in K.keyword_union(K.distinct_keywords(_ref(spark)), other).collect()) == d[:5] + ["new", "q", "z"]


def test_keyword_list_holds_the_whole_vocabulary(spark):
    rows = sorted((r.chunk_no, r.n_keywords, r.keywords) for r in K.keyword_list(_ref(spark), chunk=3).collect())
    assert rows == [(0, 3, "a; b; c"), (1, 3, "d; e; q"), (2, 1, "z")]


def test_keywords_are_whole_words(spark):
    df = spark.createDataFrame([(1, "français résumé über straße 소득세 공제가")], "doc_id bigint, text string")
    got = {r.keyword for r in K.top_keywords(df.unionByName(spark.createDataFrame([(2, "x")], df.schema)), k=9).collect()}
    assert got == {"français", "résumé", "über", "straße", "소득세", "공제가"}
    df = spark.createDataFrame([(1, "cafe\u0301 नमस्ते"), (2, "x"), (3, None), (4, "")], "doc_id bigint, text string")
    assert {r.keyword for r in K.top_keywords(df, k=9).collect()} == {"cafe\u0301", "नमस्ते"}  # combining marks stay in their words


def members(df, n):
    return sorted(tuple(r) for r in C.category_members(df, n).select("ord", "name", "keyword", "hop", "n_posts").collect())


def test_every_keyword_has_one_owner(spark):
    rows = members(_ref(spark), 2)
    assert sorted(r[2] for r in rows) == ["a", "b", "c", "d", "e", "q", "z"]  # each once
    # a and b are the anchors; c meets a twice and b once, d both once (tie: the earlier anchor), e only a, z only b, q nobody
    assert rows == [(1, "a", "a", 0, 3), (1, "a", "c", 1, 2), (1, "a", "d", 1, 1), (1, "a", "e", 1, 1), (2, "b", "b", 0, 3), (2, "b", "z", 1, 1), (3, C.REMAINDER, "q", None, 1)]


def test_owners_spread_in_rounds(spark):
    chain = spark.createDataFrame([(1, "a; b"), (2, "a"), (3, "b; c"), (4, "c; d"), (5, "d; e"), (6, "x; y")], "id int, keywords string")
    assert members(chain, 1) == [(1, "a", "a", 0, 2), (1, "a", "b", 1, 2), (1, "a", "c", 2, 2), (1, "a", "d", 3, 2), (1, "a", "e", 4, 1),
                                 (2, C.REMAINDER, "x", None, 1), (2, C.REMAINDER, "y", None, 1)]
    assert members(chain.limit(0), 3) == []


def test_rounds_shuffle_no_keywords_of_all_posts_for_few_owners(spark, monkeypatch):
    rows = [(i, f"k{i}; k{i + 1}") for i in range(4)] + [(90, "k0"), (91, "k0; m"), (91, "m; n"), (None, "n; o"), (92, None)]
    rows += [(1000 + i, f"{i * 7919 ** 3 % 10 ** 12}x") for i in range(5000)]  # more bytes than Spark is let broadcast below
    posts = spark.createDataFrame(rows, "id int, keywords string")
    plans, write = [], C.materialize

    def told(df, name="stage"):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(C, "materialize", told)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        want = members(posts, 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r[3] for r in want} == {None, *range(4)} and len(want) == 5008
    rounds = [p for name, p in plans if name in ("near-posts", "owners")]
    assert len(rounds) >= 4 and not [p for p in rounds if "SortMergeJoin" in p or "ShuffledHashJoin" in p]
    monkeypatch.setattr(C, "HELD", 0)  # every round writes what is still free
    assert members(posts, 2) == want and [name for name, _ in plans].count("free-keywords") == 4


def test_store_holds_all_keywords_in_chunks(spark):
    cats = sorted((c.ord, c.chunk_no, c.name, list(c.related_keywords), c.n_keywords) for c in C.build_categories(_ref(spark), n=2, chunk=3).collect())
    assert cats == [(1, 0, "a", ["a", "c", "d"], 3), (1, 1, "a", ["e"], 1), (2, 0, "b", ["b", "z"], 2), (3, 0, C.REMAINDER, ["q"], 1)]
    told = {c.ord: c.description for c in C.build_categories(_ref(spark), n=2).collect()}
    assert told[1] == "Posts about a and related topics (3 posts)"


def test_only_posts_without_keywords_stay_without_category(spark):
    ref = _ref(spark)
    out = {r.id: (r.primary_category, r.secondary_category) for r in C.assign_categories(ref, C.category_members(ref, 2)).collect()}
    assert out == {1: ("a", "b"), 2: ("a", "b"), 3: ("a", ""), 4: ("", ""), 5: ("", ""), 6: ("b", ""), 7: (C.REMAINDER, "")}


def test_store_round_trip(spark, tmp):
    SC.sink_categories_json(C.build_categories(_ref(spark), n=2, chunk=1), f"{tmp}/s")
    back = SC.scan_categories(spark, f"{tmp}/s", lines=True)
    assert sorted((r.ord, r.chunk_no, r.related_keywords[0]) for r in back.collect()) == [(1, 0, "a"), (1, 1, "c"), (1, 2, "d"), (1, 3, "e"), (2, 0, "b"), (2, 1, "z"), (3, 0, "q")]
    with open(f"{tmp}/one.json", "w") as f:
        f.write('{\n "categories": [{"name": "n1", "description": "d", "related_keywords": ["k"]},\n {"name": "n2", "description": "d", "related_keywords": []}]\n}')
    assert [(r.ord, r.name) for r in SC.scan_categories(spark, f"{tmp}/one.json").orderBy("ord").collect()] == [(1, "n1"), (2, "n2")]


def test_assign_every_post_once(spark):
    ref = _ref(spark)
    cats = spark.createDataFrame([(1, "A", "d", ["a", "b"]), (2, "B", "d", ["b", "c", "z"]), (3, "C", "d", ["a"])],
                                 "ord int, name string, description string, related_keywords array<string>")
    out = {r.id: (r.primary_category, r.secondary_category) for r in C.assign_categories(ref, cats).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5, 6, 7]
    assert out[1] == ("A", "B")       # A: a,b (2)  B: b,c (2) -> tie, lower ord first
    assert out[6] == ("B", "A")       # B: b,z (2)  A: b (1)
    assert out[4] == ("", "") and out[5] == ("", "") and out[7] == ("", "")
    fan = C.keyword_categories(ref, cats).where("post_id = 1 and keyword = 'a'").count()
    assert fan == 2  # 'a' sits in two categories: many-to-many


def test_top_keywords_rule(spark):
    docs = spark.createDataFrame([(1, "Apple apple banana the"), (2, "banana cherry"), (3, "cherry cherry date")], "doc_id bigint, text string")
    top = {(r.doc_id, r.rank): r.keyword for r in K.top_keywords(docs, k=2).collect()}
    assert top[(1, 1)] == "apple"         # tf 2 x ln(3/1)
    assert "the" not in top.values()      # stop word
    assert top[(3, 1)] == "cherry" or top[(3, 1)] == "date"


def test_top_keywords_leave_out_what_cannot_be_among_the_best(spark):
    from boardsmith.operators import keywords as K

    texts = [(i if i % 9 else None, None if i == 50 else " ".join(["common"] * (1 + i % 3) + [f"{chr(97 + i % 7)}mid", f"{chr(97 + i % 26)}{chr(97 + i // 26)}rare", "the", "zzstop"] * (1 + i % 2)))
             for i in range(120)]
    docs = spark.createDataFrame(texts + texts[:9], "doc_id int, text string")
    stop = spark.createDataFrame([("the",), ("zzstop",), (None,)], "token string")
    want = sorted(map(tuple, K.top_keywords(docs, k=2, stop=stop, common=0).collect()), key=str)  # a stop list above ``common``: nothing is left out
    for common in (3, 5, 10, 1000):
        assert sorted(map(tuple, K.top_keywords(docs, k=2, stop=stop, common=common).collect()), key=str) == want
    # Of a document's words only those that may be among its best reach the join.
    import pyarrow as pa

    class Shared:
        value = (["common"], [90], ["the"])

    words = ["common"] * 3 + ["rarea", "rareb"] + ["the"] * 9
    batch = pa.RecordBatch.from_pydict({"doc_id": [7, 8, 9], "t": pa.array([words, None, ["rareb"] * 2], pa.list_(pa.string()))})
    told = [tuple(r.values()) for out in K._candidates(Shared, 100, 4, 2, 0.0)(iter([batch])) for r in out.to_pylist()]
    assert sorted(told) == [(7, "rarea", 1), (7, "rareb", 1), (9, "rareb", 2)]
