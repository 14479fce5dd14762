"""Call ledger, vector hook, classification replies, phrases, compounds."""

import os

import numpy as np
from pyspark.sql import functions as F

from boardsmith import workflows as W
from boardsmith.operators import classify as CL
from boardsmith.operators import keywords as K
from boardsmith.operators import ledger as L
from boardsmith.operators import rules as RU
from boardsmith.operators.phrases import phrase_replace
from boardsmith.operators.vector_hook import hook_vectors


def logged(folder, fn):
    """``fn`` that leaves a mark for each call."""
    os.makedirs(folder, exist_ok=True)

    def call(batch_id, prompt):
        with open(os.path.join(folder, f"{batch_id}"), "a") as f:
            f.write("x")
        return fn(batch_id, prompt)

    return call


def marks(folder):
    return {int(f): len(open(os.path.join(folder, f)).read()) for f in os.listdir(folder)}


def test_ledger_asks_once_retries_and_keeps_what_is_stored(spark, tmp):
    prompts = spark.createDataFrame([(i, f"prompt {i % 10}") for i in range(20)] + [(99, "bad"), (100, None)], "batch_id bigint, prompt string")

    def fn(_, prompt):
        if prompt == "bad":
            raise RuntimeError("no")
        return f"re: {prompt}"

    first, second = os.path.join(tmp, "a"), os.path.join(tmp, "b")
    path = os.path.join(tmp, "ledger")
    rows = {r.batch_id: tuple(r)[1:] for r in L.enrich_with_ledger(prompts, logged(first, fn), path, attempts=3, wave_rows=4).collect()}
    assert rows[3] == rows[13] == ("re: prompt 3", None, 1) and rows[99] == (None, "RuntimeError: no", 3) and len(rows) == 22
    assert marks(first) == {**{i: 1 for i in range(10)}, 99: 3, 100: 1}  # equal prompts are one call, by the smallest batch
    again = {r.batch_id: tuple(r)[1:] for r in L.enrich_with_ledger(prompts, logged(second, fn), path, attempts=1).collect()}
    assert marks(second) == {99: 1} and again[3] == rows[3] and again[99][2] == 4
    other = L.enrich_with_ledger(prompts.where("batch_id < 2"), fn, path, version="v2").collect()
    assert {r.n_calls for r in other} == {1}  # another version of the hook has its own calls
    assert L.enrich_with_ledger(prompts.limit(0), fn, os.path.join(tmp, "none")).collect() == []


def test_vectors_of_a_failing_batch_are_isolated(spark):
    def load():
        def encode(texts):
            if any("bad" in t for t in texts):
                raise ValueError("bad text")
            return [[float(len(t)), 1.0] if "short" not in t else [1.0] for t in texts]

        return encode

    df = spark.createDataFrame([(i, f"text {i}") for i in range(30)] + [(50, "bad"), (51, None), (52, "short"), (53, "")], "id bigint, content string")
    rows = {r.id: (r.content_vector, r.vector_error) for r in hook_vectors(df, load, 2).collect()}
    assert len(rows) == 34 and rows[7] == ([6.0, 1.0], None) and rows[53] == ([0.0, 1.0], None)
    assert rows[50] == (None, "ValueError: bad text") and rows[51] == (None, None) and rows[52][0] is None and "shape" in rows[52][1]
    assert hook_vectors(df, load, 2).schema["content_vector"].dataType.simpleString() == "array<float>"


def test_search_with_the_callers_model(spark):
    refined = spark.createDataFrame([(1, "apple apple", "c"), (2, "pear", None), (3, "apple pear", "d")], "id bigint, content string, comments string")
    q = spark.createDataFrame([(10, "pear pear"), (11, "apple")], "query_id bigint, text string")
    load = lambda: lambda texts: np.array([[t.count("apple") + 0.01, t.count("pear") + 0.01] for t in texts])
    hits, ctx = W.search_posts(refined, q, k=1, dims=2, load=load)
    assert {(r.query_id, r.id) for r in hits.collect()} == {(10, 2), (11, 1)} and ctx.count() == 2


def test_classify_replies(spark):
    refined = spark.createDataFrame([(1, "a; b"), (2, None), (3, " ;"), (4, "cut"), (5, "odd"), (6, "fail"), (7, "part")], "id bigint, keywords string")
    cats = spark.createDataFrame([(1, "A"), (2, "B")], "ord int, name string")

    def fn(_, prompt):
        assert "가능한 카테고리:\nA, B" in prompt
        if "fail" in prompt:
            raise RuntimeError
        if "odd" in prompt:
            return '{"primary_category": "Z", "secondary_category": ""}'
        if "part" in prompt:
            return '{"primary_category": "A"}'
        return '{"primary_category": "B", "secondary_category": "A"}' + (" x" if "cut" in prompt else "")

    out, rejects = CL.classify_posts(refined, cats, fn)
    got = {r.id: (r.primary_category, r.secondary_category) for r in out.collect()}
    assert got == {1: ("B", "A"), 2: ("", ""), 3: ("", ""), 4: ("", ""), 5: ("Z", ""), 6: ("", ""), 7: ("A", "")}
    assert {(r.id, r.reject_reason) for r in rejects.collect()} == {(4, "undecodable"), (5, "unknown_category"), (6, "failed_call"), (7, "missing_key")}


LEX = [("new york", "NY"), ("new york city", "NYC"), ("york", "Y"), ("city hall", "CH"), ("a", "1"), ("a", "2"), ("x  y", "XY"), ("big apple pie", "BAP"), (None, "n"), ("void", None)]
TEXTS = [("new york city hall", "NYC hall"), ("New York cit", "NY cit"), ("new  york", "new  Y"), ("big apple", "big apple"), ("big apple pie", "BAP"), ("a b a", "1 b 1"), ("x y", "XY"),
         ("city hall york", "CH Y"), ("", ""), (None, None), (" ", " "), ("void", "void"), ("new new york york", "new NY Y")]


def test_phrases_leftmost_longest(spark):
    df = spark.createDataFrame([(i, t, "z") for i, (t, _) in enumerate(TEXTS)], "id int, t string, word string")
    lex = spark.createDataFrame(LEX, "word string, replacement string")
    for block in (1 << 20, 150):  # one trie, several
        got = {r.id: r.out for r in phrase_replace(df, "t", lex, "out", block_bytes=block).collect()}
        assert got == {i: want for i, (_, want) in enumerate(TEXTS)}
    assert [r.out for r in phrase_replace(df, "t", lex.limit(0), "out").orderBy("id").collect()] == [t for t, _ in TEXTS]
    assert phrase_replace(df, "t", lex, "out").columns == ["id", "t", "word", "out"]


def test_no_word_is_shuffled(spark):
    df = spark.createDataFrame([(1, "a b")], "id int, t string")
    plan = RU.lexicon_replace(df, "t", spark.createDataFrame([("a", "b")], "word string, replacement string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_tendency_counts(spark):
    rows = [("How is it? Why", 3 + 1 + 1 + 1), ("I had my doubts", -3), ("어떻게 했어요? 궁금", 1 - 1 + 3 + 2), ("can't cannot can", 1), (None, 0), ("", 0)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    assert [r.s for r in df.select("i", RU.tendency_score("t").alias("s")).orderBy("i").collect()] == [s for _, s in rows]


def test_compounds(spark):
    texts = ["machine learning works"] * 30 + ["acme corp sells"] * 30 + [f"random{chr(97 + i % 26)}x word{chr(97 + i * 7 % 26)}y" for i in range(60)] + ["big tax relief"] * 30
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    names = spark.createDataFrame([("Acme",), ("Tax Relief",)], "name string")
    stop = spark.createDataFrame([("big tax",)], "term string")
    got = {r.term for r in K.compound_keywords(df, names=names, stop=stop).collect()}
    assert "machine learning" in got and "corp sells" in got
    assert not {"acme corp", "tax relief", "big tax"} & got
    assert K.compound_keywords(df.limit(0)).collect() == [] and df.select(F.lit(1)).count() == 150


def test_hooks_and_scans_take_a_batch_in_small_pieces(monkeypatch):
    import pyarrow as pa

    from boardsmith.llm import secret_scan
    from boardsmith.operators import enrich, ledger

    n, text = 1000, "token = abcdefgh1234 " * 400  # 8 MB in one Arrow batch
    batch = pa.RecordBatch.from_pydict({"batch_id": list(range(1, n + 1)), "prompt": [text] * n, "digest": ["d"] * n})
    kept = {}

    class Rows:
        columns, schema, sparkSession = ["batch_id", "prompt"], None, None

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            kept["run"] = run

    monkeypatch.setattr(secret_scan, "prepare", lambda _: None)
    enrich.enrich_batches(Rows(), enrich.echo)
    runs = [kept["run"], ledger._called(lambda _, p: p, 2)]
    secret_scan.redact(Rows(), "prompt")
    for run in [*runs, kept["run"]]:
        out = list(run(iter([batch if run is runs[1] else batch.select([0, 1])])))
        assert sum(b.num_rows for b in out) == n and max(b.nbytes for b in out) < 5_000_000


def test_a_large_lexicon_is_joined_and_not_held_by_tasks(spark, monkeypatch):
    from boardsmith.operators import phrases as P

    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "X  a B"), (2, None), (3, ""), (4, "b c a b")], "id int, t string")
    lex = spark.createDataFrame([("a b", "<ab>"), ("A  b", "<Ab>"), ("b c a", "<bca>"), ("x", "<x>"), ("  ", "<none>"), (None, "n")], "word string, replacement string")
    want = sorted(phrase_replace(df, "t", lex, "out").collect(), key=str)

    def refused(_):
        raise AssertionError("the whole lexicon went into a trie")

    monkeypatch.setattr(P, "trie", refused)
    assert sorted(phrase_replace(df, "t", lex, "out", block_bytes=10).collect(), key=str) == want
