"""The corpus pipeline against plain stages, over a few documents."""

import random
from collections import defaultdict

import public_tokenizers

import brute
import corpus_pipeline
from boardsmith.llm import packing
from corpus_pipeline import REPEATED_BYTES, STAGES, TOKENIZER

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_near(rows):
    groups = defaultdict(list)
    for i, (_, _, top, _) in enumerate(brute.near([(i, t) for i, (_, t) in enumerate(rows)], 5, 4, 5)):
        groups[top].append(i)
    return [rows[min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))] for g in groups.values()]


def plain_cut(rows):
    texts, n = [t for _, t in rows], REPEATED_BYTES
    seen = [t[i:i + n] for t in texts for i in range(len(t) - n + 1)]
    out = []
    for d, t in rows:
        gone = {i + k for i in range(len(t) - n + 1) if seen.count(t[i:i + n]) > 1 for k in range(n)}
        out.append((d, "".join(c for i, c in enumerate(t) if i not in gone)))
    return out


def test_run_equals_plain_stages(spark, tmp, monkeypatch):
    rng = random.Random(12)

    def prose(n):
        return " ".join(rng.choice(["the", "and", "of"]) if i % 4 == 0 else f"w{rng.randrange(10**6)}" for i in range(n))

    x, y, z, v, passage = prose(60), prose(60), prose(60), prose(60), prose(40)
    rows = [(5, x), (5, x), (None, x + " end"), (3, y), (6, y + " end"), (6, z), (None, v), (None, v), (8, "too short"), (9, None),
            (10, prose(50) + " " + passage + " " + prose(50)), (11, prose(50) + " " + passage + " " + prose(50)),
            (12, prose(30) + " password: hunter2hunter2 " + prose(30))]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA)
    df.write.parquet(f"{tmp}/documents.parquet")
    left = plain_cut(plain_near([r for r in rows if not brute.quality(r[1])[-1]]))
    left = [(d, brute.ASSIGN.sub("[ASSIGN]", t)) for d, t in left]
    assert len(left) == 7 and all(len(t) > 300 for _, t in left) and sum("[ASSIGN]" in t for _, t in left) == 1

    seen = []
    (name, last) = STAGES[-1]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*STAGES[:-1], (name, lambda *args: (seen.append(args[1]), last(*args))[1])])
    got = corpus_pipeline.run(spark, tmp).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in seen[0].collect()), key=repr) == sorted(left, key=repr)
    want = packing.pack(spark.createDataFrame(left, "doc_id bigint, text string"), public_tokenizers.path(TOKENIZER)).collect()
    assert {(p["doc_id"], p["doc_tokens"]) for p in got} == {(p["doc_id"], p["doc_tokens"]) for p in want}
    assert sum(p["length"] for p in got) == sum(p["length"] for p in want)


def test_stages_keep_columns_and_take_no_rows(spark, tmp):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in STAGES[:-1]:
        assert stage(spark, empty, tmp).columns == empty.columns
    empty.write.parquet(f"{tmp}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp).count() == 0
