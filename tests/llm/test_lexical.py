"""Ranked lexical search against the formula worked out document by document."""

import math
import random
import re
from collections import Counter

import pytest

from boardsmith.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    held = [h for h in held if h[2]]
    n_docs, n_terms = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in held:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=repr)


def found(spark, docs, items, k):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id bigint, text string, score int, item string")
    i = spark.createDataFrame([(*r, 0.5) for r in items], "item_id bigint, text string, rank double")
    return sorted((tuple(r) for r in lexical.search(d, i, k).collect()), key=repr)


def test_terms_are_the_stated_pattern():
    for text in ("A-b_c d9É x\x7f y{z}[~]`@Z", "", "...", "İ ß 漢字,kana"):
        assert [t.decode() for t in lexical.terms(text.encode())] == terms(text)


def words(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


VOCABULARY = ["the", "of", "a"] * 40 + [f"w{i}" for i in range(300)] + ["É", "漢字"]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many bands, buckets and blocks of items
        monkeypatch.setattr(lexical, "BUCKET_ROWS", 7)
        monkeypatch.setattr(lexical, "SHARD_ROWS", 20)
        monkeypatch.setattr(lexical, "HELD_VALUES", 300)
        monkeypatch.setattr(lexical, "BLOCK_BYTES", 1500)
    rng = random.Random(5)
    docs = [(i, words(rng, rng.choice([1, 3, 10, 60, 200]))) for i in range(250)]
    items = [(i, words(rng, rng.choice([2, 8, 25]))) for i in range(12)]
    docs += [(300 + i, items[0][1] + " " + words(rng, 5)) for i in range(30)]  # passages of an item
    docs += [(400, "copy of w1"), (401, "copy of w1"), (401, "copy of w1"), (None, "copy of w1"), (402, None), (403, ""), (404, ",;"), (405, "w2 " * 40_000)]
    items += [(20, "w1 w1 copy"), (20, "w1 w1 copy"), (21, None), (22, "unheard-of"), (None, "W2 É"), (23, "the of a")]
    assert found(spark, docs, items, 5) == brute(docs, items, 5)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")], 3) == []
    assert found(spark, [(1, "a b")], [], 3) == []
    assert found(spark, [(1, None)], [(1, "a")], 3) == []
