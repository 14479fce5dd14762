"""Mixing: sizes, targets by plain water-filling in fractions, shares near their targets, reruns."""

import re
from collections import defaultdict
from fractions import Fraction

from boardsmith.llm import mixing

COLUMNS = ("doc_id", "source", "size", "source_size", "target", "taken")


def plain_targets(total_by_source, weights=mixing.WEIGHTS, most=mixing.MOST):
    names = sorted((s for s in total_by_source if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in total_by_source)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(total_by_source.values()), set()
    while True:
        left = total - sum(most * total_by_source[s] for s in stopped)
        among = sum(weight[s] for s in names if s not in stopped)
        share = {s: Fraction(most * total_by_source[s]) if s in stopped else Fraction(weight[s] * left, among) for s in names}
        over = {s for s in names if share[s] > most * total_by_source[s]}
        if not over:
            return share
        stopped |= over


def check(spark, docs, packet=mixing.PACKET):
    rows = [tuple(r) for r in mixing.mix(docs, packet=packet).select(*COLUMNS).collect()]
    told = docs.select("doc_id", "source", "text").collect()
    size_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r[:3] for r in rows), key=repr) == sorted(((d["doc_id"], d["source"], size_of(d["text"])) for d in told), key=repr)
    own = defaultdict(int)
    for d in told:
        own[d["source"]] += size_of(d["text"])
    want, taken = plain_targets(own), defaultdict(int)
    for _, source, size, source_size, target, got in rows:
        assert source_size == own[source] and abs(target - float(want[source])) <= 1e-9 * max(1, target)
        assert 0 <= got <= mixing.MOST * size
        taken[source] += got
    total = sum(own.values())
    assert sum(taken.values()) <= total
    for s, t in want.items():
        assert abs(taken[s] - t) <= packet + 1, (s, taken[s], float(t))
    assert sorted(rows, key=repr) == sorted((tuple(r) for r in mixing.mix(docs, packet=packet).select(*COLUMNS).collect()), key=repr)
    return rows


def test_whole_table(spark, sf):
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"))


def test_many_parts_and_spans(spark, sf, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 3)
    monkeypatch.setattr(mixing, "SPAN_WORDS", 500)
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"))


def test_stops_and_reshares(spark):
    """A small heavy source stops at three times its size; what it leaves is shared by weight, in several rounds."""
    rows = [(i, "w " * 300, "b") for i in range(30)] + [(100, "x y z", "a"), (101, "q " * 50, "c"), (102, "r " * 900, "d"), (103, "s " * 40, None), (104, None, "e"), (105, " \t", "e")]
    rows += [(0, "w " * 300, "b"), (None, "n " * 20, "b"), (7, "été " * 7000, "é"), (8, "z" * 100_000, "é")]
    docs = spark.createDataFrame([(*r, 1.0, 7) for r in rows], "doc_id bigint, text string, source string, target double, size int")
    out = check(spark, docs, packet=16)
    assert all(taken == 3 * size for _, s, size, _, _, taken in out if s == "a")
    assert [r[4] for r in out if r[1] == "e"] == [0.0, 0.0]


def test_schedule_is_one_gapless_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted(mixing.schedule(mixing.queue(docs)).collect(), key=lambda r: r["offset"])
    at, seen = 0, set()
    for a, b in zip(rows, rows[1:]):
        assert (a["finish"], a["source_rank"]) <= (b["finish"], b["source_rank"])
    for r in rows:
        assert r["offset"] == at and r["taken"] > 0
        at += r["taken"]
        seen.add((r["source_rank"], r["start"], r["pass"], r["packet"]))
    assert len(seen) == len(rows)


def test_nothing_to_mix(spark, odd):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix(docs).collect() == []
    docs = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id bigint, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in mixing.mix(docs).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    check(spark, odd.selectExpr("doc_id", "text", "label AS source", "score"))
