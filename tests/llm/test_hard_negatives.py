"""Hard negatives against all products worked out one by one."""

import math
import random

import numpy as np
import pytest

from boardsmith.llm import hard_negatives as H


def brute(rows, every=50, positives=5, negatives=3):
    kept = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        row = (str(label), [math.floor(256 * x) for x in vec])
        kept[i] = min(kept.get(i, row), row)
    out = []
    for a, (label, vec) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vec, v)), i, own == label) for i, (own, v) in kept.items() if i != a and len(v) == len(vec))
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            fit = [(-s, i) for s, i, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(a, pid, rank, i, -p, s) for rank, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, label int, embedding array<double>, rank int, score string")
    return sorted(tuple(r) for r in H.mine(df, **kw).collect())


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many ranges, blocks and cells
        monkeypatch.setattr(H, "BLOCK_ROWS", 8)
        monkeypatch.setattr(H, "RANGE_ROWS", 100)
        monkeypatch.setattr(H, "CELL_ROWS", 90)
        monkeypatch.setattr(H, "CELL_ANCHORS", 3)
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, i % 4, [c + rng.gauss(0, 0.6) for c in centres[i % 4]]) for i in range(400)]
    rows += [(500 + i, 1, [1.0, 0.0, 0.5, 0.0, 0.0, 0.25]) for i in range(60)]  # one vector many times
    rows += [(600, 7, [1.0] * 6), (650, 2, [1.0, 2.0]), (651, 3, [1.0, 1.5]), (652, 2, [2.0, 2.0]), (700, 1, [0.0] * 6), (701, 1, []), (750, 2, [])]
    rows += [(800, None, [1.0] * 6), (None, 1, [1.0] * 6), (801, 1, None), (802, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (803, 1, [math.nan] * 6), (850, 1, [math.inf] + [1.0] * 5)]
    rows += [(0, 0, rows[0][2]), (4, 1, [9.0] * 6)]  # repeated ids
    assert found(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, 1, [1.0]), (51, 2, [1.0])]) == []


def test_huge_components_do_not_overflow(spark):
    rows = [(50, 1, [2.0**30, 3.0]), (51, 1, [2.0**10, 1.0]), (52, 2, [2.0**10 * 0.9, 0.0]), (53, 1, [1e300, 1.0])]
    assert (50, 51, 1, 52) in [r[:4] for r in found(spark, rows, positives=2)]


def test_hilbert_neighbours_are_one_step_apart():
    bits, dims = 3, 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = H.hilbert(grid, bits)
    assert sorted(key.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-300, 300, (20, 7)), rng.integers(-300, 300, (50, 7))
    low, high = H.interval_bounds(a, b.min(0)[None], b.max(0)[None])
    s = H.products(a, b)
    assert (s == a @ b.T).all() and (s >= low).all() and (s <= high).all()
    wide = np.array([[2**40, 2**39]])
    assert H.products(wide, np.array([[2**20, 1]]))[0, 0] == 2**60 + 2**39
