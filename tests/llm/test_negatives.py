"""Hard negatives against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from authwatch.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score int, place int, cell int"


def brute(rows, every, positives=5, k=10, low=30, high=90):
    whole = [(i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, label, v in rows
             if i is not None and label is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    found = set()
    anchors = {}
    for row in sorted(whole, key=lambda r: r[1:]):
        anchors.setdefault(row[0], row)
    for anchor, label, vector in (r for r in anchors.values() if r[0] % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=False)), i, own == label)
                        for i, own, v in whole if i != anchor)
        for score, i, same in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2]
                   and -low * score <= -100 * s[0] <= -high * score][:k]
            found |= {(anchor, i, n + 1, s[1], -score, -s[0]) for n, s in enumerate(fit)}
    return sorted(found)


def mined(spark, rows, every, parts=5, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(parts)
    got = hard_negatives.mine(df, F.col("vec_id") % every == 0, **options).collect()
    return sorted(map(tuple, got))


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_loops(spark, monkeypatch, seed):
    rng = random.Random(seed)
    # Few values, so scores tie often; a label with half of the rows; negative scores too.
    rows = [(n, rng.choice([0, 0, 0, 1, 2, 3]), [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0])
                                                for _ in range(6)]) for n in range(300)]
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "ROWS", 40)
    monkeypatch.setattr(hard_negatives, "SCORES", 50)
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_other_shares_and_counts(spark):
    rng = random.Random(9)
    rows = [(n, n % 3, [rng.uniform(-1, 1) for _ in range(8)]) for n in range(200)]
    options = {"positives": 3, "k": 4, "low": 0, "high": 75}
    assert mined(spark, rows, 20, **options) == brute(rows, 20, **options)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.5]), (3, 2, [0.5]),
            (4, 2, []), (5, None, [1.0, 1.0]), (6, 2, None), (7, 2, [nan, 1.0]), (8, 2, [inf, 1.0]),
            (9, 2, [0.5, None]), (None, 2, [0.5, 0.5]), (11, 2, [0.4, 0.5, 9.0]),
            (12, 1, [0.0, 0.0]), (100, 3, [])]
    want = brute(rows, 10)
    assert mined(spark, rows, 10) == want and want
    assert mined(spark, [], 10) == []
    assert mined(spark, rows[1:3], 10) == []


def test_repeated_rows_take_a_place_each(spark):
    rows = [(0, 1, [1.0]), (0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (2, 2, [0.5])]
    got = mined(spark, rows, 10)
    assert [(r[1], r[2], r[3]) for r in got] == [(1, 1, 2), (1, 2, 2)]


def test_large_components_are_exact_and_cut(spark):
    rows = [(0, 1, [3e5, 1.0]), (1, 1, [3e5, 1.0]), (2, 2, [2e5, 0.5]), (3, 2, [1e30, 0.0])]
    got = mined(spark, rows, 10)
    assert got == [r for r in brute(rows, 10) if r[3] == 2] and len(got) == 1
    left = np.array([[2.0 ** 40, 3.0]])
    assert hard_negatives.inner_products(left, left).tolist() == [[hard_negatives.LIMIT]]


def test_slots_take_what_lies_under_each_limit():
    limits = np.array([[100, 50, 50, hard_negatives.NONE, hard_negatives.NONE]])
    cell = hard_negatives.Cell(np.array([0]), np.array([1]), np.array([[1.0]]), limits,
                               np.array([5]), k=2)
    cell.add(np.arange(1, 9), np.full(8, 2), np.array([[101.0], [100], [60], [51], [50], [7], [6], [4]]))
    at, score = cell.best.at.tolist(), cell.best.score.tolist()
    assert at == [0, 0, 2, 2] and score == [100, 60, 50, 7]
