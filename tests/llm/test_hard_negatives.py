"""Hard negatives against a plain search over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, anchor_id string, r_part string"


def mined(rows, anchors, positives=5, negatives=3):
    """By the rule, over lists: (anchor, positive, rank, negative, scores)."""
    taken = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        key = (label, whole)
        if vec_id not in taken or key < taken[vec_id]:
            taken[vec_id] = key
    out = []
    for a, (label, vector) in taken.items():
        if a % anchors:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, w, strict=False)), b, other) for b, (other, w) in taken.items() if b != a]
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score]
            out += [(a, positive, k + 1, s[1], -score, -s[0]) for k, s in enumerate(inside[:negatives])]
    return sorted(out)


def result(spark, rows, anchors):
    df = spark.createDataFrame([(*row, "x", "x", "x", "x") for row in rows], SCHEMA)
    found = h.mine(h.usable_vectors(df, F.col("label")), F.col("id") % anchors == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def table(seed, n, size=6, labels=3):
    random_ = random.Random(seed)
    centres = [[random_.gauss(0, 0.3) for _ in range(size)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = random_.randrange(labels)
        rows.append((i, [0.2 + c + random_.gauss(0, 0.2) for c in centres[label]], label))
    return rows


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(h, "PART_ROWS", 40)
    monkeypatch.setattr(h, "PART_ANCHORS", 7)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_search(spark, seed, small_parts):
    rows = table(seed, 260)
    want = mined(rows, 10)
    assert len(want) > 50
    assert result(spark, rows, 10) == want


def test_ties_and_hot_rows(spark, small_parts):
    # A third of the rows are one vector, and many scores are equal or zero.
    rows = [(i, [0.5, 0.25, 0.0], 0) for i in range(80)] + [(100 + i, [0.25 * (i % 3), 0.25, 0.0], i % 4) for i in range(160)]
    rows += [(300 + i, [0.0, 0.0, 1.0], i % 2) for i in range(12)] + [(400, [0.0, 0.0, 0.0], 0), (401, [0.0, 0.0, 0.0], 1)]
    want = mined(rows, 20)
    assert any(row[4] == 0 for row in want)
    assert result(spark, rows, 20) == want


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(3, 40)
    rows += [(None, [1.0] * 6, 0), (1000, None, 0), (1010, [1.0] * 6, None), (1020, [None] + [1.0] * 5, 0), (1030, [nan] * 6, 0), (1040, [inf] * 6, 0)]
    rows += [(1050, [], 0), (1060, [0.5, 0.5], 0), (1070, [0.5] * 9, 1)]  # other lengths take part
    rows += [rows[0], (5, [9.0] * 6, 0), (5, [0.1] * 6, 2)]  # repeated ids count once
    assert result(spark, rows, 10) == mined(rows, 10)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e7, 1.0], 0), (1, [1e7, 2.0], 0), (2, [7e6, 1.0], 1), (3, [7e6, 1.5], 1), (4, [-1e7, 1.0], 1)]
    assert result(spark, rows, 10) == mined(rows, 10)
    huge = [(0, [3e30], 0), (1, [3e30], 0), (2, [1e30], 1)]
    assert result(spark, huge, 10) == []  # both scores are cut to the largest long, outside the window


def test_tables_without_pairs(spark):
    assert result(spark, [], 10) == []
    assert result(spark, [(0, [1.0], 0)], 10) == []
    assert result(spark, [(0, [1.0], 0), (1, [1.0], 0)], 10) == []
    assert result(spark, [(7, [1.0], 0), (8, [0.7], 1)], 10) == []
