"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import negatives
from dimflow.llm.negatives import Best

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, is_anchor, scale=256, positives=5, most=10, low=30, high=90):
    part = [
        (k, [math.floor(max(-(2.0**400), min(2.0**400, scale * x))) for x in v], c)
        for k, v, c in rows
        if None not in (k, v, c) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, (key, vector, label) in enumerate(part):
        if not is_anchor(key):
            continue
        scored = [
            (-max(-(2**62), min(2**62, sum(x * y for x, y in zip(vector, v, strict=True)))), k, c == label)
            for j, (k, v, c) in enumerate(part)
            if j != i and len(v) == len(vector)
        ]
        scored.sort()
        for less, positive, _ in [s for s in scored if s[2]][:positives]:
            inside = [
                s for s in scored if not s[2] and low * -less <= 100 * -s[0] <= high * -less
            ]
            for rank, (minus, negative, _) in enumerate(inside[:most], 1):
                out.append((key, positive, rank, negative, -less, -minus))
    return sorted(out)


def mined(spark, held, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    table = table.withColumn("row", F.lit("clash")).withColumn("slot", F.lit(1)).withColumn("key", F.lit(2))
    found = negatives.mine(table, held, F.col("vec_id") % 10 == 0, F.col("label"), **options)
    return sorted(tuple(r) for r in found.collect())


def make_rows(n, d, labels, seed, spread=0.35):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d))
    label = rng.integers(0, labels, n)
    vectors = centres[label] * (rng.random((n, 1)) < 0.5) + rng.normal(size=(n, d)) * spread + 0.3
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, label, strict=True))]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, held, seed):
    rows = make_rows(400, 16, 4, seed)
    want = brute(rows, lambda k: k % 10 == 0)
    assert len(want) > 500
    assert mined(spark, held, rows) == want


def test_rounds_and_small_blocks(spark, held, monkeypatch):
    rows = make_rows(300, 8, 3, 3)
    for name, value in [("ROUND_BYTES", 20_000), ("ROWS", 16), ("ANCHORS", 4), ("FIRST_ROWS", 2), ("PENDING", 8)]:
        monkeypatch.setattr(negatives, name, value)
    assert mined(spark, held, rows) == brute(rows, lambda k: k % 10 == 0)


def test_copies_ties_and_one_hot_label(spark, held):
    """A third of the rows is one vector; scores tie, keys decide."""
    rng = random.Random(4)
    rows = make_rows(200, 8, 3, 4)
    one = [0.5, 0.5, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0]
    near = [0.4, 0.4, 0.4, 0.4, 0.0, 0.0, 0.0, 0.0]
    rows += [(200 + i, one, rng.choice([0, 0, 1])) for i in range(100)]
    rows += [(300 + i, near, rng.choice([0, 1, 2])) for i in range(50)]
    rows += rows[:40] + rows[200:220]  # repeated rows, anchors among them
    rng.shuffle(rows)
    assert mined(spark, held, rows) == brute(rows, lambda k: k % 10 == 0)


def test_odd_rows(spark, held):
    rows = make_rows(120, 4, 2, 5)
    rows += [
        (130, None, 1), (140, [], 1), (150, [0.0] * 4, 0), (160, [math.nan] * 4, 1),
        (170, [math.inf, 1.0, 1.0, 1.0], 1), (180, [None, 1.0, 1.0, 1.0], 0), (190, [0.5] * 4, None),
        (None, [0.5] * 4, 1), (200, [0.5, 0.5], 1), (201, [0.4, 0.4], 0), (202, [0.4, 0.45], 1),
        (210, [-0.5] * 4, 0), (211, [0.1, -0.9, 0.0, 0.1], 0), (220, [], 1), (221, [], 0),
    ]
    assert mined(spark, held, rows) == brute(rows, lambda k: k % 10 == 0)


def test_large_components_are_exact(spark, held):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e3, 2.0**20, 3e9, 2e17, -5e5]) * rng.random() for _ in range(3)], i % 2) for i in range(80)]
    rows += make_rows(60, 3, 2, 6)
    rows += [(i, [rng.random() * 2.0**14 for _ in range(3)], i % 2) for i in range(100, 130)]
    rows += [(1000, [1.0] * 3, 1), (1001, [1e308] * 3, 1), (1002, [1e308] * 3, 0), (1003, [0.5] * 3, 0)]
    got, want = mined(spark, held, rows), brute(rows, lambda k: k % 10 == 0)
    assert got == want


def test_no_anchor_no_rows(spark, held):
    assert mined(spark, held, []) == []
    assert mined(spark, held, [(1, [1.0], 1), (2, [1.0], 0)]) == []
    assert mined(spark, held, [(10, [1.0], 1)]) == []


def test_few_partners(spark, held):
    rows = [(10, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.8, 0.3], 0), (3, [0.2, 0.3], 0)]
    assert mined(spark, held, rows) == brute(rows, lambda k: k % 10 == 0) != []


def test_best_rejects_what_cannot_enter():
    best = Best(np.array([5]), 2)
    best.add(np.array([0, 0, 0]), np.array([7, 6, 6]), np.array([4, 9, 3]), np.array([0, 1, 2]))
    best.merge()
    assert [x.tolist() for x in best.kept[:3]] == [[0, 0], [7, 6], [4, 3]]
    assert best.least(3).tolist() == [6] and best.least(4).tolist() == [7]
