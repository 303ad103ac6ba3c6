"""Metric trees and product codes against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import metric_tree, vector_codes
from dimflow.llm.metric_tree import Tree

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute_nearest(points, entries):
    far = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e, strict=True)) for e in entries] for p in points]
    codes = [row.index(min(row)) for row in far]
    return codes, [min(row) for row in far]


def clustered(seed, n, d, groups, spread, scale=1024):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    points = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, d)) * spread
    return np.floor(points * scale).astype(np.int64)


@pytest.mark.parametrize(
    "points",
    [
        clustered(1, 700, 4, 12, 0.02),
        clustered(2, 500, 3, 500, 0.5),
        clustered(3, 300, 2, 5, 0.5, scale=2),  # many ties
        np.repeat(clustered(4, 20, 4, 5, 0.1), 40, axis=0),  # copies
        np.zeros((90, 3), np.int64),
        clustered(5, 200, 4, 6, 0.2, scale=2.0**25),
        clustered(6, 1, 4, 1, 0.1),
    ],
)
def test_tree_assigns_as_brute_force(points):
    tree = Tree.from_bytes(Tree.build(points.astype("<i4")).to_bytes())
    assert sorted(tree.place.tolist()) == list(range(len(points)))
    for entries in (points[:40], np.concatenate([points[:9], points[:9], points[-3:]]), points[:1]):
        codes, counts, sums = tree.nearest(entries)
        want, _ = brute_nearest(points, entries)
        got = np.empty(len(points), int)
        got[tree.place] = codes
        assert got.tolist() == want
        assert counts.tolist() == np.bincount(want, minlength=len(entries)).tolist()
        for e in range(len(entries)):
            assert sums[e].tolist() == points[got == e].sum(axis=0).tolist()


def test_balls_hold_their_points():
    points = clustered(7, 900, 5, 9, 0.1)
    tree = Tree.build(points.astype("<i4"))
    for i in range(len(tree.first)):
        mine = tree.points[tree.first[i] : tree.last[i]]
        assert (np.sqrt(np.square(mine - tree.centre[i]).sum(axis=1)) <= tree.radius[i] * (1 + 1e-9)).all()
        assert mine.sum(axis=0).tolist() == tree.total[i].tolist()
        if tree.left[i] >= 0:
            parts = sorted([(tree.first[c], tree.last[c]) for c in (tree.left[i], tree.right[i])])
            assert parts[0][0] == tree.first[i] and parts[0][1] == parts[1][0] and parts[1][1] == tree.last[i]
    assert (tree.last - tree.first)[tree.left < 0].max() <= metric_tree.LEAF


def test_whole_balls_are_owned(monkeypatch):
    """Tight groups go to their entries by cached sums: few points are looked at."""
    points = clustered(8, 4000, 8, 16, 0.001)
    looked = []
    near = metric_tree.squared
    monkeypatch.setattr(metric_tree, "squared", lambda p, e: looked.append(len(p)) or near(p, e))
    tree = Tree.build(points.astype("<i4"))
    tree.nearest(points[:: len(points) // 16][:16])
    assert sum(looked) < len(points) / 2


def brute(rows, scale=1024, parts=4, entries=256, rounds=4):
    kept = [
        (k, [math.floor(max(-(2.0**27), min(2.0**27, scale * x))) for x in v], c)
        for k, v, c in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]

    def by_key(row):
        return row[0] is None, row[0] or 0, np.array(row[1], "<i4").tobytes()

    fitting = sorted((r for r in kept if len(r[1]) % parts == 0), key=by_key)
    if not fitting:
        return [], []
    size = len(fitting[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    width = size // parts
    cut = [np.array([r[1][p * width : (p + 1) * width] for r in kept], object) for p in range(parts)]
    start = [r[1] for r in fitting if len(r[1]) == size][:entries]
    books = [np.array([v[p * width : (p + 1) * width] for v in start], object) for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            codes, _ = brute_nearest(cut[p], books[p])
            for e in set(codes):
                mine = [x for x, c in zip(cut[p], codes, strict=True) if c == e]
                books[p][e] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    found = [brute_nearest(cut[p], books[p]) for p in range(parts)]
    out = []
    for i, (key, _, label) in enumerate(kept):
        code = "".join(f"{found[p][0][i]:02x}" for p in range(parts))
        out.append((key, None if label is None else str(label), code, sum(found[p][1][i] for p in range(parts))))
    return out, books


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0 if i != 1 else x or "") for i, x in enumerate(r)))


def coded(spark, held, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    table = table.withColumn("code", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("error", F.lit(2))
    codes, books = vector_codes.compress(table, held, **options)
    return codes, books


def make_rows(n, d, seed, groups=30):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    vectors = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, d)) * 0.1
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("chunk", [64, 16_384])
def test_against_brute_force(spark, held, monkeypatch, chunk):
    monkeypatch.setattr(vector_codes, "CHUNK", chunk)
    rows = make_rows(500, 16, 1)
    rows += [(500 + i, rows[7][1], 1) for i in range(150)] + rows[:20]  # copies, repeated rows
    rows += [
        (900, None, 1), (901, [], 1), (902, [math.nan] * 16, 0), (903, [math.inf] + [0.0] * 15, 0),
        (904, [None] + [0.1] * 15, 0), (905, [0.1] * 16, None), (906, [-0.1] * 16, None),
        (None, [0.2] * 16, 1), (907, [0.0] * 16, 0), (908, [0.1] * 8, 0), (-5, [0.1] * 15, 2),
        (909, [1e30, -1e30] + [5e3] * 14, 1),
    ]
    codes, books = coded(spark, held, rows, entries=40)
    want, want_books = brute(rows, entries=40)
    assert ordered(tuple(r) for r in codes.collect()) == ordered(want)
    assert [b.tolist() for b in books] == [b.tolist() for b in want_books]
    errors = {r["label"]: r["label_error"] for r in vector_codes.label_errors(codes).collect()}
    assert errors == {c: sum(r[3] for r in want if r[1] == c) for c in {r[1] for r in want}}
    assert vector_codes.label_errors(codes).count() == len(want)


def test_fewer_vectors_than_entries(spark, held):
    rows = make_rows(9, 8, 2)
    codes, books = coded(spark, held, rows)
    want, _ = brute(rows)
    assert ordered(tuple(r) for r in codes.collect()) == ordered(want)
    assert [len(b) for b in books] == [9] * 4


def test_empty_and_unfit_tables(spark, held):
    for rows in ([], [(1, None, 1), (2, [math.nan] * 4, 1)], [(1, [0.1] * 3, 1)]):
        codes, books = coded(spark, held, rows)
        assert codes.count() == 0 and books == []
        assert vector_codes.label_errors(codes).count() == 0
        assert len(vector_codes.books_digest(books)) == 64
