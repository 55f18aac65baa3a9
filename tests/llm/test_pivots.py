"""Clustering with pivot distances against plain rounds."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import pivots


def plain(rows, clusters, rounds, dims, scale=256):
    """Every vector against every centroid, in Python integers."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    firsts = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in firsts[:clusters]]
    away = lambda v, p: sum((a - b) ** 2 for a, b in zip(v, p))
    near = lambda v: min(range(len(points)), key=lambda c: (away(v, points[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v), []).append(v)
        points = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else p for c, p in enumerate(points)]
    found = [(i, near(v), v) for i, v in kept]
    spread = {}
    for _, c, v in found:
        spread[c] = spread.get(c, 0) + away(v, points[c])
    total = sum(spread.values())
    top = pivots.LONGEST
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted((i, c, min(away(v, points[c]), top), min(spread[c], top), min(total, top), sha[c]) for i, c, v in found)


def run(spark, rows, **how):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("cluster", F.lit(9))
    return sorted(map(tuple, pivots.cluster(frame.repartition(3), **how).collect()))


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] + 0.2 * rng.normal(size=6)).tolist()) for i in range(300)]
    how = dict(dims=6, clusters=9, rounds=4, pivots=4)
    assert run(spark, rows, **how) == plain(rows, 9, 4, 6)


def test_nulls_lengths_repeats_and_ties(spark):
    rows = [
        (1, [0.5, -0.5]), (1, [0.5, -0.5]), (1, [0.25, 0.0]), (2, None), (3, [1.0]), (4, [1.0, float("nan")]),
        (5, [float("inf"), 0.0]), (6, [None, 0.0]), (None, [1.0, 1.0]), (7, [-1.0, 1.0]), (8, [-1.0, 1.0]), (9, []), (10, [0.001, -0.001]),
    ]
    assert run(spark, rows, dims=2, clusters=3, rounds=5) == plain(rows, 3, 5, 2)
    # More centroids than vectors, equal centroids: the smaller number wins, the others stay.
    assert run(spark, rows, dims=2, clusters=40, rounds=5) == plain(rows, 40, 5, 2)


def test_empty_table(spark):
    assert run(spark, [], dims=2) == []
    assert run(spark, [(1, None)], dims=2) == []


@pytest.mark.parametrize("size", [1e6, 1e9, 1e12])
def test_large_components_stay_exact(spark, size):
    rng = np.random.default_rng(5)
    rows = [(i, (size * rng.normal(size=4)).tolist()) for i in range(60)]
    assert run(spark, rows, dims=4, clusters=6, rounds=3, pivots=3) == plain(rows, 6, 3, 4)


def test_bounds_leave_centroids_out():
    rng = np.random.default_rng(1)
    centres = 1000 * rng.integers(-20, 20, size=(12, 4))
    rows = np.repeat(centres, 50, 0) + rng.integers(-30, 30, size=(600, 4))
    fixed = pivots.pick_pivots(centres.tolist(), 4)
    now = pivots.Centroids(centres.tolist(), fixed)
    near = pivots.pivot_distances(rows, fixed).astype(np.float32)
    name, best, taken = pivots.nearest(rows, near, now)
    every = ((rows[:, None, :] - centres[None]) ** 2).sum(2)
    assert (name == every.argmin(1)).all() and (best == every.min(1)).all()
    assert taken < every.size / 3
    bound = pivots.lower_bounds(near, pivots.pivot_distances(centres, fixed))
    assert (bound**2 <= every).all()
