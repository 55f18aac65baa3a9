import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import topk


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(found)]
    return sorted(out)


def check(spark, rows, k=5, every=5, **options):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<double>, shard string, vec int")
    got = topk.top_k(df, k=k, is_query=F.col("vec_id") % every == 0, **options)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, k, every)


def made(n, dim, seed):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    for i in range(0, n, 3):
        rows[i] = (i, rows[(i * 7) % 10][1])
    return rows


@pytest.mark.parametrize("shard_rows", [10**6, 150])
def test_made_rows(spark, shard_rows):
    check(spark, made(700, 8, 1), shard_rows=shard_rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, None), (5, []), (10, [1.0, None]), (15, [nan, 1.0]), (20, [inf, 1.0]), (25, [1.0, 1.0]), (30, [1.0, 1.0]), (None, [1.0, 1.0])]
    odd += [(35, [1.0, 2.0, 3.0]), (36, [0.5, 0.0]), (37, [-0.001, 0.0]), (40, [1e6, 1e6]), (41, [-1e6, 3e6])]
    check(spark, odd)
    check(spark, odd, shard_rows=2)


def test_large_components_stay_exact(spark):
    check(spark, [(i, [1e6 + i, 1e5 * i]) for i in range(30)])


def test_repeated_rows_count_once(spark):
    rows = made(40, 4, 2)
    df = spark.createDataFrame([(i, v) for i, v in rows + rows[:10]], "vec_id long, embedding array<double>")
    got = topk.top_k(df, is_query=F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, 5, 5)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.top_k(df).count() == 0


def test_nodes_are_left_out():
    """Far from the query, leaves are not scored: their bound is below the kth score."""
    rng = np.random.default_rng(1)
    near, far = rng.integers(900, 1000, (200, 4)), rng.integers(-1000, -900, (2000, 4))
    tree = topk.Tree(np.concatenate([near, far]))
    whole = np.concatenate([near, far])
    q = np.array([[1000, 1000, 1000, 1000]])
    score, _ = topk.search(tree, np.arange(len(whole)), whole, np.array([-1]), q, np.array([np.iinfo(np.int64).min]), 5)
    assert score[0].tolist() == sorted((whole @ q[0]).tolist(), reverse=True)[:5]
