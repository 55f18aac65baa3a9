"""Centroid clustering with a table of pivot distances (operator 11).

Linear approximating and eliminating search: the distances of every vector to a few fixed
pivots are computed once and written beside the vector.  In each round the difference of
two pivot distances is a lower bound of the distance to a centroid (triangle inequality).
A vector meets the centroids in the order of their bounds and stops at the first bound
above its best distance; the centroids before that one get exact integer distances.

Only centroids, ``clusters`` rows of ``dims`` integers, pass through the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.topk import quantised, usable
from ebbline.session import shared_dir

DIMS = 64
CLUSTERS = 40
ROUNDS = 5
PIVOTS = 16
LONGEST = (1 << 63) - 1
# Bounds are doubles and stored distances are floats; both err by far less than this share.
SLACK = 1e-6
_WHOLE = pa.decimal128(38, 0)


class Centroids(NamedTuple):
    """Exact components of all centroids, and of the fixed pivots."""

    points: list[list[int]]
    pivots: list[list[int]]


def _fits(*blocks: np.ndarray) -> bool:
    """Whether squared distances between rows of the blocks are exact as longs."""
    top = max((max(abs(int(b.max())), abs(int(b.min()))) for b in blocks if b.size), default=0)
    dims = max((b.shape[1] for b in blocks), default=0)
    return dims * (2 * top) ** 2 <= LONGEST


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one point, or row by row to as many points."""
    if not _fits(rows, np.atleast_2d(point)):
        rows, point = rows.astype(object), point.astype(object)
    away = rows - point
    return (away * away).sum(1)


def pick_pivots(points: list[list[int]], count: int) -> list[list[int]]:
    """Points far from each other: each is the one farthest from those picked before."""
    if not points:
        return []
    rows = np.array(points, dtype=np.int64)
    picked, nearest = [0], squared(rows, rows[0])
    while len(picked) < min(count, len(points)) and max(nearest) > 0:
        picked.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, squared(rows, rows[picked[-1]]))
    return [points[i] for i in picked]


def pivot_distances(rows: np.ndarray, pivots: list[list[int]]) -> np.ndarray:
    """Distances of every row to every pivot, a column per pivot."""
    out = np.empty((len(rows), len(pivots)))
    for j, p in enumerate(pivots):
        out[:, j] = np.sqrt(squared(rows, np.array(p, dtype=np.int64)).astype(np.float64))
    return out


def lower_bounds(near: np.ndarray, centroid_near: np.ndarray) -> np.ndarray:
    """Bounds of the distance of every row to every centroid, rounded downwards."""
    bound = np.zeros((len(near), len(centroid_near)))
    for j in range(near.shape[1]):
        a, b = near[:, j : j + 1].astype(np.float64), centroid_near[None, :, j]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    return bound


def nearest(rows: np.ndarray, near: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and its exact squared distance for every row (ties:
    the smaller number), and how many exact distances that took."""
    points = np.array(centroids.points, dtype=np.int64)
    bound = lower_bounds(near, pivot_distances(points, centroids.pivots))
    order = np.argsort(bound, axis=1, kind="stable")
    reach = np.take_along_axis(bound, order, 1) ** 2
    first = order[:, 0]
    best = squared(rows, points[first])
    name, taken = first.copy(), len(rows)
    alive = np.arange(len(rows))
    for step in range(1, len(points)):
        # A bound is below the true root, so its square may equal the best only for a tie.
        alive = alive[reach[alive, step] <= best[alive] * (1 + SLACK)]
        if not len(alive):
            break
        other = order[alive, step]
        away = squared(rows[alive], points[other])
        taken += len(alive)
        closer = (away < best[alive]) | ((away == best[alive]) & (other < name[alive]))
        hit = alive[closer]
        if away.dtype == object and best.dtype != object:
            best = best.astype(object)
        best[hit], name[hit] = away[closer], other[closer]
    return name, best, taken


def _rows(batch: pa.RecordBatch, dims: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    vec = batch.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
    near = batch.column("near").flatten().to_numpy(zero_copy_only=False).reshape(-1, pivots)
    return vec, near


def _measurer(pivots: list[list[int]], dims: int):
    """Adds the row of pivot distances to every vector."""

    def measured(batches):
        for batch in batches:
            vec = batch.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            near = pivot_distances(vec, pivots).astype(np.float32)
            edges = pa.array(np.arange(len(vec) + 1) * len(pivots), pa.int32())
            yield pa.record_batch(
                [batch.column("id"), batch.column("vec"), pa.ListArray.from_arrays(edges, pa.array(near.ravel()))], ["id", "vec", "near"]
            )

    return measured


def _totals(centroids: Centroids, dims: int):
    """One row per centroid that has vectors in this task: their number, sums and spread."""

    def added(batches):
        k = len(centroids.points)
        count, spread = [0] * k, [0] * k
        total = np.zeros((k, dims), dtype=object)
        for batch in batches:
            vec, near = _rows(batch, dims, len(centroids.pivots))
            name, away, _ = nearest(vec, near, centroids)
            safe = vec if not len(vec) or len(vec) * int(np.abs(vec).max()) <= LONGEST else vec.astype(object)
            for c in np.unique(name):
                mine = name == c
                count[c] += int(mine.sum())
                spread[c] += sum(away[mine].tolist())
                total[c] += safe[mine].sum(0).astype(object)
        used = [c for c in range(k) if count[c]]
        whole = [pa.array([Decimal(int(x)) for x in total[c]], _WHOLE) for c in used]
        edges = pa.array(np.arange(len(used) + 1) * dims, pa.int32())
        sums = pa.concat_arrays(whole) if whole else pa.array([], _WHOLE)
        yield pa.record_batch(
            [
                pa.array(used, pa.int32()),
                pa.array([count[c] for c in used], pa.int64()),
                pa.array([Decimal(spread[c]) for c in used], _WHOLE),
                pa.ListArray.from_arrays(edges, sums),
            ],
            ["cluster", "n", "spread", "sums"],
        )

    return added


def _namer(centroids: Centroids, dims: int):
    def named(batches):
        for batch in batches:
            vec, near = _rows(batch, dims, len(centroids.pivots))
            name, away, _ = nearest(vec, near, centroids)
            if away.dtype == object:
                away = np.array([min(int(x), LONGEST) for x in away], dtype=np.int64)
            yield pa.record_batch([batch.column("id"), pa.array(name, pa.int32()), pa.array(away, pa.int64())], ["id", "cluster", "distance"])

    return named


def _summed(table: DataFrame, centroids: Centroids, dims: int) -> list:
    """Exact number, spread and component sums of every centroid that has vectors."""
    parts = table.select("vec", "near").mapInArrow(
        _totals(centroids, dims), "cluster int, n long, spread decimal(38,0), sums array<decimal(38,0)>"
    )
    return (
        parts.groupBy("cluster")
        .agg(F.sum("n").alias("n"), F.sum("spread").alias("spread"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))
        .collect()
    )


def seed_order(vec_id: Column) -> Column:
    """The text whose order picks the first centroids."""
    return F.sha2(F.concat(F.lit("2:"), vec_id.cast("string")), 256)


def _long(value: int) -> int:
    return min(int(value), LONGEST)


def cluster(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = DIMS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    scale: int = 256,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row per vector.

    Components become floor(scale * x).  The first centroids are the vectors whose ids come
    first in ``seed_order`` (rows that repeat an id: by vector; fewer vectors: fewer
    centroids).  Every round moves each centroid to the floor of the mean of its vectors;
    one without vectors stays.  Rows with a null id, another number of components, or a
    null or non-finite component take no part; rows that repeat an id each count.  Empty
    tables give no rows.  All arithmetic is exact; a distance or sum beyond a long is
    written as the largest long.
    """
    spark = vectors.sparkSession
    kept = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)) & (F.size(vector_col) == dims)).select(
        F.col(id_col).alias("id"), quantised(F.col(vector_col), scale).alias("vec")
    )
    seeds = [list(r.vec) for r in kept.orderBy(seed_order(F.col("id")), "vec").limit(clusters).collect()]
    kind = kept.schema["id"].dataType.simpleString()
    if not seeds:
        return kept.select(
            F.col("id").alias(id_col),
            F.lit(0).alias("cluster"),
            *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    fixed = pick_pivots(seeds, pivots)
    path = f"{shared_dir(spark)}/pivots-{uuid.uuid4().hex}"
    kept.mapInArrow(_measurer(fixed, dims), f"id {kind}, vec array<bigint>, near array<float>").write.parquet(path)
    table = spark.read.parquet(path)
    now = Centroids(seeds, fixed)
    for _ in range(rounds):
        points = list(now.points)
        for r in _summed(table, now, dims):
            points[r.cluster] = [int(s) // r.n for s in r.sums]
        now = Centroids(points, fixed)
    spread = {r.cluster: int(r.spread) for r in _summed(table, now, dims)}
    told = spark.createDataFrame(
        [
            (c, _long(spread.get(c, 0)), hashlib.sha256(",".join(map(str, p)).encode()).hexdigest())
            for c, p in enumerate(now.points)
        ],
        "cluster int, cluster_inertia long, centroid_sha256 string",
    )
    named = table.select("id", "vec", "near").mapInArrow(_namer(now, dims), f"id {kind}, cluster int, distance long")
    # One row per centroid, of which there are ``clusters``.
    return named.join(F.broadcast(told), "cluster").select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(_long(sum(spread.values()))).cast("long").alias("inertia"),
        "centroid_sha256",
    )
