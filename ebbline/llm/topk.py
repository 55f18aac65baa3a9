"""Exact top-k by integer inner product with ball trees (operator 4).

The candidates are dealt to shards.  A task builds a ball tree over a shard and searches
it for blocks of queries: nodes are taken in the order of their upper bound
``q . centre + |q| * radius``, and a node is left out for every query whose current kth
score it cannot reach.  A first pass over each query's own shard gives every query a kth
score to start from in all other shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import freeze

LEAF = 128
SHARD_ROWS = 32_768
BLOCK_ROWS = 512
EXACT = 2.0**53


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component x as double, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinity."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


class Tree:
    """Ball tree over the rows of ``points``; leaves are ranges of the ordered rows."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.points = points.astype(np.float64)
        self.start, self.end, self.left, self.right = [], [], [], []
        self.centre, self.radius = [], []
        self._grow(0, len(points), leaf)
        for a, b, child in zip(self.start, self.end, self.left):
            if child < 0:
                self.order[a:b].sort()
        self.points = self.points[self.order]
        self.centre = np.array(self.centre)
        self.radius = np.array(self.radius)

    def _grow(self, a: int, b: int, leaf: int) -> None:
        todo = [(a, b, -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            me = len(self.start)
            if parent >= 0:
                (self.left if side == 0 else self.right)[parent] = me
            x = self.points[self.order[a:b]]
            centre = x.mean(0)
            away = np.sqrt(((x - centre) ** 2).sum(1))
            self.start.append(a), self.end.append(b)
            self.left.append(-1), self.right.append(-1)
            self.centre.append(centre), self.radius.append(float(away.max()))
            if b - a > leaf and away.max() > 0:
                one = x[away.argmax()]
                far = ((x - one) ** 2).sum(1)
                two = x[far.argmax()]
                lean = x @ (two - one)
                half = (b - a) // 2
                part = np.argpartition(lean, half)
                self.order[a:b] = self.order[a:b][part]
                todo += [(a, a + half, me, 0), (a + half, b, me, 1)]


def _keep_best(k: int, score: np.ndarray, name: np.ndarray, more_score: np.ndarray, more_name: np.ndarray):
    """The k best of both per row, by falling score and rising name."""
    s, n = np.concatenate([score, more_score], 1), np.concatenate([name, more_name], 1)
    o = np.lexsort((n, ~s), axis=1)[:, :k]
    return np.take_along_axis(s, o, 1), np.take_along_axis(n, o, 1)


def search(tree: Tree, ids: np.ndarray, whole: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
    """Scores and ids, k per query; unused places have the smallest long as score.

    ``whole`` and ``queries`` are longs.  Products are taken in doubles where all partial
    sums are exact there, else in longs.
    """
    none, last = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    n = len(query_ids)
    score, name = np.full((n, k), none, np.int64), np.full((n, k), last, np.int64)
    q = queries.astype(np.float64)
    norm = np.sqrt((q * q).sum(1))
    exact = float(np.abs(whole).max(initial=0)) * float(np.abs(queries).max(initial=0)) * whole.shape[1] < EXACT
    points = tree.points if exact else whole[tree.order]
    asked = q if exact else queries
    bound = q @ tree.centre.T + norm[:, None] * tree.radius[None, :]
    bound += 1e-9 * (np.abs(bound) + norm[:, None] * tree.radius[None, :] + 1)
    heap = [(-float(bound[:, 0].max(initial=0)), 0, np.arange(n))]
    while heap:
        _, at, who = heapq.heappop(heap)
        kth = np.maximum(score[who, k - 1], floor[who])
        who = who[bound[who, at] >= kth]
        if not len(who):
            continue
        if tree.left[at] < 0:
            a, b = tree.start[at], tree.end[at]
            s = (asked[who] @ points[a:b].T).astype(np.int64)
            other = ids[tree.order[a:b]]
            s[other[None, :] == query_ids[who][:, None]] = none
            # A leaf's rows are in the order of their ids: a stable sort settles ties.
            o = np.argsort(-s.astype(np.float64) if exact else ~s, axis=1, kind="stable")[:, :k]
            more = np.take_along_axis(s, o, 1)
            score[who], name[who] = _keep_best(k, score[who], name[who], more, np.where(more == none, last, other[o]))
        else:
            for child in (tree.left[at], tree.right[at]):
                heapq.heappush(heap, (-float(bound[who, child].max()), child, who))
    return score, name


def _runs(batch: pa.RecordBatch):
    """Parts of a sorted batch with one shard and one kind of row."""
    shard, query = batch.column("shard").to_numpy(zero_copy_only=False), batch.column("query").to_numpy(zero_copy_only=False)
    cut = np.flatnonzero((shard[1:] != shard[:-1]) | (query[1:] != query[:-1])) + 1
    edges = [0, *cut.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            part = batch.slice(a, b - a)
            vec = part.column("vec")
            flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield str(shard[a]), bool(query[a]), part.column("id").to_numpy(), part.column("floor").to_numpy(), flat.reshape(b - a, -1)


def _searcher(k: int):
    def found(batches):
        now, rows, tree, whole, ids = None, [], None, None, None
        for batch in batches:
            for shard, query, row_ids, floor, vec in _runs(batch):
                if shard != now:
                    now, rows, tree = shard, [], None
                if not query:
                    rows.append((row_ids, vec))
                    continue
                if not rows:
                    continue
                if tree is None:
                    ids, whole = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
                    by_id = np.argsort(ids, kind="stable")
                    ids, whole = ids[by_id], whole[by_id]
                    tree = Tree(whole)
                for a in range(0, len(row_ids), BLOCK_ROWS):
                    q = slice(a, a + BLOCK_ROWS)
                    score, name = search(tree, ids, whole, row_ids[q], vec[q], floor[q], k)
                    hit = score != np.iinfo(np.int64).min
                    yield pa.record_batch(
                        [pa.array(np.repeat(row_ids[q], hit.sum(1))), pa.array(name[hit]), pa.array(score[hit])],
                        ["query_id", "vec_id", "score"],
                    )

    return found


def _pass(points: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """Best candidates of each query in each of the shards it names."""
    rows = points.select("shard", F.lit(False).alias("query"), "id", F.lit(0).cast("long").alias("floor"), "vec").unionByName(
        queries.select("shard", F.lit(True).alias("query"), "id", "floor", "vec")
    )
    return (
        rows.repartition(shards, "shard")
        .sortWithinPartitions("shard", "query", "id")
        .mapInArrow(_searcher(k), "query_id long, vec_id long, score long")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    *,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    is_query: Column | None = None,
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products per query.

    Queries are the rows where ``is_query`` holds (all, without it); candidates are all
    other rows.  Ties go to the smaller id.  Rows with a null id, a null vector or a vector
    with null or non-finite components take no part; only vectors of equal length meet.  Of
    rows with the same id the first by vector counts.  Of equal vectors the ``k + 1``
    smallest ids are candidates: more of them can be in no result.
    """
    rows = (
        vectors.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull() & (F.size(vector_col) > 0))
        .select(
            F.col(id_col).cast("long").alias("id"),
            quantised(F.col(vector_col), scale).alias("vec"),
            (F.lit(True) if is_query is None else F.coalesce(is_query, F.lit(False))).alias("asks"),
        )
        .groupBy("id")
        .agg(F.min("vec").alias("vec"), F.max("asks").alias("asks"))
    )
    same = Window.partitionBy("vec").orderBy("id")
    shards = max(1, -(-rows.count() // shard_rows))
    named = lambda number: F.concat_ws("/", F.size("vec"), number)
    home = F.pmod(F.xxhash64("id"), F.lit(shards))
    points = rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1).select("id", "vec", named(home).alias("shard"))
    asks = rows.filter("asks")
    least = F.lit(int(np.iinfo(np.int64).min))
    first = _best(_pass(points, asks.select("id", "vec", named(home).alias("shard"), least.alias("floor")), shards, k), k)
    if shards == 1:
        return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    first = freeze(first)
    kth = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    others = (
        asks.join(kth, "id", "left")
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .filter(F.col("number") != home)
        .select("id", "vec", named(F.col("number")).alias("shard"), F.coalesce("floor", least).alias("floor"))
    )
    rest = _pass(points, others, shards, k)
    both = first.drop("rank").unionByName(rest)
    return _best(both, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
