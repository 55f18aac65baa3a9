"""Connected components of an edge list, without a task that holds a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.session import freeze

MAX_ROUNDS = 100


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs of longs -> (node, root), root the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014); each step is a
    map-side combined minimum per node and a join, so that a node with very many edges
    needs no task of its own.  The edges are written to the checkpoint folder each round.
    Loops, repeated and null edges are ignored; only nodes with an edge to another node
    are returned.
    """
    edges = freeze(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        # Large star: what is above a node is tied to the smallest node around it.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        # Small star: what is below a node is tied to the smallest node below it.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        edges = freeze(small)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
