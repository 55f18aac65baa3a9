"""Ordered prefix sums and row ranks that never need one task per group (GP1).

A window without a partition key, or with a key that holds a large share of the rows,
runs in one task.  Here the rows are range-partitioned on (keys, order), so that a hot
key is spread over many buckets; each bucket is summed on its own and then shifted by
what the earlier buckets of the same key hold.

Only the shifts are broadcast.  A bucket can continue at most one key from the bucket
before it, so there are fewer shifts than buckets, whatever the data looks like.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import freeze

def _buckets(df: DataFrame, buckets: int | None) -> int:
    return buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _same_key(a: str, b: str, keys: Sequence[str]) -> Column:
    on = F.col(f"{a}._bucket") == F.col(f"{b}._bucket")
    for k in keys:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    *,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``cum_<value>``: the inclusive running sum per key in ``order``.

    ``order`` must be unique within a key (aggregate ties first).
    """
    keys, order = list(keys), list(order)
    placed = freeze(
        df.repartitionByRange(_buckets(df, buckets), *keys, *order).withColumn(
            "_bucket", F.spark_partition_id()
        )
    )
    inside = Window.partitionBy("_bucket", *keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = (
        placed.groupBy("_bucket", *keys)
        .agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
        .withColumn("_n_before", F.count(F.lit(1)).over(earlier))
        .withColumns({f"_s_{v}": F.sum(f"_s_{v}").over(earlier) for v in values})
        .filter(F.col("_n_before") > 0)
        .drop("_n_before")
    )
    local = placed.withColumns({f"cum_{v}": F.sum(v).over(inside) for v in values})
    joined = local.alias("l").join(
        F.broadcast(shifts).alias("s"), _same_key("l", "s", keys), "left"
    )
    zero = F.lit(0)
    plain = [F.col(f"l.{c}") for c in df.columns]
    sums = [
        (F.col(f"l.cum_{v}") + F.coalesce(F.col(f"s._s_{v}"), zero)).alias(f"cum_{v}")
        for v in values
    ]
    return joined.select(*plain, *sums)


def _continued(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """_bucket, keys, _before, _total of the keys that lie in several buckets.

    Buckets follow each other in key order, so a bucket has at most two of them: there are
    at most twice as many rows as buckets, whatever the number of keys.
    """
    parts = Window.partitionBy(*keys)
    earlier = parts.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.groupBy("_bucket", *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
                "_total": F.sum("_n").over(parts),
                "_parts": F.count(F.lit(1)).over(parts),
            }
        )
        .filter(F.col("_parts") > 1)
        .drop("_n", "_parts")
    )


def row_ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    *,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``row_rank`` (0-based, per key, in ``order``) and ``group_rows``.

    ``order`` needs a unique last column.  A key within one bucket is ranked there; only
    keys that go on into further buckets are shifted by what a broadcast row says.
    """
    keys = list(keys)
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = freeze(
        df.repartitionByRange(_buckets(df, buckets), *[F.col(k) for k in keys], *by).withColumn(
            "_bucket", F.spark_partition_id()
        )
    )
    inside = Window.partitionBy("_bucket", *keys)
    local = placed.withColumns(
        {"_rank": F.row_number().over(inside.orderBy(*by)) - 1, "_rows": F.count(F.lit(1)).over(inside)}
    )
    joined = local.alias("l").join(
        F.broadcast(_continued(placed, keys)).alias("s"), _same_key("l", "s", keys), "left"
    )
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._rank") + F.coalesce(F.col("s._before"), F.lit(0))).alias("row_rank"),
        F.coalesce(F.col("s._total"), F.col("l._rows")).alias("group_rows"),
    )


def ntile(
    df: DataFrame,
    n: int,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str,
    *,
    buckets: int | None = None,
) -> DataFrame:
    """NTILE(n) per key: the first ``rows mod n`` tiles get one row more."""
    r, size = F.col("row_rank"), F.col("group_rows")
    small, extra = F.floor(size / n), size % n
    edge = extra * (small + 1)
    tile = F.when(r < edge, F.floor(r / (small + 1))).otherwise(
        extra + F.floor((r - edge) / F.greatest(small, F.lit(1)))
    )
    return (
        row_ranks(df, keys, order, buckets=buckets)
        .withColumn(name, (tile + 1).cast("int"))
        .drop("row_rank", "group_rows")
    )
