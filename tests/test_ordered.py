"""Running sums and ranks must not depend on how rows are spread over buckets."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ebbline.operators.ordered import _continued, ntile, prefix_sums, row_ranks


def hot_frame(spark, n=3000):
    """One key holds a third of the rows, the rest is spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1)
    return spark.range(n).select(
        key.alias("k"), ((F.col("id") * 7919) % n).alias("o"), (F.col("id") % 11).alias("v")
    )


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_prefix_sums_equal_a_plain_window(spark, buckets):
    df = hot_frame(spark)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("cum_v", F.sum("v").over(w))
    got = prefix_sums(df, ["k"], ["o"], ["v"], buckets=buckets)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_prefix_sums_with_null_key_and_no_key(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 1)], "k string, o int, v int")
    got = {(r.k, r.o): r.cum_v for r in prefix_sums(df, ["k"], ["o"], ["v"], buckets=4).collect()}
    assert got == {(None, 1): 5, (None, 2): 11, ("a", 1): 1}
    one = spark.range(1, 101).withColumnRenamed("id", "o").withColumn("v", F.lit(1))
    cum = prefix_sums(one, [], ["o"], ["v"], buckets=7)
    assert cum.filter("cum_v <> o").isEmpty() and cum.count() == 100


def test_hot_key_is_spread_over_buckets(spark):
    df = hot_frame(spark)
    ranks = row_ranks(df, [], ["k", "o"], buckets=8)
    assert ranks.agg(F.countDistinct("row_rank")).first()[0] == 3000
    assert ranks.select(F.min("row_rank"), F.max("row_rank")).first() == (0, 2999)


@pytest.mark.parametrize("rows,tiles", [(1, 5), (4, 5), (5, 5), (23, 5), (24, 7)])
def test_ntile_equals_builtin(spark, rows, tiles):
    df = spark.range(rows).select(
        F.lit("d").alias("d"), "id", F.when(F.col("id") % 4 != 0, F.col("id") % 3).alias("rate")
    )
    order = [F.col("rate").asc_nulls_first(), F.col("id")]
    want = df.withColumn("t", F.ntile(tiles).over(Window.partitionBy("d").orderBy(*order)))
    got = ntile(df, tiles, ["d"], order, "t", buckets=3)
    assert got.exceptAll(want).isEmpty() and got.count() == rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9)), min_size=1, max_size=40))
def test_prefix_sums_property(spark, rows):
    pdf = pd.DataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], columns=["k", "o", "v"])
    pdf["want"] = pdf.groupby("k").v.cumsum()
    got = prefix_sums(spark.createDataFrame(pdf), ["k"], ["o"], ["v"], buckets=4)
    assert got.filter("cum_v <> want").isEmpty()


def test_ranks_equal_a_plain_window_and_broadcast_little(spark):
    """A key per row, a hot key and a null key: what is broadcast follows the buckets only."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 500 != 1, F.concat(F.lit("k"), F.col("id")))
    df = spark.range(20_000).select(key.alias("k"), ((F.col("id") * 7919) % 20_011).alias("o"))
    w = Window.partitionBy("k")
    want = df.withColumns({"row_rank": F.row_number().over(w.orderBy("o")) - 1, "group_rows": F.count(F.lit(1)).over(w)})
    got = row_ranks(df, ["k"], ["o"], buckets=9)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    placed = df.repartitionByRange(9, "k", "o").withColumn("_bucket", F.spark_partition_id())
    assert 2 <= _continued(placed, ["k"]).count() <= 18
