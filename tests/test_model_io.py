import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.operators import metrics, model
from ebbline.plans import churn
from ebbline.sources import io

LINEAGE = {"model_name": "churn", "model_version": "1", "run_id": "r"}
AT = dt.datetime(2024, 1, 1)


def scored(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")


def auc_brute(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_auc_of_two_rows_and_one_class(spark):
    assert metrics.auc(scored(spark, [0, 1], [0.6, 0.8])).first().auc == 1.0
    assert metrics.auc(scored(spark, [1, 1], [0.6, 0.8])).first().auc is None


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=2, max_size=40))
def test_auc_equals_pair_counting_and_ignores_scale(spark, rows):
    y, s = [a for a, _ in rows] + [0, 1], [b for _, b in rows] + [3, 3]
    want = auc_brute(y, s)
    assert metrics.auc(scored(spark, y, s)).first().auc == pytest.approx(want)
    assert metrics.auc(scored(spark, y, [np.exp(x) for x in s])).first().auc == pytest.approx(want)


def test_threshold_metrics(spark):
    y, p = [0, 0, 1, 1, 0, 1, 0, 1], [0, 1, 1, 1, 0, 0, 0, 1]
    df = spark.createDataFrame(list(zip(y, p)), "label int, prediction int")
    r = metrics.threshold_metrics(df).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (3, 1, 1, 3)
    assert r.accuracy == r.precision == r.recall == r.f1 == r.f2 == 0.75
    cells = {(x.label, x["prediction"]): x["rows"] for x in metrics.confusion(df).collect()}
    assert cells == {(0, 0): 3, (0, 1): 1, (1, 0): 1, (1, 1): 3}


def test_gate_treats_a_missing_metric_as_zero(spark):
    row = spark.createDataFrame([(0.75,)], "auc double")
    assert metrics.passes(metrics.metric_gate(row, {"auc": 0.75}))
    assert not metrics.passes(metrics.metric_gate(row, {"auc": 0.75, "recall": 0.8}))


def toy(spark, n=400):
    return spark.range(n).select(
        F.col("id").cast("string").alias("AccountNumber"),
        (F.col("id") % 10).cast("double").alias("x"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 3).cast("double").alias("gap"),
        F.when(F.col("id") % 5 == 0, "a").when(F.col("id") % 5 < 4, "b").alias("c"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("id") % 10 >= 5, 1).otherwise(0).alias("ChurnedIn90D"),
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"),
    )


def test_train_score_upsert_and_drift(spark, tmp_path):
    df = toy(spark)
    fitted, row = churn.train_job(df, trees=5, depth=4)
    r = row.first()
    assert r.auc > 0.95 and r.accuracy > 0.9
    importance = {x.feature: x.importance for x in model.feature_importance(fitted, df).collect()}
    assert set(importance) == {"x", "gap", "c", "flag", "empty"} and max(importance, key=importance.get) == "x"
    assert importance["empty"] == 0
    target = str(tmp_path / "scores")
    for _ in range(2):
        n = churn.score_job(fitted, df, target, lineage=LINEAGE, scored_at=AT, batch_id="b1")
        assert n == 400
    other = churn.score_job(fitted, df.filter("split = 'test'"), target, lineage=LINEAGE, scored_at=AT, batch_id="b2")
    out = io.read_batches(spark, target)
    assert {r.score_batch_id: r["count"] for r in out.groupBy("score_batch_id").count().collect()} == {"b1": 400, "b2": other}
    assert out.filter("churn_score < 0 or churn_score > 1 or churn_score is null").isEmpty()
    assert dict(out.dtypes)["flag"] == "boolean" and out.filter("c is null").count() > 0
    stats, log = str(tmp_path / "stats"), str(tmp_path / "drift")
    assert churn.baseline_job(df.select("x", "gap"), stats) == 2
    for run in ("r1", "r2", "r1"):
        assert churn.drift_job(spark, stats, out, log, environment="dev", run_id=run) == 2
    assert io.read_batches(spark, log, "run_id").count() == 4


def test_scoring_without_a_feature_raises(spark):
    df = toy(spark)
    fitted = model.train_forest(df, label="ChurnedIn90D", exclude=["AccountNumber", "split"], trees=2, depth=2)
    with pytest.raises(ValueError, match="missing feature columns"):
        model.score(fitted, df.drop("x"))


def test_any_number_of_categories_is_encoded(spark, tmp_path):
    """A category per row, told apart by two hashes where one is not enough, and unknown ones."""
    df = toy(spark).withColumn("c", F.when(F.col("x") >= 5, F.concat(F.lit("hot"), F.col("x") % 3)).otherwise(F.col("AccountNumber")))
    fitted = model.train_forest(df.select("AccountNumber", "c", "empty", "ChurnedIn90D"), label="ChurnedIn90D", trees=5, depth=6)
    fitted = model.stored(fitted, str(tmp_path / "model"))
    assert model.required_features(fitted) == ["empty", "AccountNumber", "c"]
    unknown = df.withColumns({"c": F.lit("never seen"), "empty": F.lit(4.0)}).unionByName(df.withColumn("c", F.lit(None).cast("string")))
    scored = model.score(fitted, unknown)
    assert scored.count() == 800 and scored.filter("churn_score IS NULL OR isnan(churn_score)").isEmpty()
    good = model.score(fitted, df).groupBy("ChurnedIn90D").agg(F.avg("churn_score").alias("s")).collect()
    s = {r.ChurnedIn90D: r.s for r in good}
    assert s[1] > s[0] + 0.3


def test_train_on_empty_split_raises(spark):
    with pytest.raises(ValueError, match="empty"):
        churn.train_job(toy(spark).filter("split = 'test'"))


def test_foreign_model_scores_in_batches(spark):
    out = model.score_with(lambda pdf: pdf["id"] / 10, spark.range(5))
    assert [r.churn_score for r in out.orderBy("id").collect()] == [0.0, 0.1, 0.2, 0.3, 0.4]


def test_split_and_rebalance_are_repeatable(spark):
    df = spark.range(5000).withColumn("y", F.when(F.col("id") % 50 == 0, 1).otherwise(0))
    split = model.hash_split(df, ["id"])
    assert split.exceptAll(model.hash_split(df.repartition(7), ["id"])).isEmpty()
    assert split.filter("split = 'train'").count() == 4000
    assert model.hash_split(df.limit(7), ["id"]).filter("split = 'train'").count() == 5
    assert model.hash_split(df, ["id"], 100).filter("split = 'train'").count() == 5000
    assert model.hash_split(df, ["id"], 0).filter("split = 'test'").count() == 5000
    assert model.hash_split(df.limit(0), ["id"]).isEmpty()
    # Rows of one key stay together, and nothing else gives way by more than one key.
    groups = df.withColumn("g", F.col("id") % 50)
    sides = model.hash_split(groups, ["g"]).groupBy("g").agg(F.count_distinct("split").alias("n"), F.min("split").alias("s"))
    assert sides.filter("n > 1").isEmpty() and sides.filter("s = 'train'").count() == 40
    even = model.rebalance(df, "y", 0.4, keys=["id"])
    assert even.filter("y = 1").count() == 100 and even.filter("y = 0").count() == 150
    assert model.rebalance(even, "y", 0.4, keys=["id"]).count() == 250
    assert model.rebalance(df.filter("y = 0"), "y", 0.4, keys=["id"]).isEmpty()
    weights = model.class_weights(df, "y").groupBy("y").agg(F.sum("weight").alias("w")).collect()
    assert {round(r.w, 6) for r in weights} == {2500.0}


def test_velocity_equals_a_plain_range_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, i % 3 if i % 2 else 0, t0 + dt.timedelta(hours=(i * 7) % 90), float(i % 5), "m") for i in range(120)]
    df = spark.createDataFrame(rows, "id int, u int, ts timestamp, v double, m string")
    got = model.fraud_features(df, row_id="id", entity="u", ts="ts", amount="v", merchant="m", label=F.col("v") > 3)
    got = {r.id: r.velocity_score for r in got.collect()}
    day = dt.timedelta(hours=24)
    want = {i: sum(1 for _, u2, t2, _, _ in rows if u2 == u and t - day < t2 <= t) for i, u, t, _, _ in rows}
    assert got == want


def test_writers_count_order_and_increment(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2))], "x int, y string, compute_date date")
    assert io.overwrite(df, path, ("compute_date",)) == 2
    assert io.read_increment(spark, path, since=dt.date(2024, 1, 2)).count() == 1
    assert io.read_increment(spark, path, until=dt.date(2024, 1, 1)).first().x == 1
    store = str(tmp_path / "store")
    assert io.upsert_batch(df, store, "compute_date") == 2
    log = str(tmp_path / "log")
    assert io.append(df.drop("compute_date"), log) == 2
    assert io.append(df.select("y", "x"), log) == 2
    with pytest.raises(ValueError, match="no columns"):
        io.append(df, log)
    with pytest.raises(ValueError, match="no columns"):
        io.upsert_batch(df.withColumn("z", F.lit(1)), store, "compute_date")
    with pytest.raises(ValueError, match="another table"):
        io.upsert_batch(df, path, "compute_date")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception):
        io.exists(spark, str(tmp_path / "broken"))
    assert not io.exists(spark, str(tmp_path / "missing"))
    assert io.read_table(spark, log).filter("x = 1 and y = 'a'").count() == 2
    sql = io.run_sql(spark, "select count(*) n from {t} where x > :low", {"t": df}, {"low": 1})
    assert sql.first().n == 1


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "x int, score_batch_id string")


def held(df):
    return sorted((r.x, r.score_batch_id) for r in df.collect())


def test_batches_are_replaced_whole(spark, tmp_path):
    store = str(tmp_path / "store")
    assert io.upsert_batch(batch(spark), store, batches=["2024-01-01"]) == 0
    assert held(io.read_batches(spark, store)) == []
    assert io.upsert_batch(batch(spark, (1, "2024-01-01"), (2, "2024-01-01"), (3, "b"), (4, None)), store) == 4
    before = io.read_batches(spark, store)
    # A smaller run, a repeated one, one of another column order, and one without rows.
    for _ in range(2):
        assert io.upsert_batch(batch(spark, (9, "2024-01-01")).select("score_batch_id", "x"), store, batches=["2024-01-01"]) == 1
    assert sorted(io.read_batches(spark, store).collect(), key=str) == sorted(batch(spark, (9, "2024-01-01"), (3, "b"), (4, None)).collect(), key=str)
    assert io.upsert_batch(batch(spark), store, batches=["b", "2024-01-01"]) == 0
    assert [(r.x, r.score_batch_id) for r in io.read_batches(spark, store).collect()] == [(4, None)]
    # A reader that began earlier still has all its rows.
    assert before.count() == 4


def test_a_write_that_fails_half_way_is_not_seen(spark, tmp_path):
    store = str(tmp_path / "store")
    io.upsert_batch(batch(spark, (1, "a")), store)
    # Rows of a write without its log entry, as a lost job leaves them.
    batch(spark, (7, "a"), (8, "z")).withColumn("write_id", F.lit("w-lost")).write.mode("append").partitionBy("write_id").parquet(f"{store}/data")
    assert held(io.read_batches(spark, store)) == [(1, "a")]
    broken = batch(spark, (5, "a"), (0, "a")).withColumn("x", F.expr("if(x = 0, raise_error('lost'), x)").cast("int"))
    with pytest.raises(Exception):
        io.upsert_batch(broken, store)
    assert held(io.read_batches(spark, store)) == [(1, "a")]
    io.upsert_batch(batch(spark, (5, "a")), store)
    assert held(io.read_batches(spark, store)) == [(5, "a")]


def test_catalog_table_upsert(spark, tmp_path):
    spark.sql(f"create database if not exists ebb location '{tmp_path}/ebb.db'")
    rows = spark.createDataFrame([(1, "b1"), (2, "b1")], "x int, score_batch_id string")
    io.upsert_batch(rows, "ebb.scores")
    io.upsert_batch(rows.limit(1), "ebb.scores")
    io.upsert_batch(spark.createDataFrame([("b2", 9)], "score_batch_id string, x int"), "ebb.scores")
    got = sorted((r.x, r.score_batch_id) for r in spark.table("ebb.scores").collect())
    assert got == [(1, "b1"), (9, "b2")]
    assert io.upsert_batch(rows.limit(0), "ebb.scores", batches=["b1", "it's"]) == 0
    assert [r.x for r in io.read_batches(spark, "ebb.scores").collect()] == [9]
    assert io.append(rows, "ebb.scores_log") == 2 and io.exists(spark, "ebb.scores_log")
    spark.sql("drop database ebb cascade")
