"""Queries over metrics, training, scoring and the table writers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.catalogue.bank import Bank
from ebbline.catalogue.features import RUN, q_feature_assembly
from ebbline.catalogue.quality_drift import fresh_path
from ebbline.catalogue.registry import query
from ebbline.functions.scalars import ratio
from ebbline.operators import metrics, model
from ebbline.plans import churn
from ebbline.sources import io

LINEAGE = {"model_name": "churn", "model_version": "1", "run_id": "run-1"}
SCORED_AT = dt.datetime(2001, 8, 2, 6, 0, 0)

# --- metrics --------------------------------------------------------------------------


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels with a score from the document length, and a cut at 1000 characters."""
    b = Bank(spark, sf_dir)
    docs = b.table("documents").select("doc_id", "lang", "n_chars")
    return (
        b.table("labels")
        .join(docs, "doc_id")
        .select(
            F.col("quality").alias("label"),
            "lang",
            F.col("n_chars").cast("double").alias("score"),
            F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("prediction"),
        )
    )


_J = """j AS (SELECT quality AS label, lang, n_chars AS score, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS prediction
             FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""

_AUC = """
SELECT {key} sum(label) AS n_pos, count(*) - sum(label) AS n_neg,
       (sum(CASE WHEN label = 1 THEN r END) - CAST(sum(label) AS DOUBLE) * (sum(label) + 1) / 2)
         / nullif(CAST(sum(label) AS DOUBLE) * (count(*) - sum(label)), 0) AS auc
FROM (SELECT {key} label, rank() OVER ({part} ORDER BY score)
             + (count(*) OVER (PARTITION BY {key} score) - 1) / 2.0 AS r FROM j) {group}"""


@query(
    "auc_rank",
    "n_pos bigint, n_neg bigint, auc double",
    ctes=_J,
    sql=_AUC.format(key="", part="", group=""),
)
def q_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc(judged(spark, sf_dir))


_M = """
SELECT *, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
       (1 + 1) * precision * recall / nullif(precision + recall, 0) AS f1,
       5 * precision * recall / nullif(4 * precision + recall, 0) AS f2
FROM (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall
      FROM (SELECT {key} count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
                   count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                   count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
                   count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM j {group}))"""
_MSPEC = """tp bigint, fp bigint, fn bigint, tn bigint, accuracy double, precision double, recall double,
            f1 double, f2 double"""


@query("threshold_metrics", _MSPEC, ctes=_J, sql=_M.format(key="", group=""))
def q_threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_metrics(judged(spark, sf_dir))


@query(
    "confusion",
    "label int, prediction int, rows bigint",
    ctes=_J,
    sql="SELECT label, prediction, count(*) AS rows FROM j GROUP BY 1, 2",
)
def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(judged(spark, sf_dir))


@query(
    "segment_metrics",
    "lang string, auc double," + _MSPEC,
    ctes=_J,
    sql="SELECT m.*, auc FROM (" + _M.format(key="lang,", group="GROUP BY lang") + ") m JOIN ("
    + _AUC.format(key="lang,", part="PARTITION BY lang", group="GROUP BY lang")
    + ") a ON a.lang = m.lang",
)
def q_segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = judged(spark, sf_dir)
    ranked = metrics.auc(j, keys=["lang"]).select("lang", "auc")
    return metrics.threshold_metrics(j, keys=["lang"]).join(ranked, "lang")


@query(
    "metric_gate",
    "metric string, value double, threshold double, passed boolean",
    ctes=_J,
    sql="""
SELECT metric, coalesce(value, 0) AS value, threshold, coalesce(value, 0) >= threshold AS passed FROM (
  SELECT 'auc' AS metric, auc AS value, 0.75 AS threshold FROM (""" + _AUC.format(key="", part="", group="") + """)
  UNION ALL SELECT 'recall', recall, 0.80 FROM (""" + _M.format(key="", group="") + """)
  UNION ALL SELECT 'precision', precision, 0.75 FROM (""" + _M.format(key="", group="") + """)
  UNION ALL SELECT 'not_logged', NULL, 0.5)""",
)
def q_metric_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = judged(spark, sf_dir)
    row = metrics.one_row(metrics.auc(j).select("auc"), metrics.threshold_metrics(j))
    return metrics.metric_gate(row, {"auc": 0.75, "recall": 0.80, "precision": 0.75, "not_logged": 0.5})


# --- training and scoring -------------------------------------------------------------


@query("rf_train_score", "as_of_date date, AccountNumber string, churn_score double, score_batch_id string")
def q_rf_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the feature table, train on one split, score the other, upsert the batch."""
    feature_table = fresh_path(spark, "features")
    io.overwrite(churn.with_split(q_feature_assembly(spark, sf_dir), RUN.asof), feature_table)
    table = io.read_table(spark, feature_table)
    fitted, _ = churn.train_job(table)
    target = fresh_path(spark, "scores")
    churn.score_job(
        fitted, table.filter(F.col("split") == "test"), target, lineage=LINEAGE, scored_at=SCORED_AT, batch_id="b1"
    )
    return io.read_batches(spark, target)


def scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by a fixed rule from the balance, in place of a model."""
    c = Bank(spark, sf_dir).table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return c.withColumn("churn_score", ratio(F.col("c_acctbal") + 1000, F.lit(11000)))


@query(
    "score_upsert",
    "c_custkey bigint, churn_score double, model_name string, scored_at timestamp, score_batch_id string",
    sql="""
SELECT c_custkey, (c_acctbal + 1000) / 11000 AS churn_score, 'churn' AS model_name,
       TIMESTAMP '2001-08-02 06:00:00' AS scored_at,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'b1' ELSE 'b2' END AS score_batch_id FROM customer""",
)
def q_score_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second one written twice: the repeat replaces itself.  A third one is
    written and then run again without rows, which removes it."""
    scored = scored_customers(spark, sf_dir)
    target = fresh_path(spark, "scores")
    segment = F.col("c_mktsegment") == "BUILDING"
    for rows, batch in ((scored.filter(segment), "b1"), (scored.filter(~segment), "b2"), (scored.filter(~segment), "b2")):
        io.upsert_batch(model.stamp(rows, scored_at=SCORED_AT, batch_id=batch, **LINEAGE), target)
    gone = model.stamp(scored, scored_at=SCORED_AT, batch_id="b3", **LINEAGE)
    for rows in (gone, gone.limit(0)):
        io.upsert_batch(rows, target, batches=["b3"])
    return io.read_batches(spark, target).withColumn("scored_at", F.col("scored_at").cast("timestamp_ntz"))


@query(
    "score_monitor",
    """score_batch_id string, predictions bigint, mean_score double, std_score double, min_score double,
       max_score double, mean_shift double""",
    sql="""
SELECT score_batch_id, count(*) AS predictions, avg(s) AS mean_score, stddev_samp(s) AS std_score,
       min(s) AS min_score, max(s) AS max_score, avg(s) - 0.5 AS mean_shift
FROM (SELECT c_mktsegment AS score_batch_id, (c_acctbal + 1000) / 11000 AS s FROM customer) GROUP BY 1""",
)
def q_score_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_customers(spark, sf_dir).withColumnRenamed("c_mktsegment", "score_batch_id")
    return metrics.score_monitor(scored, baseline=0.5)


@query(
    "score_with_function",
    "c_custkey bigint, churn_score double",
    sql="SELECT c_custkey, (c_acctbal + 1000) / 11000 AS churn_score FROM customer",
)
def q_score_with_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Bank(spark, sf_dir).table("customer").select("c_custkey", "c_acctbal")
    return model.score_with(lambda batch: (batch["c_acctbal"] + 1000) / 11000, c)


@query(
    "incremental_read",
    "o_orderkey bigint, compute_date date",
    sql="""SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS compute_date FROM orders
           WHERE last_day(CAST(o_orderdate AS DATE)) BETWEEN DATE '1999-01-31' AND DATE '1999-03-31'""",
)
def q_incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by month end, of which three partitions are read."""
    target = fresh_path(spark, "by_date")
    rows = Bank(spark, sf_dir).orders.select("o_orderkey", F.col("m").alias("compute_date"))
    io.overwrite(rows.repartition("compute_date"), target, ("compute_date",))
    return io.read_increment(spark, target, since=dt.date(1999, 1, 31), until=dt.date(1999, 3, 31))


@query(
    "hash_split",
    "c_custkey bigint, split string",
    sql="""
SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR)))
                            <= (SELECT count(*) FROM customer) * 80 // 100 THEN 'train' ELSE 'test' END AS split
FROM customer""",
)
def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.hash_split(Bank(spark, sf_dir).table("customer"), ["c_custkey"])


@query(
    "rebalance",
    "l_orderkey bigint, l_partkey bigint, l_linenumber int, label int",
    sql="""
WITH k AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS label,
                  md5(l_orderkey || '|' || l_partkey || '|' || l_linenumber) AS digest FROM lineitem),
r AS (SELECT *, sum(n) OVER (ORDER BY digest) AS cum
      FROM (SELECT digest, count(*) AS n FROM k WHERE label = 0 GROUP BY 1))
SELECT l_orderkey, l_partkey, l_linenumber, label FROM k LEFT JOIN r USING (digest)
WHERE label = 1 OR cum <= floor((SELECT count(*) FROM k WHERE label = 1) * 1.5)""",
)
def q_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Bank(spark, sf_dir).table("lineitem")
    labelled = rows.withColumn("label", F.when(F.col("l_tax") == 0, 1).otherwise(0))
    return model.rebalance(labelled, "label", 0.4, keys=["l_orderkey", "l_partkey", "l_linenumber"])


@query(
    "class_weights",
    "label int, rows bigint, weight double, total double",
    sql="""
SELECT label, count(*) AS rows, (SELECT count(*) FROM lineitem) / 2.0 / count(*) AS weight,
       (SELECT count(*) FROM lineitem) / 2.0 AS total
FROM (SELECT CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS label FROM lineitem) GROUP BY 1""",
)
def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Bank(spark, sf_dir).table("lineitem")
    labelled = rows.select(F.when(F.col("l_tax") == 0, 1).otherwise(0).alias("label"))
    return (
        model.class_weights(labelled, "label")
        .groupBy("label", "weight")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("total", F.col("rows") * F.col("weight"))
    )


@query(
    "tenure_features",
    "o_custkey bigint, avg_monthly_charge double, tenure_group string",
    sql="""
SELECT o_custkey, total / nullif(months, 0) AS avg_monthly_charge,
       CASE WHEN months < 12 THEN '0-12' WHEN months < 24 THEN '12-24' WHEN months < 48 THEN '24-48' ELSE '48+' END
         AS tenure_group
FROM (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
             (2001 - year(min(o_orderdate))) * 12 + 8 - month(min(o_orderdate)) AS months FROM orders GROUP BY 1)""",
)
def q_tenure_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min("d")
    months = (F.lit(2001) - F.year(first)) * 12 + F.lit(8) - F.month(first)
    per = Bank(spark, sf_dir).orders.groupBy("o_custkey").agg(F.sum("total").alias("total"), months.alias("months"))
    return model.tenure_features(per, total="total", tenure="months")


@query(
    "fraud_features",
    "event_id bigint, user_id bigint, amount_zscore double, velocity_score bigint, merchant_risk_score double",
    sql="""
SELECT event_id, user_id,
       (value - avg(value) OVER (PARTITION BY user_id)) / nullif(stddev_samp(value) OVER (PARTITION BY user_id), 0)
         AS amount_zscore,
       count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '86399999999 microseconds' PRECEDING
                      AND CURRENT ROW) AS velocity_score,
       avg(CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY event_type) AS merchant_risk_score
FROM events""",
)
def q_fraud_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Bank(spark, sf_dir).table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return model.fraud_features(
        events,
        row_id="event_id",
        entity="user_id",
        ts="ts",
        amount="value",
        merchant="event_type",
        label=F.col("value") >= 50,
    )
