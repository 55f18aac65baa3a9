"""Model metrics from a scored table (ML3, ML4, X4, X5, X8, X9)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.scalars import ratio
from ebbline.operators.ordered import prefix_sums


def auc(scored: DataFrame, *, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counting one half (ML3): keys, n_pos, n_neg, auc.

    Rows are counted per score first; a pair (positive, negative) is then won by every
    negative with a lower score, which is a running sum.  NULL with only one class.
    """
    keys = list(keys)
    pos = F.when(F.col(label) == 1, 1).otherwise(0).cast("bigint")
    per_score = (
        scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).alias("_score"))
        .agg(F.sum(pos).alias("n_pos"), F.sum(1 - pos).alias("n_neg"))
    )
    cum = prefix_sums(per_score, keys, ["_score"], ["n_neg"])
    # Twice the number of won pairs stays an integer.
    won = F.col("n_pos").cast("decimal(20,0)") * (2 * F.col("cum_n_neg") - F.col("n_neg")).cast("decimal(18,0)")
    return (
        cum.withColumn("_won", won)
        .groupBy(*keys)
        .agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"), F.sum("_won").alias("_won"))
        .withColumn(
            "auc",
            ratio(F.col("_won").cast("double"), 2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")),
        )
        .drop("_won")
    )


def confusion(scored: DataFrame, *, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """label, prediction, rows."""
    return scored.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    b2 = beta * beta
    return ratio((1 + b2) * precision * recall, b2 * precision + recall)


def threshold_metrics(
    scored: DataFrame,
    *,
    label: str = "label",
    prediction: str = "prediction",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, precision, recall, F1 and F2 in one aggregation, also per segment."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = scored.groupBy(*keys).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (
        counts.withColumn("accuracy", ratio(tp + tn, tp + tn + fp + fn))
        .withColumn("precision", ratio(tp, tp + fp))
        .withColumn("recall", ratio(tp, tp + fn))
        .withColumn("f1", f_beta(F.col("precision"), F.col("recall"), 1.0))
        .withColumn("f2", f_beta(F.col("precision"), F.col("recall"), 2.0))
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Frames of one row each, side by side."""
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def metric_gate(metrics: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """metric, value, threshold, passed (ML4).  A missing metric counts as 0.

    ``metrics`` is one row with a column per metric.
    """
    entries = [
        F.struct(
            F.lit(m).alias("metric"),
            F.coalesce(F.col(m).cast("double") if m in metrics.columns else F.lit(None).cast("double"), F.lit(0.0)).alias("value"),
            F.lit(float(t)).alias("threshold"),
        )
        for m, t in thresholds.items()
    ]
    return (
        metrics.select(F.explode(F.array(*entries)).alias("_e"))
        .select("_e.*")
        .withColumn("passed", F.col("value") >= F.col("threshold"))
    )


def passes(gate: DataFrame) -> bool:
    """True when every threshold holds; reads one row."""
    return bool(gate.agg(F.min("passed")).first()[0])


def score_monitor(
    scores: DataFrame,
    *,
    score: str = "churn_score",
    batch: str = "score_batch_id",
    baseline: float | None = None,
) -> DataFrame:
    """Volume, mean and spread of the scores per batch."""
    out = scores.groupBy(batch).agg(
        F.count(F.lit(1)).alias("predictions"),
        F.avg(score).alias("mean_score"),
        F.stddev_samp(score).alias("std_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    if baseline is not None:
        out = out.withColumn("mean_shift", F.col("mean_score") - F.lit(float(baseline)))
    return out
