"""Training, splitting, rebalancing and batch scoring (ML1-ML9, X6, X7, X10-X12)."""

from __future__ import annotations

import datetime as dt
import math
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.functions.scalars import ratio
from ebbline.operators.ordered import prefix_sums
from ebbline.operators.quality import missing_columns

# Places of a category column in the feature vector, for each of its two hashes.
SLOTS = 32


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric and boolean, string) feature names."""
    fields = [f for f in df.schema if f.name not in set(exclude)]
    numeric = [f.name for f in fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def prepare(df: DataFrame, numeric: Sequence[str], text: Sequence[str], blank: Sequence[str] = ()) -> DataFrame:
    """Numeric features as double with a flag where they are missing; text with missing as
    its own category, and once more under another hash.  ``blank`` columns count as zero."""
    casts: dict[str, Column] = {}
    for c in numeric:
        v = F.col(c).cast("double")
        casts[c] = v
        casts[f"{c}__m"] = (v.isNull() | F.isnan(v)).cast("double")
        if c in blank:
            casts[f"{c}__f"] = F.lit(0.0)
    for c in text:
        v = F.coalesce(F.col(c), F.lit("(missing)"))
        casts[c] = v
        casts[f"{c}__2"] = F.reverse(F.concat(v, F.lit("/2")))
    return df.withColumns(casts)


def train_forest(
    df: DataFrame,
    *,
    label: str,
    exclude: Sequence[str] = (),
    trees: int = 100,
    depth: int = 15,
    min_leaf: int = 1,
    seed: int = 42,
    weight: str | None = None,
    slots: int = SLOTS,
) -> PipelineModel:
    """Encode, impute, assemble and fit a random forest on the executors (ML1, ML2).

    A category column becomes up to ``slots`` places under each of two hashes, so any number of
    categories is taken and no list of them is held; two categories that share a place
    under one hash are told apart by the other.  Missing numbers get the mean and a flag.
    A column without any value stays in the model, as zero with its flag.
    """
    numeric, text = feature_columns(df, [label, *exclude, *([weight] if weight else [])])
    # One number per column: how many values, or about how many categories it has.
    counts = [F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in numeric]
    kinds = [F.approx_count_distinct(c).alias(c) for c in text]
    known = df.agg(*counts, *kinds).first() if counts or kinds else {}
    blank = [c for c in numeric if known[c] == 0]
    filled = [c for c in numeric if known[c] > 0]
    rows = prepare(df, numeric, text, blank).withColumn(label, F.col(label).cast("double"))
    # Few categories take few places, so that they do not crowd out the other features.
    places = {c: min(slots, 2 << known[c].bit_length()) for c in text}
    stages: list = [
        FeatureHasher(inputCols=[source], outputCol=out, numFeatures=places[c], categoricalCols=[source])
        for c in text
        for source, out in ((c, f"{c}__v"), (f"{c}__2", f"{c}__w"))
    ]
    if filled:
        stages.append(Imputer(inputCols=filled, outputCols=[f"{c}__f" for c in filled], strategy="mean"))
    inputs = [f"{c}__{k}" for c in numeric for k in "fm"] + [f"{c}__{k}" for c in text for k in "vw"]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features__", handleInvalid="keep"))
    forest = RandomForestClassifier(
        labelCol=label,
        featuresCol="features__",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
        probabilityCol="probability__",
        rawPredictionCol="raw__",
        predictionCol="prediction",
        cacheNodeIds=False,
    )
    if weight:
        forest = forest.setWeightCol(weight)
    return Pipeline(stages=[*stages, forest]).fit(rows)


def stored(fitted: PipelineModel, path: str) -> PipelineModel:
    """Write the model and read it back.

    What comes back is what a scoring job loads: it no longer carries the training summary,
    which holds the session and cannot go to tasks of an observed write.
    """
    fitted.write().overwrite().save(path)
    return PipelineModel.load(path)


def _inputs(model: PipelineModel) -> tuple[list[str], list[str], list[str]]:
    """(numeric, text, blank) features of a fitted model."""
    inputs = next(s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler))
    filled = {c for s in model.stages if s.__class__.__name__ == "ImputerModel" for c in s.getInputCols()}
    numeric = [c[:-3] for c in inputs if c.endswith("__f")]
    return numeric, [c[:-3] for c in inputs if c.endswith("__v")], [c for c in numeric if c not in filled]


def required_features(model: PipelineModel) -> list[str]:
    numeric, text, _ = _inputs(model)
    return numeric + text


def feature_importance(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """feature, importance, summed over the flag of a number and the slots of a category."""
    scored = model.transform(prepare(sample, *_inputs(model)))
    attrs = scored.schema["features__"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    weights = model.stages[-1].featureImportances.toArray()
    totals: dict[str, float] = {}
    for i, w in enumerate(weights):
        feature = names[i].rsplit("__", 1)[0]
        totals[feature] = totals.get(feature, 0.0) + float(w)
    return sample.sparkSession.createDataFrame(
        sorted(totals.items(), key=lambda kv: -kv[1]), "feature string, importance double"
    )


def score(model: PipelineModel, features: DataFrame, name: str = "churn_score") -> DataFrame:
    """Features plus the probability of class 1 (ML5).  Missing inputs raise."""
    gone = missing_columns(features, required_features(model))
    if gone:
        raise ValueError(f"missing feature columns: {gone}")
    # Prepared copies go in under the model's names; the caller's columns come back as they were.
    kept = features.select("*", F.struct(*[F.col(c) for c in features.columns]).alias("row__"))
    out = model.transform(prepare(kept, *_inputs(model)))
    # A model that saw one class only has no second entry.
    p = F.coalesce(F.get(vector_to_array("probability__"), F.lit(1)), F.lit(0.0))
    return out.select("row__.*", p.alias(name))


def score_with(
    predict: Callable[[pd.DataFrame], "pd.Series"], features: DataFrame, name: str = "churn_score"
) -> DataFrame:
    """Scores of any other model, batch by batch on the executors (ML5).

    ``predict`` gets a pandas frame and returns the probability of class 1 per row.
    """
    schema = T.StructType([*features.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{name: predict(batch)})

    return features.mapInPandas(run, schema)


def stamp(
    scored: DataFrame,
    *,
    model_name: str,
    model_version: str,
    run_id: str,
    scored_at: dt.datetime,
    batch_id: str,
) -> DataFrame:
    """Lineage and batch columns (ML6, ML7)."""
    return scored.withColumns(
        {
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
            "run_id": F.lit(run_id),
            "scored_at": F.lit(scored_at),
            "score_batch_id": F.lit(batch_id),
        }
    )


def key_digest(keys: Sequence[str]) -> Column:
    """md5 of the keys as text, joined by a bar; every engine can state it again."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).cast("binary"))


def _digest_cut(df: DataFrame, keys: Sequence[str], quota: Column) -> DataFrame:
    """One row, ``_cut``: the digest of the first key that does not fit into ``quota`` rows in
    digest order, NULL when all fit.  ``quota`` may use ``_total``, the number of rows."""
    counts = df.groupBy(key_digest(keys).alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    # One row each.
    return (
        prefix_sums(counts, [], ["_digest"], ["_n"])
        .join(F.broadcast(total))
        .agg(F.min(F.when(F.col("cum__n") > quota, F.col("_digest"))).alias("_cut"))
    )


def hash_split(df: DataFrame, keys: Sequence[str], train_pct: int = 80) -> DataFrame:
    """Add ``split``: the first ``train_pct`` percent of the rows in order of the key's digest
    (rounded down) are for training (X6).  Rows of one key stay on one side."""
    cut = _digest_cut(df, keys, F.floor(F.col("_total") * train_pct / 100))
    inside = F.coalesce(key_digest(keys) < F.col("_cut"), F.lit(True))
    return df.join(F.broadcast(cut)).withColumn("split", F.when(inside, "train").otherwise("test")).drop("_cut")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add a weight that gives both classes half of the total."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    n, pos = counts["n"], counts["pos"]
    w1, w0 = (n / (2 * pos) if pos else 1.0), (n / (2 * (n - pos)) if n > pos else 1.0)
    return df.withColumn(name, F.when(F.col(label) == 1, w1).otherwise(w0))


def rebalance(df: DataFrame, label: str, minority_share: float = 0.5, *, keys: Sequence[str]) -> DataFrame:
    """Thin the larger class until the smaller one has ``minority_share``.

    Of the larger class the first rows in order of the key's digest stay, exactly as many
    as the share allows, so the choice is the same in every run and task retry.
    """
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    small = min(counts["pos"], counts["n"] - counts["pos"])
    minority = 1 if counts["pos"] == small else 0
    want = math.floor(small * (1 - minority_share) / minority_share + 1e-9)
    larger = df.filter(F.coalesce(F.col(label) != minority, F.lit(True)))
    cut = _digest_cut(larger, keys, F.lit(want))
    inside = F.coalesce(key_digest(keys) < F.col("_cut"), F.lit(True))
    return df.join(F.broadcast(cut)).filter(F.coalesce(F.col(label) == minority, F.lit(False)) | inside).drop("_cut")


def tenure_features(
    df: DataFrame, *, total: str = "total_charges", tenure: str = "tenure_months", edges: Sequence[int] = (12, 24, 48)
) -> DataFrame:
    """Average monthly charge and tenure group."""
    bounds = [0, *edges]
    group: Column = F.lit(f"{edges[-1]}+")
    for lo, hi in reversed(list(zip(bounds, edges))):
        group = F.when(F.col(tenure) < hi, F.lit(f"{lo}-{hi}")).otherwise(group)
    return df.withColumn("avg_monthly_charge", ratio(F.col(total), F.col(tenure))).withColumn(
        "tenure_group", F.when(F.col(tenure).isNotNull(), group)
    )


def fraud_features(
    df: DataFrame,
    *,
    row_id: str,
    entity: str,
    ts: str,
    amount: str,
    merchant: str,
    label: Column,
    hours: int = 24,
) -> DataFrame:
    """Amount z-score, velocity and merchant risk per event (X11).

    The z-score and the risk come from an aggregate joined back, so a hot entity or merchant
    is reduced before the shuffle.  Velocity counts an entity's events in the ``hours`` up
    to and including the event: the events up to its instant, less those up to ``hours``
    before.  Both counts come from one running sum per entity over its instants and over
    probes ``hours`` before them, so a hot entity or a hot hour is spread over buckets.
    Events of one instant are merged first.
    """
    v = F.col(amount).cast("double")
    per_entity = df.groupBy(entity).agg(F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_std"))
    risk = df.groupBy(merchant).agg(F.avg(F.when(label, 1.0).otherwise(0.0)).alias("merchant_risk_score"))

    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    span = hours * 3600 * 1_000_000
    instants = df.groupBy(entity, micros.alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    probes = instants.select(entity, (F.col("_t") - span).alias("_t"), F.lit(0).cast("bigint").alias("_n"), F.lit(1).alias("_probe"))
    # An event at the probe's own instant is outside: it comes first.
    counted = prefix_sums(instants.withColumn("_probe", F.lit(0)).unionByName(probes), [entity], ["_t", "_probe"], ["_n"])
    signed = F.when(F.col("_probe") == 0, F.col("cum__n")).otherwise(-F.col("cum__n"))
    velocity = (
        counted.select(entity, (F.col("_t") + F.col("_probe") * F.lit(span)).alias("_t"), signed.alias("_n"))
        .groupBy(entity, "_t")
        .agg(F.sum("_n").alias("velocity_score"))
    )
    return (
        df.withColumn("_t", micros)
        .join(per_entity, entity)
        .join(risk, merchant)
        .join(velocity, [entity, "_t"])
        .select(
            row_id,
            entity,
            ratio(v - F.col("_mean"), F.col("_std")).alias("amount_zscore"),
            "velocity_score",
            "merchant_risk_score",
        )
    )
