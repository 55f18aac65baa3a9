"""The churn jobs: build features, train, score, watch drift (IO6, ML8, ML9, DR8)."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, replace
from typing import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.dates import AsOf, at_snapshot, month_ends
from ebbline.operators import drift, features, metrics, model
from ebbline.operators.joins import capped_lookup
from ebbline.operators.related import related_accounts
from ebbline.operators.transactions import transaction_features
from ebbline.session import Kept, shared_dir
from ebbline.sources import io


@dataclass(frozen=True)
class ChurnTables:
    """The source tables, one brand and source each (see ``features.one_source``)."""

    account: DataFrame
    account_now: DataFrame
    bridge: DataFrame
    client: DataFrame
    security_bridge: DataFrame
    security: DataFrame
    address: DataFrame
    offset_bridge: DataFrame
    activity: DataFrame
    transactions: DataFrame
    calendar: DataFrame
    loans: DataFrame
    applications: DataFrame
    serviceability: DataFrame
    customer_history: DataFrame
    market: DataFrame
    rates: DataFrame
    loan_repayment: DataFrame


@dataclass(frozen=True)
class ChurnRun:
    asof: AsOf
    run_date: dt.date
    start: dt.date
    end: dt.date
    lookup_cap: dt.date


def market_lookup(t: ChurnTables, run: ChurnRun) -> DataFrame:
    """House market of the capped month, per postcode."""
    houses = t.market.filter(F.col("Property_Type") == "H").withColumn(
        "PostCode", F.col("Postcode").cast("string")
    )
    return capped_lookup(
        run.asof, houses, cap=run.lookup_cap, month_col="Month_end", keys=["PostCode"], columns=features.MARKET_COLUMNS
    )


def rate_lookup(t: ChurnTables, run: ChurnRun) -> DataFrame:
    return capped_lookup(run.asof, t.rates, cap=run.lookup_cap, month_col="Month", columns=["FLRHOOVA"])


Keep = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Core:
    """The blocks that several others read."""

    paid: DataFrame
    base: DataFrame
    cmap: DataFrame
    details: DataFrame
    income: DataFrame
    codes: DataFrame
    # The client map of the base population, for blocks that read no other accounts.
    held: DataFrame


def core_blocks(t: ChurnTables, run: ChurnRun, *, keep: Keep | None = None) -> Core:
    """With ``keep`` each block that others read is written once, instalments those of accounts
    with a snapshot, which nothing reads beyond."""
    asof = run.asof
    paid = features.instalments(asof, t.loans, run_date=run.run_date)
    if keep:
        accounts = at_snapshot(t.account, asof).select("as_of_date", F.expr("try_cast(AccountNumber as bigint)").alias("ACC_NO"))
        paid = paid.join(accounts, ["as_of_date", "ACC_NO"], "left_semi")
    else:
        keep = _as_is
    paid = keep(paid)
    base = keep(features.base_population(asof, t.account, paid))
    cmap = features.client_map(asof, t.bridge)
    held = keep(cmap.join(base.select(*features.KEY), features.KEY, "left_semi"))
    details = features.client_details(asof, cmap, t.client)
    income = keep(features.declared_income(asof, base, t.applications, t.serviceability, run_date=run.run_date))
    codes = keep(features.valid_attribute(asof, base, held, t.customer_history, run_date=run.run_date))
    return Core(paid, base, cmap, details, income, codes, held)


def _as_is(df: DataFrame) -> DataFrame:
    return df


def build_features(t: ChurnTables, run: ChurnRun) -> DataFrame:
    """Account trends, transaction trends and the assembled model input (IO6).

    Blocks are made one after the other, and what was shuffled for one goes before the next, so
    the largest block takes the disk and not all together.  The rate tile at the end cuts the
    lineage in the shared folder, so what was kept for the build goes before returning.
    """
    with Kept(t.account.sparkSession) as keep:
        days = [*run.asof.snapshots, run.end - dt.timedelta(days=1)]
        t = replace(t, bridge=keep(t.bridge.filter(F.col("EndOfDayDate").isin(days))))
        return _assembled(t, run, core_blocks(t, run, keep=keep), keep)


def _assembled(t: ChurnTables, run: ChurnRun, core: Core, keep: Keep = _as_is) -> DataFrame:
    asof, cmap = run.asof, core.cmap
    details = keep(features.client_details(asof, core.held, t.client))
    means = features.group_means(core.codes, details, core.income)
    income = features.impute_from_groups(core.income, core.codes, means)
    # Means are over the whole base; other blocks are of the accounts that are assembled.
    base = keep(features.of_channels(core.base, t.loan_repayment))
    keys = base.select(*features.KEY)
    held = keep(core.held.join(keys, features.KEY, "left_semi"))
    pledged = t.security_bridge.join(keys.withColumnRenamed("as_of_date", "EndOfDayDate"), ["EndOfDayDate", "AccountNumber"], "left_semi")
    return features.assemble(
        base,
        details=details,
        securities=features.collateral(asof, keep(pledged), t.security),
        market=market_lookup(t, run),
        rates=rate_lookup(t, run),
        changed=features.attribute_changed(asof, t.address, held),
        related=related_accounts(asof, base, cmap, t.account, held=held, keep=keep),
        logins=features.activity_change(
            asof,
            held,
            t.activity,
            measures={
                "InternetBankingLogonCountMTD": "WebLoginsRelChange",
                "MobileBankingLogonCountMTD": "ApploginsRelChange",
            },
        ),
        income=income,
        repayments=features.total_repayments(asof, base, cmap, t.account, core.paid, held),
        later=features.later_repayments(asof, base, cmap, t.account, core.paid, held),
        account_trend=features.account_features(
            t.account, t.offset_bridge, start=run.start, end=run.end - dt.timedelta(days=1)
        ),
        transaction_trend=transaction_features(
            t.account,
            t.bridge,
            t.transactions,
            month_ends(t.calendar, run.start, run.end),
            start=run.start,
            end=run.end,
            keep_unlinked=False,
        ),
        loan_repayment=t.loan_repayment,
        label=features.outcome_label(asof, base, t.account_now, run_date=run.run_date),
        keep=keep,
    )


def with_split(built: DataFrame, asof: AsOf) -> DataFrame:
    """Attach the train/test split of each as-of date."""
    frame = asof.frame(built.sparkSession).select("as_of_date", "split")
    return built.join(F.broadcast(frame), "as_of_date")


def train_job(
    table: DataFrame,
    *,
    label: str = "ChurnedIn90D",
    exclude: Sequence[str] = ("as_of_date", "AccountNumber", "split"),
    cut: float = 0.5,
    model_path: str | None = None,
    **forest,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training split, store the model, measure on the test split (ML9).

    The metrics are one row: auc, accuracy, precision, recall, f1, f2.
    """
    known = table.filter(F.col(label).isNotNull())
    train = io.require_rows(known.filter(F.col("split") == "train"), "training split")
    path = model_path or f"{shared_dir(table.sparkSession)}/model-{uuid.uuid4().hex}"
    fitted = model.stored(model.train_forest(train, label=label, exclude=exclude, **forest), path)
    scored = model.score(fitted, known.filter(F.col("split") == "test"), "score").withColumn(
        "prediction", (F.col("score") >= cut).cast("int")
    )
    ranked = metrics.auc(scored, label=label, score="score")
    cuts = metrics.threshold_metrics(scored, label=label)
    row = metrics.one_row(ranked.select("auc"), cuts)
    return fitted, row


def score_job(
    fitted: PipelineModel,
    table: DataFrame,
    target: str,
    *,
    lineage: Mapping[str, str],
    scored_at: dt.datetime,
    batch_id: str,
) -> int:
    """Score, stamp and upsert one batch in a single write; returns the row count (ML8)."""
    scored = model.stamp(model.score(fitted, table), scored_at=scored_at, batch_id=batch_id, **lineage)
    return io.upsert_batch(scored, target, batches=[batch_id])


def baseline_job(table: DataFrame, target: str) -> int:
    """Store mean and deviation of every numeric column (DR1); returns the row count."""
    return io.overwrite(drift.baseline_stats(table, drift.split_columns(table)[0]), target)


def drift_job(
    spark: SparkSession,
    baseline: str,
    current: DataFrame,
    target: str,
    *,
    environment: str,
    run_id: str,
    threshold: float = 3.0,
) -> int:
    """Compare a table with the stored baseline and keep the rows under ``run_id`` (DR8, IO10).

    A run that is repeated replaces its own rows and no others.
    """
    rows = drift.zscore_drift(io.read_baseline(spark, baseline), current, environment=environment, threshold=threshold)
    return io.upsert_batch(rows.withColumn("run_id", F.lit(run_id)), target, "run_id", batches=[run_id])
