"""Plans must keep the properties the operators are designed for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbline.functions.dates import at_snapshot, month_ends
from ebbline.catalogue.features import ASOF, tables
from ebbline.operators import drift, quality
from ebbline.operators import features as fe
from ebbline.operators import transactions as tx
from ebbline.operators.joins import valid_at
from ebbline.sources import io

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark, SF)


def test_snapshot_filter_reaches_the_scan_and_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = spark.range(40).select(
        "id", F.date_add(F.lit(dt.date(1997, 12, 20)), F.col("id").cast("int")).alias("EndOfDayDate")
    )
    io.overwrite(rows, path, ("EndOfDayDate",))
    df = at_snapshot(io.read_table(spark, path), ASOF)
    text = plan(df)
    assert "PartitionFilters: [isnotnull" in text or "PartitionFilters: [EndOfDayDate" in text
    assert "Join" not in text and "Exchange" not in text
    assert df.count() == 1


def test_validity_joins_dates_by_month_without_a_shuffle(spark, t):
    loans = spark.range(1).select(
        F.lit(dt.date(1990, 1, 1)).alias("RowStartDate"), F.lit(None).cast("date").alias("RowEndDate")
    )
    text = plan(valid_at(loans, ASOF, run_date=dt.date(2001, 1, 1)))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "NestedLoop" not in text
    assert "lambda" not in text


def test_blocks_have_no_nested_loop_and_no_single_partition(spark, t):
    cmap = fe.client_map(ASOF, t.bridge)
    paid = fe.instalments(ASOF, t.loans, run_date=dt.date(2001, 8, 2))
    base = fe.base_population(ASOF, t.account, paid)
    frames = [
        base,
        fe.client_details(ASOF, cmap, t.client),
        fe.collateral(ASOF, t.security_bridge, t.security),
        fe.attribute_changed(ASOF, t.address, cmap),
        fe.total_repayments(ASOF, base, cmap, t.account, paid),
        fe.declared_income(ASOF, base, t.applications, t.serviceability, run_date=dt.date(2001, 8, 2)),
        tx.transaction_trends(
            tx.spine_pivot(
                tx.monthly_transactions(
                    tx.classify_transactions(t.transactions),
                    tx.loan_clients(t.account, t.bridge, start=dt.date(1997, 1, 1), end=dt.date(2001, 1, 1)),
                    tx.client_accounts(t.bridge, end=dt.date(2001, 1, 1)),
                    start=dt.date(1997, 1, 1),
                    end=dt.date(2001, 1, 1),
                ),
                month_ends(t.calendar, dt.date(1997, 1, 1), dt.date(2001, 1, 1)),
            )
        ),
    ]
    for df in frames:
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "SinglePartition" not in text


def test_quality_is_one_pass_and_reads_needed_columns_only(spark):
    df = io.read_table(spark, f"{SF}/lineitem.parquet").select("l_tax", "l_quantity")
    text = plan(quality.check_missing_values(df))
    assert text.count("FileScan") == 1
    assert "l_comment" not in text and "l_shipdate" not in text


def test_drift_statistics_read_each_side_once(spark):
    df = io.read_table(spark, f"{SF}/lineitem.parquet")
    text = plan(drift.value_counts(df, df, ["l_tax", "l_discount"]))
    assert text.count("FileScan") == 2 and "l_shipdate" not in text
