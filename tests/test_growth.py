"""How often the plans read and repeat their larger side."""

import pytest

from ebbline.catalogue import features as catalogue
from ebbline.operators import features as fe
from ebbline.operators.related import related_accounts
from ebbline.plans import churn
from ebbline.session import tune

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return catalogue.tables(tune(spark), SF)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def test_transactions_are_read_once(tables):
    reads = [line for line in plan(catalogue._monthly(tables)) if "Filter" in line and "l_shipdate" in line]
    assert len(reads) == 1


def test_day_of_the_bridge_reaches_the_orders(tables):
    at_end = catalogue.tx.client_accounts(tables.bridge, end=catalogue.END)
    assert any("Filter" in line and "o_orderdate" in line and "2000-12-31" in line for line in plan(at_end))


def test_customers_meet_orders_before_lines(tables):
    rows = plan(tables.transactions)
    depth = {name: min(i for i, line in enumerate(rows) if f"[{name}#" in line and "Relation" in line) for name in ("l_orderkey", "c_custkey")}
    joins = [i for i, line in enumerate(rows) if "Join" in line]
    assert joins[0] < depth["l_orderkey"] < joins[1] < depth["c_custkey"]


def test_later_repayments_read_their_tables_once(tables):
    core = churn.core_blocks(tables, catalogue.RUN)
    later = fe.later_repayments(catalogue.ASOF, core.base, core.cmap, tables.account, core.paid)
    assert not any("Relation" in line for line in plan(later))


def test_ids_of_client_sets_are_numbers(tables):
    core = churn.core_blocks(tables, catalogue.RUN)
    found = related_accounts(catalogue.ASOF, core.base, core.cmap, tables.account)
    assert not any("concat_ws" in line for line in plan(found))


def test_assembly_reads_blocks_of_base_accounts_only(tables, monkeypatch):
    seen = {}
    monkeypatch.setattr(fe, "assemble", lambda base, **blocks: seen.update(blocks, base=base) or base)
    monkeypatch.setattr(fe, "later_repayments", lambda *a: None)
    core = churn.core_blocks(tables, catalogue.RUN)
    churn._assembled(tables, catalogue.RUN, core)
    for name in ("details", "securities", "changed"):
        assert seen[name].join(core.base, fe.KEY, "left_anti").isEmpty(), name


def test_group_means_read_clients_of_base_accounts_only(tables, monkeypatch):
    seen = []
    monkeypatch.setattr(fe, "group_means", lambda codes, details, income: seen.append(details))
    monkeypatch.setattr(catalogue, "tables", lambda spark, sf_dir: tables)
    catalogue.q_group_means(tables.account.sparkSession, SF)
    core = churn.core_blocks(tables, catalogue.RUN)
    assert seen[0].join(core.base, fe.KEY, "left_anti").isEmpty()


def test_what_is_told_of_a_line_is_told_before_its_shuffle(tables):
    """Neither the columns that classes rest on nor their labels go through the shuffles."""
    physical = catalogue._monthly(tables)._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(i for i, line in enumerate(physical) if "FileScan" in line and "l_partkey" in line)
    above = next(line for line in reversed(physical[:scan]) if "Project" in line)
    for column in ("l_suppkey", "l_partkey", "l_tax", "l_discount", "l_returnflag"):
        assert f"{column}#" in physical[scan] and f", {column}#" not in above, column
    assert any("_class#" in line for line in physical if "Exchange" in line)
    assert not any("IncomingPaymentType#" in line for line in physical if "Exchange" in line)


def test_bridge_of_the_last_day_is_worked_out_once(tables):
    scans = [line for line in catalogue._monthly(tables)._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and "l_suppkey" in line]
    assert len(scans) == 1


def test_unknown_class_labels_are_refused(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    row = spark.range(1).select(*[F.lit(v).cast("string").alias(c) for c, v in zip(catalogue.tx.CLASSES, ("Savings", "Fee", None, None))])
    with pytest.raises(PySparkException):
        row.select(catalogue.tx._class_code()).collect()
    every = spark.range(24).select(F.col("id").cast("int").alias("code"))
    labels = every.select("code", *[c.alias(n) for n, c in catalogue.tx._class_labels(F.col("code")).items()])
    assert all(r.code == r.back for r in labels.withColumn("back", catalogue.tx._class_code()).collect())
