"""What a long job writes on the way, and what it leaves on disk."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ebbline.catalogue import features as catalogue
from ebbline.catalogue import models
from ebbline.catalogue.bank import Bank
from ebbline.operators import features as fe
from ebbline.operators.related import related_accounts
from ebbline.plans import churn
from ebbline.session import DROP_SHUFFLES, Kept, shared_dir, tune

SEGMENTS = ["BUILDING", "BUILDING", "AUTOMOBILE", "MACHINERY", None]


def shuffled(spark) -> set[str]:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName().rsplit("_", 2)[0] for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def gone(spark, before: set[str]) -> bool:
    # Files are dropped in the background.
    for _ in range(50):
        if shuffled(spark) <= before:
            return True
        time.sleep(0.2)
    return False


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Repeated, unknown and missing customers, suppliers and orders."""
    tune(spark)
    at = str(tmp_path_factory.mktemp("odd"))
    day = lambda k: dt.datetime(1997, 12, 1) + dt.timedelta(days=11 * (k % 100))
    customers = [(k, f"c{k}", k % 25, 100.0 * k - 200, SEGMENTS[k % 5]) for k in range(12)]
    customers += [customers[1], (2, "again", 3, 7000.0, "HOUSEHOLD"), (None, "none", 1, 1.0, "BUILDING")]
    orders = [(k, None if k % 41 == 0 else k % 14, "FOP"[k % 3], 60000.0 + 7000 * (k % 23), day(k), f"{1 + k % 5}-X") for k in range(400)]
    orders += orders[3:6]
    lines = [
        (k % 420, None if k % 97 == 0 else k % 19, None if k % 89 == 0 else (k * 7) % 9, 1 + k % 5, float(k % 50), 10.0 * k, 0.01 * (k % 3), 0.02 * (k % 2), "ANR"[k % 3], "OF"[k % 2], day(k))
        for k in range(1500)
    ]
    tables = {
        "customer": (customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(k, f"s{k}", k % 25, 10.0 * k) for k in [*range(9), 4]], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(k, "p", "b", "SMALL", 1 + k % 4, 900.0 + k) for k in [*range(19), 5]], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def test_what_was_shuffled_for_a_kept_frame_goes_with_it(spark):
    before, mode = shuffled(spark), spark.conf.get(DROP_SHUFFLES)
    with Kept(spark) as keep:
        found = keep(spark.range(1000).repartition(7, "id"))
        assert gone(spark, before) and found.count() == 1000 and os.path.isdir(keep.path.removeprefix("file:"))
        empty = keep(spark.range(0).select(F.col("id").alias("n")))
        assert empty.columns == ["n"] and empty.isEmpty()
    assert not os.path.exists(keep.path.removeprefix("file:")) and spark.conf.get(DROP_SHUFFLES) == mode


def test_kept_tables_are_the_tables(spark, odd):
    plain, b = Bank(spark, odd), Bank(spark, odd)
    names = ["account", "account_now", "bridge", "client", "security_bridge", "security", "address", "offset_bridge", "activity", "transactions", "customer_history", "market"]
    with b.kept():
        # Lines and orders are joined once.
        assert not any("l_orderkey" in getattr(b, n)._jdf.queryExecution().optimizedPlan().toString() for n in names)
        for name in names:
            assert rows(getattr(b, name)) == rows(getattr(plain, name)), name


def test_kept_blocks_are_the_blocks_and_leave_no_shuffles(spark, odd):
    t, run = catalogue.tables(spark, odd), catalogue.RUN
    plain = churn.core_blocks(t, run)
    before = shuffled(spark)
    with Kept(spark) as keep:
        core = churn.core_blocks(t, run, keep=keep)
        assert gone(spark, before)
        for name in ("base", "income", "codes", "held"):
            assert rows(getattr(core, name)) == rows(getattr(plain, name)), name
        assert not core.base.isEmpty()
        some = fe.of_channels(core.base, t.loan_repayment)
        held = core.held.join(some.select(*fe.KEY), fe.KEY, "left_semi")
        for block in (fe.total_repayments, fe.later_repayments):
            assert rows(block(run.asof, some, core.cmap, t.account, core.paid, held)) == rows(block(run.asof, some, core.cmap, t.account, plain.paid))
        found = related_accounts(run.asof, some, core.cmap, t.account, held=held, keep=keep)
        assert rows(found) == rows(related_accounts(run.asof, some, core.cmap, t.account))


def test_training_starts_without_what_the_features_were_made_from(spark, odd, monkeypatch):
    class Started(Exception):
        pass

    def start(table, **_):
        assert not table.isEmpty()
        raise Started

    monkeypatch.setattr(churn, "train_job", start)
    before = shuffled(spark)
    with pytest.raises(Started):
        models.q_rf_train_score(spark, odd)
    # Those of the write of the feature table alone: rows by bucket, and buckets by date.
    assert len(shuffled(spark) - before) <= 8
    assert not [f for f in os.listdir(shared_dir(spark).removeprefix("file:")) if f.startswith("kept-")]
