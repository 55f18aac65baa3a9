"""Related accounts against brute force, and hot clients without pairs."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbline.operators.related import NAMES, related_totals

KINDS = ["Transaction", "Savings", "Home Loan", "Credit Card", "Personal Loan", "Term Share"]


def world(seed, accounts, clients, hot_clients, most):
    """Every third account is held by a hot client."""
    rnd = random.Random(seed)
    held = defaultdict(set)
    for a in range(accounts):
        for _ in range(rnd.randint(1, most)):
            held[a].add(rnd.randrange(clients))
        if a % 3 == 0:
            held[a].update(rnd.sample(range(hot_clients), rnd.randint(1, hot_clients)))
    attrs = {
        a: (rnd.choice(["Open", "Closed"]), rnd.choice(KINDS), None if a % 17 == 0 else Decimal(a) + Decimal("0.25"))
        for a in range(accounts)
    }
    return held, attrs


def brute(held, attrs, base):
    out = {}
    for b in base:
        rel = [a for a in held if held[a] & held[b]]
        t = dict.fromkeys(NAMES, 0)
        for a in rel:
            status, kind, bal = attrs[a]
            is_open = status == "Open"
            holds = is_open and kind in ("Savings", "Transaction", "Term Share")
            owes = is_open and kind in ("Personal Loan", "Home Loan")
            t["n_all"] += 1
            t["n_open"] += is_open
            t["n_closed"] += not is_open
            t["held"] += bal if holds and bal is not None else 0
            t["n_held"] += holds and bal is not None
            t["owed"] += bal if owes and bal is not None else 0
            t["n_owed"] += owes and bal is not None
            t["n_txn"] += is_open and kind == "Transaction"
            t["n_sav"] += is_open and kind in ("Savings", "Term Share")
            t["n_lend"] += is_open and kind in ("Credit Card", "Personal Loan", "Home Loan")
        out[b] = t
    return out


def frames(spark, held, attrs, base):
    members = spark.createDataFrame(
        [("2000-01-31", str(c), str(a), *attrs[a]) for a in held for c in held[a]],
        "as_of_date string, client string, related string, status string, kind string, balance decimal(18,2)",
    )
    base_rows = spark.createDataFrame(
        [("2000-01-31", str(b), str(c)) for b in base for c in held[b]],
        "as_of_date string, account string, client string",
    )
    return base_rows, members


def totals(spark, held, attrs, base):
    base_rows, members = frames(spark, held, attrs, base)
    # Repeated rows and rows without a client change nothing.
    members = members.unionByName(members.limit(20)).unionByName(members.limit(1).withColumn("client", F.lit(None)))
    found = related_totals(base_rows.unionByName(base_rows.limit(9)), members).collect()
    assert len({r.account for r in found}) == len(found)
    return {int(r.account): {n: r[n] for n in NAMES} for r in found}


@pytest.mark.parametrize("seed,hot_clients,most", [(5, 3, 6), (6, 1, 2), (7, 5, 1), (8, 2, 9)])
def test_equals_brute_force(spark, seed, hot_clients, most):
    held, attrs = world(seed, accounts=60, clients=25, hot_clients=hot_clients, most=most)
    base = list(range(0, 60, 2))
    assert totals(spark, held, attrs, base) == brute(held, attrs, base)


def test_sets_of_many_clients(spark):
    """Large sets that are equal, that contain each other, and that meet in one client."""
    held = {0: set(range(12)), 1: set(range(12)), 2: set(range(6)), 3: {11, 40, 41, 42, 43, 44}, 4: {0, 40}, 5: {50}, 6: {50, 3, 7}}
    attrs = {a: ("Open", "Savings", Decimal(10**a)) for a in held}
    assert totals(spark, held, attrs, list(held)) == brute(held, attrs, list(held))


def test_no_related_account_gives_no_row(spark):
    base, members = frames(spark, {0: {1}, 1: {2}}, {0: ("Open", "Savings", None), 1: ("Open", "Savings", None)}, [0, 1])
    found = related_totals(base, members.filter("client = '1'"))
    assert [(r.account, r.n_all, r.n_held) for r in found.collect()] == [("0", 1, 0)]
    assert related_totals(base, members.limit(0)).isEmpty()


def hot(spark, n, clients=("hot",)):
    """The given clients on n accounts, each shared with a client of its own."""
    rows = spark.range(n).select(
        F.lit("d").alias("as_of_date"),
        F.explode(F.array(*map(F.lit, clients), F.concat(F.lit("p"), F.col("id")))).alias("client"),
        F.col("id").cast("string").alias("related"),
        F.lit("Open").alias("status"),
        F.lit("Savings").alias("kind"),
        F.lit(1).cast("decimal(18,2)").alias("balance"),
    )
    return rows.select("as_of_date", F.col("related").alias("account"), "client"), rows


@pytest.mark.parametrize("clients", [("hot",), ("hot", "hotter")])
def test_hot_clients_on_a_hundred_thousand_accounts(spark, clients):
    """Every account has a set of its own; pairing them would take ten thousand million rows."""
    n = 100_000
    out = related_totals(*hot(spark, n, clients))
    assert out.agg(F.count("*"), F.min("n_all"), F.max("n_all"), F.min("held"), F.max("held")).first()[:] == (n, n, n, n, n)


def test_no_job_before_the_result_is_asked_for(spark):
    base, members = hot(spark, 10)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    related_totals(base, members)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
