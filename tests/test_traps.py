"""Hand-made frames for each semantic trap."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.functions.dates import AsOf, add_months, age_years, asof_dates, at_month_series, month_diff, monthly
from ebbline.functions.scalars import bucket_label, greatest_or_null, least_or_null, ratio, remap
from ebbline.operators import features as fe
from ebbline.operators import transactions as tx
from ebbline.operators.joins import capped_lookup, latest_as_of, valid_at
from ebbline.operators.trends import Frames, account_trends, regression_slope, time_axis

D = dt.date


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_month_difference_counts_boundaries(spark):
    def diff(a, b):
        return one(spark, month_diff(F.lit(a), F.lit(b)))[0]

    assert diff(D(2020, 2, 1), D(2020, 1, 31)) == 1
    assert diff(D(2021, 1, 31), D(2020, 12, 1)) == 1
    assert diff(D(2020, 1, 31), D(2020, 1, 1)) == 0


def test_age_uses_day_of_year(spark):
    def age(at, born):
        return one(spark, age_years(F.lit(at), F.lit(born)))[0]

    assert age(D(2021, 3, 1), D(2000, 3, 1)) == 20  # day 60 < day 61 of a leap year
    assert age(D(2021, 3, 2), D(2000, 3, 1)) == 21
    assert age(D(2020, 2, 29), D(2000, 2, 29)) == 20


def test_month_series_clips_and_returns(spark):
    assert monthly(D(2020, 1, 31), D(2020, 4, 30)) == [D(2020, 1, 31), D(2020, 2, 29), D(2020, 3, 31), D(2020, 4, 30)]
    assert add_months(D(2020, 3, 31), -1) == D(2020, 2, 29)
    want = spark.sql("select explode(sequence(date'2019-10-31', date'2020-06-30', interval 1 month)) d")
    assert [r.d for r in want.collect()] == monthly(D(2019, 10, 31), D(2020, 6, 30))


def test_asof_rejects_overlap_and_reads_series(spark):
    with pytest.raises(ValueError):
        asof_dates(train=(D(2020, 1, 1), D(2020, 3, 1)), test=(D(2020, 3, 1), D(2020, 4, 1)))
    asof = asof_dates(train=(D(2020, 3, 1), D(2020, 3, 1)))
    df = spark.createDataFrame([(D(2020, 1, 31),), (D(2020, 2, 28),), (D(2020, 2, 29),)], "EndOfDayDate date")
    got = {(r.EndOfDayDate, r.as_of_date) for r in at_month_series(df, asof, 2).collect()}
    assert got == {(D(2020, 1, 31), D(2020, 2, 29)), (D(2020, 2, 29), D(2020, 2, 29))}


def test_null_aware_extremes_and_ratio(spark):
    r = one(
        spark,
        greatest_or_null(F.lit(1), F.lit(None).cast("int")),
        least_or_null(F.lit(1), F.lit(2)),
        ratio(F.lit(1), F.lit(0)),
        bucket_label(F.lit(123456.7), 50000),
        bucket_label(F.lit(Decimal("100000.00")), 50000),
        remap(F.lit("Pay Tax"), {"x": ["Pay Tax"]}),
        remap(F.lit("else"), {"x": ["Pay Tax"]}),
    )
    assert tuple(r) == (None, 1, None, "100000-149999", "100000-149999", "x", "else")


def series(spark, values):
    rows = [("a", D(1970, 1, 1) + dt.timedelta(days=i + 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, d date, y double")


def trends_of(spark, values, **kw):
    out = account_trends(series(spark, values), key="k", ts="d", cols={"y": ("s", "c")}, unit="days", **kw)
    return out.orderBy("d").collect()


def test_slope_divides_by_the_variance_of_all_rows(spark):
    got = [r.s for r in trends_of(spark, [5.0, None, 9.0, 2.0])]
    assert got[:2] == [None, None]
    assert got[2] == pytest.approx(4.0) and got[3] == pytest.approx(-0.8)
    w = Frames("k", "d").slope
    reg = series(spark, [5.0, None, 9.0, 2.0]).select("d", regression_slope(F.col("y"), time_axis("d", "days"), w).alias("s"))
    assert reg.orderBy("d").collect()[3].s == pytest.approx(-0.5714, abs=1e-4)


def test_relative_change_compares_three_rows_with_six_before(spark):
    got = [r.c for r in trends_of(spark, [10.0] * 6 + [10.0, 20.0, 30.0])]
    assert got[:3] == [None] * 3 and got[8] == pytest.approx(1.0)
    assert trends_of(spark, [0.0] * 9)[8].c is None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(-50, 50), st.integers(-1000, 1000))
def test_slope_of_a_line(spark, a, b):
    for r in trends_of(spark, [float(a * (i + 1) + b) for i in range(8)])[1:]:
        assert r.s == pytest.approx(a, abs=1e-9)


def test_dense_fills_months(spark):
    rows = [("a", D(2020, 1, 31), 1.0), ("a", D(2020, 4, 30), 2.0)]
    df = spark.createDataFrame(rows, "k string, d date, y double")
    out = account_trends(df, key="k", ts="d", cols={"y": ("s", "c")}, unit="days", dense=True)
    assert [r.d for r in out.orderBy("d").collect()] == [D(2020, 1, 31), D(2020, 2, 29), D(2020, 3, 31), D(2020, 4, 30)]


def test_validity_ends_strict_or_inclusive(spark):
    df = spark.createDataFrame(
        [("old", D(2020, 1, 1), D(2020, 6, 1)), ("new", D(2020, 6, 1), None), ("later", D(2020, 6, 2), None)],
        "v string, RowStartDate date, RowEndDate date",
    )
    asof = AsOf(((D(2020, 6, 2), "train"),))
    strict = valid_at(df, asof, run_date=D(2021, 1, 1))
    closed = valid_at(df, asof, run_date=D(2021, 1, 1), inclusive=True)
    assert {r.v for r in strict.collect()} == {"new"}
    assert {r.v for r in closed.collect()} == {"old", "new"}
    assert valid_at(df, asof, run_date=D(2020, 5, 1)).isEmpty()


def test_latest_as_of_takes_the_newest_before_each_date(spark):
    df = spark.createDataFrame(
        [("a", D(2020, 1, 5), "x"), ("a", D(2020, 2, 5), "y"), ("a", D(2020, 2, 5), "z"), ("a", D(2020, 9, 1), "w")],
        "k string, d date, p string",
    )
    asof = asof_dates(train=(D(2020, 1, 1), D(2020, 4, 1)))
    got = {r.as_of_date: r.p for r in latest_as_of(df, asof, ["k"], "d", ["p"], ["p"]).collect()}
    assert got == {D(2020, 1, 31): "x", D(2020, 2, 29): "z", D(2020, 3, 31): "z"}


def test_capped_lookup_stops_at_the_cap(spark):
    asof = asof_dates(train=(D(2020, 2, 1), D(2020, 4, 1)))
    df = spark.createDataFrame([(D(2020, 1, 31), 1), (D(2020, 2, 29), 2), (D(2020, 3, 31), 3)], "m date, r int")
    got = {r.as_of_date: r.r for r in capped_lookup(asof, df, cap=D(2020, 2, 29), month_col="m", columns=["r"]).collect()}
    assert got == {D(2020, 1, 31): 1, D(2020, 2, 29): 2, D(2020, 3, 31): 2}


def test_label_edges_and_unknown_outcomes(spark):
    E = D(2020, 1, 31)
    asof = AsOf(((D(2020, 2, 1), "train"), (D(2020, 12, 1), "test")))
    closed = {"a": E, "b": E + dt.timedelta(days=90), "c": E + dt.timedelta(days=91), "d": None}
    base = spark.createDataFrame([(E, k) for k in closed] + [(D(2020, 11, 30), "d")], "as_of_date date, AccountNumber string")
    now = spark.createDataFrame(
        [(k, "Home Loan", v) for k, v in closed.items()],
        "AccountNumber string, GeneralAccountTypeDescription string, ClosedDateTimeAEDT date",
    )
    out = fe.outcome_label(asof, base, now, run_date=D(2020, 12, 31))
    got = {(r.AccountNumber, r.as_of_date): r.ChurnedIn90D for r in out.collect()}
    assert [got[(k, E)] for k in "abcd"] == [1, 1, 0, 0]
    assert got[("d", D(2020, 11, 30))] is None


E = D(2020, 1, 31)
ASOF = AsOf(((D(2020, 2, 1), "train"),))


def loan_world(spark, loans, holders):
    """loans: account -> (opened, payment); holders: (account, client, share)."""
    accounts = spark.createDataFrame(
        [(a, E, "Open", opened) for a, (opened, _) in loans.items()],
        "AccountNumber string, EndOfDayDate date, AccountStatusType string, CreationDateTimeAEDT timestamp",
    )
    cmap = spark.createDataFrame(
        [(E, a, c, Decimal(w), "Open", "Home Loan") for a, c, w in holders],
        "as_of_date date, AccountNumber string, ClientNumber string, SimpleWeighting decimal(5,4),"
        "AccountStatusType string, GeneralAccountTypeDescription string",
    )
    paid = spark.createDataFrame(
        [(E, int(a), Decimal(p)) for a, (_, p) in loans.items() if p is not None],
        "as_of_date date, ACC_NO bigint, NORM_PYMT decimal(18,2)",
    )
    base = accounts.select(F.col("EndOfDayDate").alias("as_of_date"), "AccountNumber", "CreationDateTimeAEDT")
    return accounts, cmap, paid, base


def test_joint_account_weights(spark):
    t = dt.datetime(2019, 1, 1)
    accounts, cmap, paid, base = loan_world(spark, {"1": (t, "100")}, [("1", "x", "0.5"), ("1", "y", "0.5")])
    got = fe.total_repayments(ASOF, base, cmap, accounts, paid).first()
    assert got.TotalMonthlyRepayments == Decimal("100")


def test_later_loans_equal_brute_force(spark):
    """One client holds every account; opening times tie, and some loans pay nothing."""
    t0 = dt.datetime(2019, 1, 1)
    loans = {
        str(i): (t0 + dt.timedelta(hours=6 * (i // 2)), None if i % 5 == 0 else str(10 + i)) for i in range(1, 31)
    }
    holders = [(a, "hot", "0.5") for a in loans] + [(a, f"c{int(a) % 4}", "0.25") for a in loans]
    accounts, cmap, paid, base = loan_world(spark, loans, holders)
    out = fe.later_repayments(ASOF, base, cmap, accounts, paid)
    got = {r.AccountNumber: r.AdditionalRepayments for r in out.collect()}
    want = {}
    for b, (opened, _) in loans.items():
        mine = {c for a, c, _ in holders if a == b}
        rows = [
            None if loans[a][1] is None else Decimal(w) * Decimal(loans[a][1])
            for a, c, w in holders
            if c in mine and loans[a][0] > opened
        ]
        if rows:
            paid_rows = [r for r in rows if r is not None]
            want[b] = sum(paid_rows) if paid_rows else None
    assert got == want


def test_composition_and_single_client(spark):
    cmap = spark.createDataFrame(
        [(E, "1", "x"), (E, "1", "y"), (E, "2", "x")], "as_of_date date, AccountNumber string, ClientNumber string"
    )
    clients = spark.createDataFrame(
        [("x", E, D(1980, 1, 1), "F"), ("y", E, D(1990, 12, 31), "M")],
        "ClientNumber string, EndOfDayDate date, BirthDate date, GenderCodeDescription string",
    )
    got = {r.AccountNumber: tuple(r)[2:] for r in fe.client_details(ASOF, cmap, clients).collect()}
    assert got == {"1": (2, 40, "Couple"), "2": (1, 40, "F")}


def txns(spark, rows):
    return spark.createDataFrame(
        rows,
        "AccountNumber string, TransactionDate date, SourceTransactionAmount double, TransactionAmount double,"
        "GeneralAccountTypeDescription string, CounterPartyBSB string, CounterPartyAccountNumber string,"
        "TransactionCode string, TransactionDescription string",
    )


def test_transaction_classes(spark):
    day = D(2020, 1, 5)
    rows = [
        ("1", day, -5.0, 5.0, "Transaction", "b", "c", "1", "My HOME loan"),
        ("2", day, -5.0, 5.0, "Transaction", "b", "c", "1", "car loan"),
        ("3", day, -5.0, 2500.0, "Transaction", "b", "c", "1", "rent"),
        ("4", day, -5.0, 2500.0, "Transaction", "b", "c", "472", "home"),
        ("5", day, -5.0, 2500.0, "Transaction", None, "c", "1", "home"),
        ("6", day, 5.0, 5.0, "Home Loan", "b", "c", "1", "x"),
        ("7", day, -5.0, 5.0, "Credit Card", "b", "c", "1", "home"),
        ("8", day, 5.0, 5.0, "Term Share", "b", "c", None, "home"),
    ]
    got = {
        r.AccountNumber: (r.TransactionType, r.ExternalPaymenttype, r.IncomingPaymentType)
        for r in tx.classify_transactions(txns(spark, rows)).collect()
    }
    assert got == {
        "1": ("Debit", "home loan payment", None),
        "2": ("Debit", "other loans", None),
        "3": ("Debit", "large transaction (2.5K)", None),
        "4": ("Debit", None, None),
        "5": ("Debit", None, None),
        "6": ("Debit", None, "PaymentFromExternalBank"),
        "7": ("Credit", None, None),
        "8": ("Credit", None, None),
    }


def test_spine_keeps_empty_months_under_no_loan(spark):
    day = D(2020, 1, 5)
    t = tx.classify_transactions(txns(spark, [("s", day, 10.0, 10.0, "Savings", "b", "c", "1", "x")] * 3))
    loans = spark.createDataFrame([("L", "x"), ("L", "y")], "HomeLoanAccountNumber string, ClientNumber string")
    held = spark.createDataFrame(
        [("x", "s", Decimal("0.5")), ("y", "s", Decimal("0.5"))],
        "ClientNumber string, AccountNumber string, SimpleWeighting decimal(5,4)",
    )
    monthly_rows = tx.monthly_transactions(t, loans, held, start=D(2020, 1, 1), end=D(2020, 3, 1))
    spine = spark.createDataFrame([(D(2020, 1, 31),), (D(2020, 2, 29),)], "TransactionMonth date")
    got = {(r.HomeLoanAccountNumber, r.TransactionMonth): (r.Savings_Credit, r.NumTrans_Savings_Credit) for r in tx.spine_pivot(monthly_rows, spine).collect()}
    assert got == {("L", D(2020, 1, 31)): (30.0, 1), (None, D(2020, 2, 29)): (None, None)}
    rows = tx.spine_pivot(monthly_rows, spine, count="rows").filter("HomeLoanAccountNumber = 'L'").first()
    assert rows.NumTrans_Savings_Credit == 6  # three transactions through each of two clients


def test_validity_over_thousands_of_dates(spark):
    """More as-of dates than a plan could hold as literals, on days all over the month."""
    days = [D(2000, 1, 1) + dt.timedelta(days=i) for i in range(0, 9000, 3)]
    asof = AsOf(tuple((d, "train") for d in days))
    rows = [(1, D(1999, 5, 5), D(2000, 3, 1)), (2, D(2003, 2, 28), None), (3, D(2024, 8, 20), D(2030, 1, 1)), (4, None, None), (5, D(2010, 1, 31), D(2010, 1, 31))]
    df = spark.createDataFrame(rows, "i int, RowStartDate date, RowEndDate date")
    run = D(2005, 6, 15)
    for inclusive in (False, True):
        got = {(r.i, r.as_of_date) for r in valid_at(df, asof, run_date=run, inclusive=inclusive).collect()}
        want = {
            (i, e)
            for i, s, end in rows
            for e in asof.snapshots
            if s and s <= e and (e <= run if end is None else (e <= end if inclusive else e < end))
        }
        assert got == want
