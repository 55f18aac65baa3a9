"""Queries over the feature operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.catalogue import bank_sql as S
from ebbline.catalogue.bank import BRAND, RUN_DATE, SOURCE, Bank
from ebbline.catalogue.registry import query
from ebbline.functions.dates import age_years, asof_dates, at_snapshot, month_diff, month_ends
from ebbline.operators import features as fe
from ebbline.operators import transactions as tx
from ebbline.operators.joins import valid_at
from ebbline.operators.ordered import ntile
from ebbline.operators.related import related_accounts
from ebbline.operators.trends import account_trends
from ebbline.plans import churn
from ebbline.session import freeze

START, END = dt.date(1997, 1, 1), dt.date(2001, 1, 1)
ASOF = asof_dates(
    train=(dt.date(1998, 1, 1), dt.date(1999, 12, 1)), test=(dt.date(2000, 1, 1), dt.date(2000, 12, 1))
)
RUN = churn.ChurnRun(ASOF, RUN_DATE, START, END, dt.date(2000, 6, 30))

_KEY = "as_of_date date, AccountNumber string"


# Slopes per second need more places than amounts.
SLOPE_KINDS = {"RatesSlope": "double:15", "LVRSlope": "double:15"} | {
    n: "double:10" for n in ("BalanceSlope", "AdvanceSlope", "ArrearsSlope", "OffsetBalanceSlope")
}


def tables(spark: SparkSession, sf_dir: str) -> churn.ChurnTables:
    return bank_tables(Bank(spark, sf_dir))


def bank_tables(b: Bank) -> churn.ChurnTables:
    branded = {
        n: fe.one_source(getattr(b, n), BRAND, SOURCE)
        for n in (
            "account",
            "account_now",
            "bridge",
            "client",
            "security_bridge",
            "security",
            "address",
            "offset_bridge",
            "activity",
            "transactions",
            "loan_repayment",
        )
    }
    return churn.ChurnTables(
        **branded,
        calendar=b.calendar(START, END),
        loans=b.loans,
        applications=b.applications,
        serviceability=b.serviceability,
        customer_history=b.customer_history,
        market=b.market,
        rates=b.rates,
    )


# --- trends ---------------------------------------------------------------------------

_MONTHLY_SQL = """
SELECT o_custkey, m, {trends}
FROM (SELECT o_custkey, m, sum(total) AS amount, max(total) AS largest, count(*) AS n_orders,
             CAST(date_diff('day', DATE '1970-01-01', m) AS DOUBLE) * 86400 AS t
      FROM (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
                   last_day(CAST(o_orderdate AS DATE)) AS m FROM orders) GROUP BY 1, 2)
{windows}""".format(
    trends=", ".join(
        S.trend(c, f"{c}_slope", f"{c}_change") for c in ("amount", "largest", "n_orders")
    ),
    windows=S.windows("o_custkey", "m"),
)


@query(
    "account_trends",
    "o_custkey bigint, m date, amount_slope double:10, amount_change double, largest_slope double:10,"
    "largest_change double, n_orders_slope double:15, n_orders_change double",
    sql=_MONTHLY_SQL,
)
def q_account_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Bank(spark, sf_dir).orders
    monthly = o.groupBy("o_custkey", "m").agg(
        F.sum("total").alias("amount"), F.max("total").alias("largest"), F.count(F.lit(1)).alias("n_orders")
    )
    names = {c: (f"{c}_slope", f"{c}_change") for c in ("amount", "largest", "n_orders")}
    return account_trends(monthly, key="o_custkey", ts="m", cols=names, unit="seconds")


@query(
    "account_features",
    "AccountNumber string, EndOfDayDate date, OffsetBalance double,"
    + ",".join(f"{n} {SLOPE_KINDS.get(n, 'double')}" for pair in fe.ACCOUNT_TRENDS.values() for n in pair),
    ctes=S.BANK + "," + S.ACCOUNT_TREND,
    sql="SELECT * FROM account_trend",
)
def q_account_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return fe.account_features(t.account, t.offset_bridge, start=START, end=END - dt.timedelta(days=1))


# --- transactions ---------------------------------------------------------------------

_CLASS = "AccountType string, TransactionType string, ExternalPaymenttype string, IncomingPaymentType string"


@query(
    "txn_scope",
    "HomeLoanAccountNumber string, AssociatedClientNumber string, RelatedTransactionAccount string,"
    "SimpleWeighting double",
    ctes=S.BANK + "," + S.SCOPE,
    sql="SELECT * FROM scope",
)
def q_txn_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return tx.transaction_scope(t.account, t.bridge, start=START, end=END)


@query(
    "txn_classify",
    "AccountNumber string, TransactionDate date, SourceTransactionAmount double," + _CLASS,
    ctes=S.BANK + "," + S.CLASSIFIED,
    sql="SELECT *, amt AS SourceTransactionAmount FROM classified",
)
def q_txn_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.classify_transactions(tables(spark, sf_dir).transactions)


def _bridge_at_end(t: churn.ChurnTables) -> DataFrame:
    """The bridge of the last day, one snapshot of many; it is read three times."""
    return freeze(t.bridge.filter(F.col("EndOfDayDate") == F.lit(END - dt.timedelta(days=1))))


def _monthly(t: churn.ChurnTables) -> DataFrame:
    bridge = _bridge_at_end(t)
    return tx.monthly_transactions(
        tx.classify_transactions(t.transactions),
        tx.loan_clients(t.account, bridge, start=START, end=END),
        tx.client_accounts(bridge, end=END),
        start=START,
        end=END,
    )


@query(
    "monthly_transactions",
    "HomeLoanAccountNumber string, TransactionMonth date," + _CLASS + ", Amount double, NumRows bigint",
    ctes=S.BANK + "," + S.MONTHLY,
    sql="SELECT * FROM monthly",
)
def q_monthly_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(tables(spark, sf_dir))


_PIVOT = [
    "Savings_Credit double",
    "NumTrans_Savings_Credit bigint",
    "Savings_Debit double",
    "NumTrans_Savings_Debit bigint",
    "Lending_Credit double",
    "Lending_Debit double",
    "NumTrans_Lending_Debit bigint",
    "ExternalHomeLoanPayments double",
    "ExternalOtherLoanPayments double",
    "ExternalLargePayments double",
    "NumPaymentsFromExternalBanks bigint",
]


@query(
    "month_spine_pivot",
    "HomeLoanAccountNumber string, TransactionMonth date," + ",".join(_PIVOT),
    ctes=S.BANK + "," + S.PIVOT,
    sql="SELECT * FROM pivot_",
)
def q_month_spine_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return tx.spine_pivot(_monthly(t), month_ends(t.calendar, START, END))


@query(
    "txn_trends",
    "HomeLoanAccountNumber string, TransactionMonth date,"
    + ",".join(f"{n} double" for pair in tx.TRANSACTION_TRENDS.values() for n in pair)
    + ", HasHomeLoanPayments boolean, HasOtherLoanPayments boolean, HasLargePayments boolean,"
    "LoanPaymentsFromExternalBanks boolean",
    ctes=S.BANK + "," + S.TXN_TREND,
    sql="SELECT * FROM txn_trend",
)
def q_txn_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return tx.transaction_features(
        t.account, _bridge_at_end(t), t.transactions, month_ends(t.calendar, START, END), start=START, end=END
    )


# --- point in time --------------------------------------------------------------------


@query(
    "asof_frame",
    "as_of date, as_of_date date, split string, accounts bigint",
    ctes=S.BANK,
    sql="""SELECT as_of, as_of_date, split, count(AccountNumber) AS accounts
           FROM asof_days LEFT JOIN account ON EndOfDayDate = as_of_date GROUP BY 1, 2, 3""",
)
def q_asof_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    per_date = at_snapshot(t.account, ASOF).groupBy("as_of_date").agg(F.count(F.lit(1)).alias("n"))
    return (
        ASOF.frame(spark)
        .join(per_date, "as_of_date", "left")
        .withColumn("accounts", F.coalesce("n", F.lit(0)))
    )


@query(
    "instalments",
    "as_of_date date, ACC_NO bigint, NORM_PYMT double",
    ctes=S.BANK + "," + S.PAID,
    sql="SELECT * FROM paid",
)
def q_instalments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.instalments(ASOF, tables(spark, sf_dir).loans, run_date=RUN_DATE)


@query(
    "scd2_valid_at",
    "as_of_date date, CUS_NO bigint, RowStartDate date, OCC_CDE string, variant string",
    ctes=S.BANK,
    sql="""
SELECT as_of_date, CUS_NO, RowStartDate, OCC_CDE, 'strict' AS variant FROM customer_history JOIN asof_days
  ON RowStartDate <= as_of_date AND (RowEndDate > as_of_date OR RowEndDate IS NULL)
UNION ALL
SELECT as_of_date, CUS_NO, RowStartDate, OCC_CDE, 'inclusive' FROM customer_history JOIN asof_days
  ON RowStartDate <= as_of_date AND (RowEndDate >= as_of_date OR RowEndDate IS NULL)""",
)
def q_scd2_valid_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = tables(spark, sf_dir).customer_history
    strict = valid_at(h, ASOF, run_date=RUN_DATE).withColumn("variant", F.lit("strict"))
    closed = valid_at(h, ASOF, run_date=RUN_DATE, inclusive=True).withColumn("variant", F.lit("inclusive"))
    return strict.unionByName(closed)


@query(
    "base_population",
    _KEY
    + """, CreationDateTimeAEDT date, ClosedDateTimeAEDT date, MaturityDate date,
      RepaymentTypeDescription string, ApprovedAmount double, FinancedAmount double,
      FinancedAmountBucket string, BalanceAmount double, ActualLoanValueRatio double, LoanCategory string,
      InAdvanceAmount double, ArrearsAmount double, AvailableForRedrawAmount double,
      InactiveMonthsCount bigint, InterestRate double, CurrentMonthlyInstallment double""",
    ctes=S.BANK + "," + S.BASE,
    sql="SELECT * FROM base",
)
def q_base_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.core_blocks(tables(spark, sf_dir), RUN).base


@query(
    "client_map",
    _KEY
    + ", ClientNumber string, SimpleWeighting double, AccountStatusType string, GeneralAccountTypeDescription string",
    ctes=S.BANK + "," + S.BASE,
    sql="SELECT * FROM cmap",
)
def q_client_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.client_map(ASOF, tables(spark, sf_dir).bridge)


@query(
    "client_composition",
    _KEY + ", NumClients bigint, MaxAge int, Gendercomposition string",
    ctes=S.BANK + "," + S.BASE + "," + S.DETAILS,
    sql="SELECT * FROM details",
)
def q_client_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.core_blocks(tables(spark, sf_dir), RUN).details


@query(
    "client_age",
    "o_orderkey bigint, age int, months int",
    sql="""
SELECT o_orderkey, 2001 - year(d) - CASE WHEN 214 < dayofyear(d) THEN 1 ELSE 0 END AS age,
       (2001 - year(d)) * 12 + 8 - month(d) AS months
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def q_client_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lit(RUN_DATE)
    return Bank(spark, sf_dir).orders.select(
        "o_orderkey", age_years(day, F.col("d")).alias("age"), month_diff(day, F.col("d")).alias("months")
    )


@query(
    "collateral_top1",
    _KEY + ", TotalSecurityValue double, MaxSecurityValue double, PostCode string",
    ctes=S.BANK + "," + S.SECURITIES,
    sql="SELECT * FROM securities",
)
def q_collateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return fe.collateral(ASOF, t.security_bridge, t.security)


@query(
    "attribute_change",
    _KEY + ", AddressChangedIn6M int",
    ctes=S.BANK + "," + S.BASE + "," + S.CHANGED,
    sql="SELECT * FROM changed",
)
def q_attribute_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return fe.attribute_changed(ASOF, t.address, fe.client_map(ASOF, t.bridge))


@query(
    "offset_balance",
    "LoanAccountNumber string, EndOfDayDate date, OffsetBalance double",
    ctes=S.BANK + "," + S.OFFSETS,
    sql="SELECT * FROM offsets",
)
def q_offset_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return fe.offset_balance(t.offset_bridge, t.account, start=START, end=END - dt.timedelta(days=1))


@query(
    "related_accounts",
    _KEY
    + """, OtherOpenAccounts bigint, AccountsClosedInLast3M bigint, CurrentHoldings double,
      CurrentlyOwingLoans double, NumTransactionAccounts bigint, NumSavingsAccounts bigint,
      NumLendingAccounts bigint""",
    ctes=S.BANK + "," + S.BASE + "," + S.RELATED,
    sql="SELECT * FROM related",
)
def q_related_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    core = churn.core_blocks(t, RUN)
    return related_accounts(ASOF, core.base, core.cmap, t.account)


@query(
    "login_change",
    _KEY + ", WebLoginsRelChange double, ApploginsRelChange double",
    ctes=S.BANK + "," + S.BASE + "," + S.LOGINS,
    sql="SELECT * FROM logins",
)
def q_login_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    names = {
        "InternetBankingLogonCountMTD": "WebLoginsRelChange",
        "MobileBankingLogonCountMTD": "ApploginsRelChange",
    }
    return fe.activity_change(ASOF, fe.client_map(ASOF, t.bridge), t.activity, measures=names)


@query(
    "latest_version",
    _KEY
    + ", ApplicationNumber string, repaymentAmount double, MonthlyIncome double, MonthlyExpenses double",
    ctes=S.BANK + "," + S.BASE + "," + S.INCOME,
    sql="SELECT * FROM income",
)
def q_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.core_blocks(tables(spark, sf_dir), RUN).income


@query(
    "later_loans",
    _KEY + ", AdditionalRepayments double",
    ctes=S.BANK + "," + S.BASE + "," + S.LATER,
    sql="SELECT * FROM later",
)
def q_later_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    core = churn.core_blocks(t, RUN)
    return fe.later_repayments(ASOF, core.base, core.cmap, t.account, core.paid)


@query(
    "total_repayments",
    _KEY + ", TotalMonthlyRepayments double",
    ctes=S.BANK + "," + S.BASE + "," + S.REPAYMENTS,
    sql="SELECT * FROM repayments",
)
def q_total_repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    core = churn.core_blocks(t, RUN)
    return fe.total_repayments(ASOF, core.base, core.cmap, t.account, core.paid)


@query(
    "occupation_codes",
    _KEY + ", ClientNumber string, OccupationCode string",
    ctes=S.BANK + "," + S.BASE + "," + S.CODES,
    sql="SELECT * FROM codes",
)
def q_occupation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.core_blocks(tables(spark, sf_dir), RUN).codes


def _means(t: churn.ChurnTables) -> tuple[churn.Core, DataFrame]:
    core = churn.core_blocks(t, RUN)
    return core, fe.group_means(core.codes, fe.client_details(ASOF, core.held, t.client), core.income)


_IMPUTE = ",".join([S.BANK, S.BASE, S.DETAILS, S.INCOME, S.CODES, S.IMPUTED])


@query(
    "group_means",
    "as_of_date date, OccupationCode string, AvgMonthlyIncome double, AvgMonthlyExpenses double",
    ctes=_IMPUTE,
    sql="SELECT *, mi AS AvgMonthlyIncome, me AS AvgMonthlyExpenses FROM means",
)
def q_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _means(tables(spark, sf_dir))[1]


@query(
    "group_mean_impute",
    _KEY + ", IncomeMonthly double, ExpensesMonthly double",
    ctes=_IMPUTE,
    sql="SELECT * FROM imputed",
)
def q_group_mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    core, means = _means(tables(spark, sf_dir))
    return fe.impute_from_groups(core.income, core.codes, means)


@query(
    "capped_lookup",
    "as_of_date date, PostCode string, FLRHOOVA double," + ",".join(f"{c} double" for c in fe.MARKET_COLUMNS),
    ctes=S.BANK + "," + S.LOOKUPS,
    sql="""SELECT m.*, pc AS PostCode, FLRHOOVA FROM market_at m JOIN rate_at r ON r.as_of_date = m.as_of_date""",
)
def q_capped_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return churn.market_lookup(t, RUN).join(churn.rate_lookup(t, RUN), "as_of_date")


@query(
    "churn_label",
    _KEY + ", ChurnedIn90D int",
    ctes=S.BANK + "," + S.BASE + "," + S.LABEL,
    sql="SELECT * FROM labelled",
)
def q_churn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return fe.outcome_label(ASOF, churn.core_blocks(t, RUN).base, t.account_now, run_date=RUN_DATE)


ASSEMBLY = (
    _KEY
    + """, LoanCategory string, RepaymentTypeDescription string, Gender string, LoanLeftToPay double,
    MtdInterestCharge double, MtdLoanRunoff double, FinancedAmountBucket string, PercTenureCompleted double,
    PercMortgagePaid double, MaxAge int, TotalEquity double, percentage_stock_on_market double,
    Median_sales_price_last_12_months double,
    Median_days_on_market_for_properties_sold_in_last_12_months double, Average_hold_period double,
    AddressChangedIn6M int, SecurityCompetitiveness double, CurrentHoldings double,
    CurrentlyOwingLoans double, IncomeLeft double, DTI double, NSR double, CurrentAdvanceAmount double,
    CurrentArrearsAmount double, BalanceSlope double:10, AdvanceSlope double:10, ArrearsSlope double:10,
    RatesSlope double:15, LVRSlope double:15, OffsetBalanceSlope double:10, BalanceRelChange double,
    AdvanceRelChange double, RateRelChange double, LvrRelChange double, OffsetBalRelChange double,
    InterestRateDecile int, DiffFromMarketrate double, ActualLoanValueRatio double,
    Savings_Credit_Slope double, Savings_Debit_Slope double, Lending_Credit_Slope double,
    Lending_Debit_Slope double, SavingsDebitRelChange double, LendingDebitRelChange double,
    OtherOpenAccounts bigint, NumTransactionAccounts bigint, NumSavingsAccounts bigint,
    NumLendingAccounts bigint, HasHomeLoanPayments boolean, LoanPaymentsFromExternalBanks boolean,
    AccountsClosedInLast3M bigint, InactiveMonthsCount bigint, WebLoginsRelChange double,
    ApploginsRelChange double, ChurnedIn90D int"""
)

_ALL = ",".join(
    [
        S.BANK, S.BASE, S.DETAILS, S.SECURITIES, S.CHANGED, S.RELATED, S.LOGINS, S.INCOME, S.CODES, S.IMPUTED,
        S.LATER, S.REPAYMENTS, S.ACCOUNT_TREND, S.TXN_TREND, S.LOOKUPS, S.LABEL,
    ]
)

_OUT = "(ExpensesMonthly + CAST(b.CurrentMonthlyInstallment AS DOUBLE) + coalesce(CAST(AdditionalRepayments AS DOUBLE), 0))"
_FIN = "CAST(b.FinancedAmount AS DOUBLE)"


def _left(block: str, alias: str) -> str:
    return (
        f"LEFT JOIN {block} {alias} ON {alias}.as_of_date = b.as_of_date "
        f"AND {alias}.AccountNumber = b.AccountNumber\n"
    )


_ASSEMBLY_SQL = (
    f"""
SELECT b.as_of_date, b.AccountNumber, b.LoanCategory, b.RepaymentTypeDescription,
  Gendercomposition AS Gender, b.BalanceAmount AS LoanLeftToPay, h.MtdInterestCharge, h.MtdLoanRunoff,
  b.FinancedAmountBucket,
  CAST((year(b.as_of_date) - year(b.CreationDateTimeAEDT)) * 12 + month(b.as_of_date)
       - month(b.CreationDateTimeAEDT) AS DOUBLE)
    / nullif((year(b.MaturityDate) - year(b.CreationDateTimeAEDT)) * 12 + month(b.MaturityDate)
             - month(b.CreationDateTimeAEDT), 0) AS PercTenureCompleted,
  greatest(({_FIN} - (CAST(b.BalanceAmount AS DOUBLE) + CAST(b.InAdvanceAmount AS DOUBLE))) / nullif({_FIN}, 0), 0)
    AS PercMortgagePaid,
  MaxAge, CAST(TotalSecurityValue AS DOUBLE) - CAST(b.BalanceAmount AS DOUBLE) AS TotalEquity,
  percentage_stock_on_market, Median_sales_price_last_12_months,
  Median_days_on_market_for_properties_sold_in_last_12_months, Average_hold_period, AddressChangedIn6M,
  CAST(MaxSecurityValue AS DOUBLE) - Median_sales_price_last_6_months AS SecurityCompetitiveness,
  CurrentHoldings, CurrentlyOwingLoans, IncomeMonthly - {_OUT} AS IncomeLeft,
  CAST(TotalMonthlyRepayments AS DOUBLE) / nullif(IncomeMonthly, 0) AS DTI,
  (IncomeMonthly - {_OUT}) / nullif(CAST(TotalMonthlyRepayments AS DOUBLE), 0) AS NSR,
  b.InAdvanceAmount AS CurrentAdvanceAmount, b.ArrearsAmount AS CurrentArrearsAmount,
  BalanceSlope, AdvanceSlope, ArrearsSlope, RatesSlope, LVRSlope, OffsetBalanceSlope, BalanceRelChange,
  AdvanceRelChange, RateRelChange, LvrRelChange, OffsetBalRelChange,
  ntile(5) OVER (PARTITION BY b.as_of_date ORDER BY b.InterestRate NULLS FIRST, b.AccountNumber) AS InterestRateDecile,
  b.InterestRate * 100 - FLRHOOVA AS DiffFromMarketrate, b.ActualLoanValueRatio,
  Savings_Credit_Slope, Savings_Debit_Slope, Lending_Credit_Slope, Lending_Debit_Slope,
  SavingsDebitRelChange, LendingDebitRelChange, OtherOpenAccounts, NumTransactionAccounts,
  NumSavingsAccounts, NumLendingAccounts, coalesce(HasHomeLoanPayments, false) AS HasHomeLoanPayments,
  coalesce(LoanPaymentsFromExternalBanks, false) AS LoanPaymentsFromExternalBanks, AccountsClosedInLast3M,
  b.InactiveMonthsCount, WebLoginsRelChange, ApploginsRelChange, ChurnedIn90D
FROM base b
JOIN loan_repayment h ON h.AccountNumber = b.AccountNumber AND h.EndOfMonth = b.as_of_date
 AND h.LoanChannel <> 'Broker'
"""
    + _left("details", "d")
    + _left("securities", "s")
    + _left("changed", "c")
    + _left("related", "r")
    + _left("logins", "l")
    + _left("imputed", "i")
    + _left("repayments", "p")
    + _left("later", "x")
    + _left("labelled", "y")
    + """LEFT JOIN account_trend ta ON ta.AccountNumber = b.AccountNumber AND ta.EndOfDayDate = b.as_of_date
LEFT JOIN txn_trend tt ON tt.HomeLoanAccountNumber = b.AccountNumber AND tt.TransactionMonth = b.as_of_date
LEFT JOIN market_at k ON k.as_of_date = b.as_of_date AND k.pc = s.PostCode
LEFT JOIN rate_at w ON w.as_of_date = b.as_of_date
"""
)


@query("feature_assembly", ASSEMBLY, ctes=_ALL, sql=_ASSEMBLY_SQL)
def q_feature_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bank(spark, sf_dir)
    with b.kept():
        return churn.build_features(bank_tables(b), RUN)


@query(
    "rate_ntile",
    "c_custkey bigint, c_mktsegment string, tile int",
    sql="""SELECT c_custkey, c_mktsegment,
             ntile(5) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal NULLS FIRST, c_custkey) AS tile
           FROM customer""",
)
def q_rate_ntile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Bank(spark, sf_dir).table("customer")
    return ntile(c, 5, ["c_mktsegment"], [F.col("c_acctbal").asc_nulls_first(), F.col("c_custkey")], "tile")


