"""Transaction-side features (FE21-FE25)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.operators.joins import open_or_closed_within
from ebbline.operators.related import RELATED_KINDS
from ebbline.operators.trends import (
    Frames,
    change,
    densify_months,
    positive_months_flag,
    repeated_count_flag,
    slope,
    time_axis,
)

SAVINGS_CLASS = ["Transaction", "Savings", "Term Share"]
LENDING_CLASS = ["Home Loan", "Personal Loan", "Credit Card"]

# Labels of the payment classes.
HOME_LOAN_PAYMENT = "home loan payment"
OTHER_LOANS = "other loans"
LARGE_PAYMENT = "large transaction (2.5K)"
FROM_EXTERNAL_BANK = "PaymentFromExternalBank"

# Transactions of this code are no payments.
SKIP_CODE = "472"

CLASSES = ["AccountType", "TransactionType", "ExternalPaymenttype", "IncomingPaymentType"]


# What the classes but the account type can hold, besides NULL.
CLASS_LABELS = {
    "TransactionType": ["Credit", "Debit"],
    "ExternalPaymenttype": [HOME_LOAN_PAYMENT, OTHER_LOANS, LARGE_PAYMENT],
    "IncomingPaymentType": [FROM_EXTERNAL_BANK],
}


def _class_code() -> Column:
    """The labels of a transaction as one small number, which shuffles carry instead of them."""
    code = F.lit(0)
    for name, labels in CLASS_LABELS.items():
        c = F.col(name)
        digit = F.when(c.isNull(), 0)
        for i, label in enumerate(labels, 1):
            digit = digit.when(c == label, i)
        code = code * (len(labels) + 1) + digit.otherwise(F.raise_error(F.concat(F.lit(f"no {name}: "), c)).cast("int"))
    return code


def _class_labels(code: Column) -> dict[str, Column]:
    out = {}
    for name, labels in reversed(CLASS_LABELS.items()):
        n = len(labels) + 1
        label = F.lit(None).cast("string")
        for i, value in enumerate(labels, 1):
            label = F.when(code % n == i, value).otherwise(label)
        out[name] = label
        code = F.floor(code / n).cast("int")
    return out


def loan_clients(accounts: DataFrame, bridge: DataFrame, *, start: dt.date, end: dt.date) -> DataFrame:
    """Variable home loans open at the last day or closed in the range, with their clients."""
    day = end - dt.timedelta(days=1)
    loans = accounts.filter(
        (F.col("EndOfDayDate") == F.lit(day))
        & (F.col("GeneralAccountTypeDescription") == "Home Loan")
        & (F.col("InterestRateTypeDescription") == "Variable")
        & open_or_closed_within("AccountStatusType", "ClosedDateTimeAEDT", F.lit(start), F.lit(day))
    ).select("AccountNumber")
    held = bridge.filter(F.col("EndOfDayDate") == F.lit(day)).select("AccountNumber", "ClientNumber")
    return loans.join(held, "AccountNumber").select(
        F.col("AccountNumber").alias("HomeLoanAccountNumber"), "ClientNumber"
    )


def client_accounts(bridge: DataFrame, *, end: dt.date) -> DataFrame:
    """Accounts of each client at the last day, with the client's share."""
    day = end - dt.timedelta(days=1)
    return bridge.filter(
        (F.col("EndOfDayDate") == F.lit(day)) & F.col("GeneralAccountTypeDescription").isin(RELATED_KINDS)
    ).select("ClientNumber", "AccountNumber", "SimpleWeighting")


def transaction_scope(
    accounts: DataFrame, bridge: DataFrame, *, start: dt.date, end: dt.date
) -> DataFrame:
    """Loan, client, related account and share, written out (FE21).

    This is the listing itself, so its size is the number of (loan, account) pairs.  The
    monthly sums below never build it; they go through the client in two steps.
    """
    return (
        loan_clients(accounts, bridge, start=start, end=end)
        .join(client_accounts(bridge, end=end), "ClientNumber")
        .select(
            "HomeLoanAccountNumber",
            F.col("ClientNumber").alias("AssociatedClientNumber"),
            F.col("AccountNumber").alias("RelatedTransactionAccount"),
            "SimpleWeighting",
        )
    )


def has_counterparty(skip_code: str = SKIP_CODE) -> Column:
    """Whether another bank's account stands on the other side.

    A source that joins accounts to wide transactions can tell this before the join, as column
    ``HasCounterParty``, so that what it rests on need not be shuffled.
    """
    return (
        F.col("CounterPartyBSB").isNotNull()
        & F.col("CounterPartyAccountNumber").isNotNull()
        & (F.col("TransactionCode") != skip_code)
    )


def classify_transactions(
    txns: DataFrame, *, large: float = 2500, skip_code: str = SKIP_CODE
) -> DataFrame:
    """Add AccountType, TransactionType, ExternalPaymenttype and IncomingPaymentType (FE22)."""
    sign = F.sign("SourceTransactionAmount")
    kind = F.col("GeneralAccountTypeDescription")
    text = F.lower("TransactionDescription")
    saving, lending = kind.isin(SAVINGS_CLASS), kind.isin(LENDING_CLASS)
    money_in, money_out = sign == 1, sign == -1
    told = skip_code == SKIP_CODE and "HasCounterParty" in txns.columns
    counterparty = F.col("HasCounterParty") if told else has_counterparty(skip_code)
    # A positive amount adds to savings but adds to what is owed on a loan.
    kind_of = F.when((saving & money_in) | (lending & money_out), "Credit").when(
        (saving & money_out) | (lending & money_in), "Debit"
    )
    purpose = (
        F.when(text.contains("home") | text.contains("mortgage"), HOME_LOAN_PAYMENT)
        .when(text.contains("loan"), OTHER_LOANS)
        .when(F.col("TransactionAmount") >= large, LARGE_PAYMENT)
    )
    return txns.withColumns(
        {
            "AccountType": kind,
            "TransactionType": kind_of,
            "ExternalPaymenttype": F.when((kind == "Transaction") & money_out & counterparty, purpose),
            "IncomingPaymentType": F.when(lending & money_in & counterparty, F.lit(FROM_EXTERNAL_BANK)),
        }
    )


def monthly_transactions(
    classified: DataFrame,
    loans: DataFrame,
    holdings: DataFrame,
    *,
    start: dt.date,
    end: dt.date,
    keep_unlinked: bool = True,
) -> DataFrame:
    """Weighted monthly sums per loan and class (FE23), with the number of transactions.

    A transaction counts for a loan once per client that holds both, by the client's share
    of the transaction account.  The sum goes account -> client -> loan, aggregating at each
    step, so the (loan, account) pairs of a client with many accounts are never built: a
    step's input is at most one row per bridge row, month and class.

    With ``keep_unlinked`` transactions of accounts that no loan reaches stay, under a NULL
    loan and without an amount.
    """
    day = F.col("TransactionDate").cast("date")
    per_account = (
        classified.filter(day.between(F.lit(start), F.lit(end - dt.timedelta(days=1))))
        .filter(F.col("SourceTransactionAmount") != 0)
        .groupBy("AccountNumber", F.last_day(day).alias("TransactionMonth"), "AccountType", _class_code().alias("_class"))
        .agg(F.sum(F.abs("SourceTransactionAmount")).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    )
    # Only clients of some loan matter from here on.
    reach = holdings.join(loans.select("ClientNumber").distinct(), "ClientNumber", "left_semi")
    keys = ["TransactionMonth", "AccountType", "_class"]
    # What no loan reaches passes through the same joins under a NULL client, so that the
    # transactions are read and reduced once.
    how = "left" if keep_unlinked else "inner"
    per_client = (
        per_account.join(reach, "AccountNumber", how)
        .groupBy("ClientNumber", *keys)
        .agg(F.sum(F.col("_sum") * F.col("SimpleWeighting")).alias("Amount"), F.sum("_rows").alias("NumRows"))
    )
    # Placed by loan and month, by which the pivot goes on.
    per_loan = (
        per_client.join(loans, "ClientNumber", how)
        .repartition("HomeLoanAccountNumber", "TransactionMonth")
        .groupBy("HomeLoanAccountNumber", *keys)
        .agg(F.sum("Amount").alias("Amount"), F.sum("NumRows").alias("NumRows"))
    )
    labels = _class_labels(F.col("_class"))
    named = [labels[c].alias(c) if c in labels else F.col(c) for c in CLASSES]
    return per_loan.select("HomeLoanAccountNumber", "TransactionMonth", *named, "Amount", "NumRows")


def spine_pivot(
    monthly: DataFrame,
    spine: DataFrame,
    *,
    count: str = "groups",
    dense: bool = False,
) -> DataFrame:
    """Month spine left join, pivoted to 11 measures per loan and month (FE24).

    The counts are of class groups, as specified, or of transactions with
    ``count="rows"``.  Months without any row appear once, under a NULL loan; ``dense``
    fills the months of each loan instead.
    """
    one = {"groups": F.lit(1).cast("bigint"), "rows": F.col("NumRows")}[count]
    amount = F.col("Amount")
    saving = F.col("AccountType").isin(SAVINGS_CLASS)
    lending = F.col("AccountType").isin(LENDING_CLASS)
    credit, debit = F.col("TransactionType") == "Credit", F.col("TransactionType") == "Debit"
    external = F.col("ExternalPaymenttype")
    measures = {
        "Savings_Credit": (saving & credit, amount),
        "NumTrans_Savings_Credit": (saving & credit, one),
        "Savings_Debit": (saving & debit, amount),
        "NumTrans_Savings_Debit": (saving & debit, one),
        "Lending_Credit": (lending & credit, amount),
        "Lending_Debit": (lending & debit, amount),
        "NumTrans_Lending_Debit": (lending & debit, one),
        "ExternalHomeLoanPayments": (external == HOME_LOAN_PAYMENT, amount),
        "ExternalOtherLoanPayments": (external == OTHER_LOANS, amount),
        "ExternalLargePayments": (external == LARGE_PAYMENT, amount),
        "NumPaymentsFromExternalBanks": (F.col("IncomingPaymentType") == FROM_EXTERNAL_BANK, one),
    }
    # The monthly side is pivoted before the join: the spine then meets one row per loan
    # and month, and has at most one row per month itself.
    pivoted = monthly.groupBy("HomeLoanAccountNumber", "TransactionMonth").agg(
        *[F.sum(F.when(cond, value)).alias(name) for name, (cond, value) in measures.items()]
    )
    out = spine.join(pivoted, "TransactionMonth", "left").select(
        "HomeLoanAccountNumber", "TransactionMonth", *measures
    )
    if dense:
        known = out.filter(F.col("HomeLoanAccountNumber").isNotNull())
        return densify_months(known, "HomeLoanAccountNumber", "TransactionMonth")
    return out


TRANSACTION_TRENDS = {
    "Savings_Credit": ("Savings_Credit_Slope", "SavingsCreditRelChange"),
    "NumTrans_Savings_Credit": ("NumTrans_Savings_Credit_Slope", "NumTransSavingsCreditRelChange"),
    "Savings_Debit": ("Savings_Debit_Slope", "SavingsDebitRelChange"),
    "NumTrans_Savings_Debit": ("NumTrans_Savings_Debit_Slope", "NumTrans_Savings_DebitRelChange"),
    "Lending_Credit": ("Lending_Credit_Slope", "LendingCreditRelChange"),
    "Lending_Debit": ("Lending_Debit_Slope", "LendingDebitRelChange"),
    "NumTrans_Lending_Debit": ("NumTrans_Lending_Debit_Slope", "NumTrans_Lending_DebitRelChange"),
}


def transaction_trends(pivot: DataFrame) -> DataFrame:
    """7 slopes, 7 relative changes and 4 flags per loan and month (FE25)."""
    frames = Frames("HomeLoanAccountNumber", "TransactionMonth")
    t = time_axis("TransactionMonth", "days")
    out = [F.col("HomeLoanAccountNumber"), F.col("TransactionMonth")]
    for measure, (slope_name, change_name) in TRANSACTION_TRENDS.items():
        out.append(slope(F.col(measure), t, frames.slope).alias(slope_name))
        out.append(change(F.col(measure), frames).alias(change_name))
    w = frames.slope
    flags = {
        "HasHomeLoanPayments": positive_months_flag(F.col("ExternalHomeLoanPayments"), w, 1),
        "HasOtherLoanPayments": positive_months_flag(F.col("ExternalOtherLoanPayments"), w, 1),
        "HasLargePayments": positive_months_flag(F.col("ExternalLargePayments"), w, 5),
        "LoanPaymentsFromExternalBanks": repeated_count_flag(F.col("NumPaymentsFromExternalBanks"), w, 1, 5),
    }
    return pivot.select(*out, *[c.alias(n) for n, c in flags.items()])


def transaction_features(
    accounts: DataFrame,
    bridge: DataFrame,
    txns: DataFrame,
    spine: DataFrame,
    *,
    start: dt.date,
    end: dt.date,
    keep_unlinked: bool = True,
    count: str = "groups",
    dense: bool = False,
) -> DataFrame:
    """FE21-FE25 in one plan."""
    monthly = monthly_transactions(
        classify_transactions(txns),
        loan_clients(accounts, bridge, start=start, end=end),
        client_accounts(bridge, end=end),
        start=start,
        end=end,
        keep_unlinked=keep_unlinked,
    )
    return transaction_trends(spine_pivot(monthly, spine, count=count, dense=dense))
