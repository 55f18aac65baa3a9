"""Accounts reachable through shared clients, without quadratic groups (FE9, J6).

``COUNT(DISTINCT related account)`` over account -> clients -> accounts is a two-step
walk over the bridge.  Enumerating it costs (accounts of a client) squared, which fails
for one client that holds a large share of all accounts.  Instead:

* Every account is reduced to the set of its clients, and measures are added up per
  distinct set: a related account shares a client with b when its set meets the set of b.
* The clients of a base set are ranked by how many member sets they are in.  The two
  largest, c and d, are never walked: by inclusion and exclusion, the sets that meet
  {c, d} total T(c) + T(d) - T(c, d).  T is an aggregation per client, and per different
  couple, looked up by its rarer client.
* The remaining clients are walked from set to set, and the sets found that hold neither
  c nor d are added.

So a client with very many accounts, or a couple of them, costs what it holds once, also
where each of its accounts has another third client.  Only base sets that share three such
clients walk, from one distinct set each.  There is one plan for all data.  All measures are
counts or decimals, so the signed sum is exact.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.dates import AsOf, at_snapshot, month_diff

# Base sets that many accounts have, and the totals of one client, are dealt over so many
# places.
PLACES = 8

# Account kinds by what they are.
RELATED_KINDS = ["Transaction", "Savings", "Term Share", "Home Loan", "Credit Card", "Personal Loan"]
HOLDING_KINDS = ["Savings", "Transaction", "Term Share"]
OWING_KINDS = ["Personal Loan", "Home Loan"]
SAVINGS_KINDS = ["Savings", "Term Share"]
LENDING_KINDS = ["Credit Card", "Personal Loan", "Home Loan"]


def _measures() -> dict[str, Column]:
    """Additive measures of one related account."""
    kind, is_open = F.col("kind"), F.col("status") == "Open"

    def one(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0).cast("bigint")

    def money(cond: Column) -> Column:
        return F.when(cond, F.col("balance")).otherwise(F.lit(0)).cast("decimal(28,2)")

    holds, owes = is_open & kind.isin(HOLDING_KINDS), is_open & kind.isin(OWING_KINDS)
    has = F.col("balance").isNotNull()
    return {
        "n_open": one(is_open),
        "n_closed": one(F.col("status") == "Closed"),
        "held": money(holds),
        "n_held": one(holds & has),
        "owed": money(owes),
        "n_owed": one(owes & has),
        "n_txn": one(is_open & (kind == "Transaction")),
        "n_sav": one(is_open & kind.isin(SAVINGS_KINDS)),
        "n_lend": one(is_open & kind.isin(LENDING_KINDS)),
        "n_all": F.lit(1).cast("bigint"),
    }


NAMES = ["n_open", "n_closed", "held", "n_held", "owed", "n_owed", "n_txn", "n_sav", "n_lend", "n_all"]


def _sum_all(names: Sequence[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _set_id(keys: Sequence[str]) -> Column:
    """An id of the set of clients of the rows of each key: two 64-bit hashes combined over
    the clients, and their number."""
    w = Window.partitionBy(*keys)
    return F.struct(
        F.count("client").over(w).alias("n"),
        F.bit_xor(F.xxhash64("client")).over(w).alias("x"),
        F.bit_xor(F.xxhash64("client", F.lit("second"))).over(w).alias("y"),
    )


def _place(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(PLACES)).cast("int")


def related_totals(
    base: DataFrame, members: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Totals over the distinct accounts that share a client with each base account.

    ``base``: as_of_date, account, client.  ``members``: as_of_date, client, related,
    status, kind, balance, where the last three belong to (as_of_date, related).  Rows may
    repeat; rows without a client link nothing; base accounts without a related account
    have no row.  ``keep`` may write the steps that others read, one after the other.
    """
    values = _measures()
    day = "as_of_date"
    of_member = [day, "related", "status", "kind", "balance"]
    linked = (
        members.filter(F.col("client").isNotNull()).select(*of_member, "client").distinct().withColumn("_id", _set_id(of_member))
    )
    # Every client of a distinct member set, with the measures of the set: each account has
    # one row per client, so adding up per set and client counts it once.
    held = keep(linked.groupBy(day, "_id", "client").agg(*[F.sum(v).alias(n) for n, v in values.items()]))
    places = F.explode(F.sequence(F.lit(0), F.lit(PLACES - 1))).alias("_p")
    per_client = held.groupBy(day, "client").agg(F.count(F.lit(1)).alias("_n"), *_sum_all(NAMES)).select("*", places)

    asked = keep(
        base.filter(F.col("client").isNotNull())
        .select(day, "account", "client")
        .distinct()
        .withColumn("_b", F.struct(_set_id([day, "account"]).alias("set"), _place("account").alias("place")))
    )
    accounts = asked.select(day, "account", "_b").distinct()
    whole = Window.partitionBy(day, "_b")

    def at(rank: int) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col("client"))).over(whole)

    ranked = keep(
        asked.select(day, "_b", "client")
        .distinct()
        .withColumn("_p", _place("_b"))
        .join(per_client, [day, "client", "_p"])
        .withColumn("_rank", F.row_number().over(whole.orderBy(F.desc("_n"), "client")))
        .withColumns({"_c": at(1), "_d": at(2)})
    )

    # Only the other side of a join is renamed, so that the shuffles of ``held`` are shared.
    def holding(found: DataFrame, who: str, how: str) -> DataFrame:
        """Rows whose member set holds the client in ``who``, or those whose set does not."""
        return found.withColumn("client", F.col(who)).join(held, [day, "_id", "client"], how).drop("client")

    couples = ranked.filter("_rank = 2").select(day, "_c", "_d").distinct()
    sets = couples.withColumn("client", F.col("_d")).join(held, [day, "client"]).drop("client")
    both = holding(sets, "_c", "left_semi")
    per_couple = both.groupBy(day, "_c", "_d").agg(*[F.sum(n).alias(f"_{n}") for n in NAMES]).withColumn("_rank", F.lit(2))
    counted = keep(
        ranked.filter("_rank <= 2")
        .join(per_couple, [day, "_c", "_d", "_rank"], "left")
        .select(day, "_b", *[(F.col(n) - F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in NAMES])
    )
    walked = (
        ranked.filter("_rank > 2")
        .select(day, "_b", "_c", "_d", "client")
        .join(held, [day, "client"])
        .drop("client")
        .dropDuplicates([day, "_b", "_id"])
    )
    others = keep(holding(holding(walked, "_c", "left_anti"), "_d", "left_anti").select(day, "_b", *NAMES))
    return (
        counted.unionByName(others)
        .groupBy(day, "_b")
        .agg(*_sum_all(NAMES))
        .join(accounts, [day, "_b"])
        .select(day, "account", *NAMES)
    )


def related_accounts(
    asof: AsOf,
    base: DataFrame,
    client_map: DataFrame,
    accounts: DataFrame,
    *,
    closed_months: int = 6,
    held: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Open, recently closed, held and owed over all accounts of the same clients (FE9).

    The base account is one of them, as specified.  ``held`` is the client map of the base
    accounts, where the caller has it; for ``keep`` see ``related_totals``.
    """
    state = at_snapshot(accounts, asof).select(
        "as_of_date",
        F.col("AccountNumber").alias("related"),
        F.col("AccountStatusType").alias("status"),
        F.col("GeneralAccountTypeDescription").alias("kind"),
        F.col("BalanceAmount").cast("decimal(18,2)").alias("balance"),
        F.col("ClosedDateTimeAEDT").cast("date").alias("closed"),
    )
    gap = month_diff(F.col("as_of_date"), F.col("closed"))
    state = state.filter((F.col("status") == "Open") | gap.between(0, closed_months)).drop("closed")
    holdings = client_map.filter(F.col("GeneralAccountTypeDescription").isin(RELATED_KINDS)).select(
        "as_of_date", F.col("ClientNumber").alias("client"), F.col("AccountNumber").alias("related")
    )
    # A repeated bridge row does no harm: accounts are made distinct per base account.
    members = holdings.join(state, ["as_of_date", "related"])
    base_clients = base.select("as_of_date", F.col("AccountNumber").alias("account")).join(
        (client_map if held is None else held).select(
            "as_of_date", F.col("AccountNumber").alias("account"), F.col("ClientNumber").alias("client")
        ),
        ["as_of_date", "account"],
    )
    t = related_totals(base_clients, members, keep)
    return t.select(
        "as_of_date",
        F.col("account").alias("AccountNumber"),
        F.col("n_open").alias("OtherOpenAccounts"),
        F.col("n_closed").alias("AccountsClosedInLast3M"),
        F.when(F.col("n_held") > 0, F.col("held").cast("double")).alias("CurrentHoldings"),
        F.when(F.col("n_owed") > 0, F.col("owed").cast("double")).alias("CurrentlyOwingLoans"),
        F.col("n_txn").alias("NumTransactionAccounts"),
        F.col("n_sav").alias("NumSavingsAccounts"),
        F.col("n_lend").alias("NumLendingAccounts"),
    )
