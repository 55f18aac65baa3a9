"""Bank-shaped tables derived from the star-schema tables.

A customer is an account, a supplier on a customer's order lines is a client, a part is a
security.  Snapshots are at month ends: a customer has one in each month with an order.
Everything is derived by Spark from the whole tables.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from decimal import Decimal
from functools import cached_property
from typing import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.functions.dates import calendar_days
from ebbline.operators.transactions import has_counterparty
from ebbline.session import Kept
from ebbline.sources.io import read_table

RUN_DATE = dt.date(2001, 8, 2)
MONEY = "decimal(18,2)"
# Invented codes of the one brand and system in these tables.
BRAND, SOURCE = "EX", "LEDGER"

SEGMENT_KIND = {
    "BUILDING": "Home Loan",
    "AUTOMOBILE": "Personal Loan",
    "MACHINERY": "Transaction",
    "HOUSEHOLD": "Savings",
    "FURNITURE": "Credit Card",
}


def _kind() -> Column:
    c = F.col("c_mktsegment")
    out = F.when(c == "BUILDING", SEGMENT_KIND["BUILDING"])
    for seg in list(SEGMENT_KIND)[1:]:
        out = out.when(c == seg, SEGMENT_KIND[seg])
    return out


def _acc(key: str = "o_custkey") -> Column:
    return F.concat(F.lit("0"), F.col(key).cast("string"))


def _letter(code: Column) -> Column:
    """One-letter codes are compared as numbers, which a hash aggregate can hold."""
    return F.char(code)


def _times(col: str, factor: str) -> Column:
    """Exact decimal product."""
    return F.col(col) * F.lit(Decimal(factor))


class Bank:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @contextmanager
    def kept(self) -> Iterator[None]:
        """Keep what many tables are read from: holders, account snapshots, supplier months
        and the order lines, which are joined to orders and holders once for all tables."""
        with Kept(self.spark) as keep:
            try:
                self.__dict__["holders"] = keep(self.holders)
                self.__dict__["wide"] = keep(self._lines_and_holders())
                self.__dict__["lines"] = self.wide.drop("held", "l_shipdate", "l_tax")
                self.__dict__["_supplier_months"] = keep(self._supplier_months)
                self.__dict__["account"] = keep(self.account)
                yield
            finally:
                for name in ("holders", "wide", "lines", "_supplier_months", "account"):
                    self.__dict__.pop(name, None)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet")

    def _branded(self, df: DataFrame, *cols: str | Column) -> DataFrame:
        return df.select(*cols, F.lit(BRAND).alias("Brand"), F.lit(SOURCE).alias("Source"))

    @cached_property
    def orders(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_orderpriority",
            F.col("o_totalprice").cast(MONEY).alias("total"),
            day.alias("d"),
            F.last_day(day).alias("m"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with the customer and the order month."""
        o = self.orders.select("o_orderkey", "o_custkey", "d", "m")
        return self.table("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")

    @cached_property
    def holders(self) -> DataFrame:
        """Fixed attributes per customer, with opening and closing day."""
        span = self.orders.groupBy("o_custkey").agg(F.min("d").alias("opened"), F.max("d").alias("last"))
        closed = F.date_add("last", 10)
        c = self.table("customer")
        n = F.col("c_nationkey")
        product = (
            F.when(n < 5, "Home Deposit")
            .when(n < 10, "Refinance Home Mortgage")
            .when(n < 15, "Debt Consolidation")
            .when(n < 20, "Line of Credit")
            .otherwise("Other purpose")
        )
        return span.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_custkey",
            "opened",
            F.when(closed <= F.lit(RUN_DATE), closed).alias("closed"),
            _kind().alias("kind"),
            F.when(F.col("c_acctbal") >= 0, "Variable").otherwise("Fixed").alias("ratetype"),
            F.when(F.col("c_acctbal") < 5000, "Principal and Interest").otherwise("Interest Only").alias("repay"),
            product.alias("product"),
        )

    def _lines_and_holders(self) -> DataFrame:
        """What the tables read of order lines, with ``held``, kind and closing day of each holder
        of the customer number: none, or several where customers repeat."""
        held = self.holders.groupBy("o_custkey").agg(F.collect_list(F.struct("kind", "closed")).alias("held"))
        o = self.orders.select("o_orderkey", "o_custkey", "m").join(held, "o_custkey", "left")
        lines = self.table("lineitem")
        return lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")

    def told(self, *cols: str | Column) -> DataFrame:
        """``cols`` of the order lines, for ``held_lines``."""
        if "wide" in self.__dict__:
            return self.wide.select("o_custkey", "m", "held", *cols)
        return self.table("lineitem").select("l_orderkey", *cols)

    def held_lines(self, lines: DataFrame) -> DataFrame:
        """Order lines with the order month and the customer's kind and closing day.

        The customer is joined to the orders, which are fewer, so lines are shuffled once; what is
        told of a line is worked out before that.
        """
        if "held" in lines.columns:
            return lines.select("*", F.inline("held")).drop("held")
        o = self.orders.select("o_orderkey", "o_custkey", "m").join(
            self.holders.select("o_custkey", "kind", "closed"), "o_custkey"
        )
        return lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")

    @cached_property
    def account(self) -> DataFrame:
        total = F.col("total")

        def part(status: str) -> Column:
            return F.sum(F.when(F.col("o_orderstatus") == status, total).otherwise(0)).cast(MONEY)

        monthly = self.orders.groupBy("o_custkey", "m").agg(
            F.sum(total).cast(MONEY).alias("balance"),
            F.max(total).alias("largest"),
            part("F").alias("f"),
            part("O").alias("o"),
            part("P").alias("p"),
            F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"),
        )
        f, bal = F.col("f").cast("double"), F.col("balance").cast("double")
        return self._branded(
            monthly.join(self.holders, "o_custkey"),
            _acc().alias("AccountNumber"),
            F.col("m").alias("EndOfDayDate"),
            F.col("kind").alias("GeneralAccountTypeDescription"),
            F.col("ratetype").alias("InterestRateTypeDescription"),
            F.when(F.col("closed") <= F.col("m"), "Closed").otherwise("Open").alias("AccountStatusType"),
            F.col("repay").alias("RepaymentTypeDescription"),
            F.col("product").alias("LoanProductTypeDescription"),
            F.col("opened").alias("CreationDateTimeAEDT"),
            F.col("closed").alias("ClosedDateTimeAEDT"),
            F.add_months("opened", 120).alias("MaturityDate"),
            F.col("largest").alias("ApprovedAmount"),
            (F.col("balance") + F.col("f") + F.col("o")).cast(MONEY).alias("FinancedAmount"),
            F.col("balance").alias("BalanceAmount"),
            F.col("f").alias("InAdvanceAmount"),
            F.col("o").alias("ArrearsAmount"),
            F.col("p").alias("AvailableForRedrawAmount"),
            F.round(f / bal / 10, 4).alias("InterestRate"),
            F.round(F.col("largest").cast("double") / bal, 4).alias("ActualLoanValueRatio"),
            F.col("low").alias("InactiveMonthsCount"),
        )

    @cached_property
    def account_now(self) -> DataFrame:
        """The snapshot of the day before ``RUN_DATE``: one row per account."""
        return self._branded(
            self.holders,
            _acc().alias("AccountNumber"),
            F.lit(RUN_DATE - dt.timedelta(days=1)).alias("EndOfDayDate"),
            F.col("kind").alias("GeneralAccountTypeDescription"),
            F.col("closed").alias("ClosedDateTimeAEDT"),
        )

    @cached_property
    def bridge(self) -> DataFrame:
        # Placed by account and month, which is also how the blocks join it.  The names are the
        # final ones here, so that a filter on the day passes the window.
        held = (
            self.held_lines(self.told("l_suppkey")).select(
                _acc().alias("AccountNumber"), F.col("m").alias("EndOfDayDate"), "l_suppkey", "kind", "closed"
            )
            .repartition("AccountNumber", "EndOfDayDate")
            .distinct()
        )
        k = F.count(F.lit(1)).over(Window.partitionBy("AccountNumber", "EndOfDayDate"))
        return self._branded(
            held,
            "AccountNumber",
            F.col("l_suppkey").cast("string").alias("ClientNumber"),
            F.round(F.lit(1.0) / k, 4).cast("decimal(5,4)").alias("SimpleWeighting"),
            F.when(F.col("closed") <= F.col("EndOfDayDate"), "Closed").otherwise("Open").alias("AccountStatusType"),
            F.col("kind").alias("GeneralAccountTypeDescription"),
            "EndOfDayDate",
        )

    @cached_property
    def _supplier_months(self) -> DataFrame:
        return self.lines.groupBy("l_suppkey", "m").agg(
            F.count_if(F.col("l_returnflag") == "N").alias("n_lines"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
            _letter(F.max(F.ascii("l_returnflag"))).alias("flag"),
            _letter(F.min(F.ascii("l_linestatus"))).alias("status"),
        )

    @cached_property
    def client(self) -> DataFrame:
        s = self.table("supplier")
        return self._branded(
            self._supplier_months.join(s, F.col("l_suppkey") == F.col("s_suppkey")),
            F.col("l_suppkey").cast("string").alias("ClientNumber"),
            F.date_add(F.lit(dt.date(1960, 3, 1)), F.floor("s_acctbal").cast("int")).alias("BirthDate"),
            F.when(F.col("s_nationkey") < 13, "Female").otherwise("Male").alias("GenderCodeDescription"),
            F.col("m").alias("EndOfDayDate"),
        )

    @cached_property
    def security_bridge(self) -> DataFrame:
        pledged = self.lines.groupBy("o_custkey", "m", "l_partkey").agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("pledged")
        )
        return self._branded(
            pledged,
            _acc().alias("AccountNumber"),
            F.col("l_partkey").cast("string").alias("SecurityNumber"),
            F.col("pledged").alias("PledgedAmount"),
            F.col("m").alias("EndOfDayDate"),
        )

    @cached_property
    def security(self) -> DataFrame:
        used = self.lines.select("l_partkey", "m").distinct()
        p = self.table("part")
        return self._branded(
            used.join(p, F.col("l_partkey") == F.col("p_partkey")),
            F.col("l_partkey").cast("string").alias("SecurityNumber"),
            (F.col("p_retailprice").cast(MONEY) * 100).cast(MONEY).alias("ValueAmount"),
            (F.col("p_size") + 2000).cast("string").alias("PostCode"),
            F.col("m").alias("EndOfDayDate"),
        )

    @cached_property
    def address(self) -> DataFrame:
        kind = F.when(F.col("l_linestatus") == "O", "Postal").otherwise("Residential")
        # Every other client stays where it is.
        street = self.lines.groupBy("l_suppkey", "m", kind.alias("kind")).agg(
            F.when(F.col("l_suppkey") % 2 == 0, "A").otherwise(_letter(F.max(F.ascii("l_returnflag")))).alias("street")
        )
        return self._branded(
            street,
            F.col("l_suppkey").cast("string").alias("ClientNumber"),
            F.col("kind").alias("AddressTypeDescription"),
            F.col("street").alias("StreetAddressName1"),
            F.col("m").alias("EndOfDayDate"),
        )

    @cached_property
    def offset_bridge(self) -> DataFrame:
        months = self.orders.select("o_custkey", "m").distinct()
        return self._branded(
            months.join(self.holders, "o_custkey"),
            _acc().alias("AccountNumber"),
            F.concat(F.lit("0"), (F.col("o_custkey") + 1).cast("string")).alias("OffsetAccountNumber"),
            F.col("kind").alias("GeneralAccountTypeDescription"),
            F.col("m").alias("EndOfDayDate"),
        )

    @cached_property
    def activity(self) -> DataFrame:
        return self._branded(
            self._supplier_months,
            F.col("l_suppkey").cast("string").alias("ClientNumber"),
            F.col("n_lines").alias("InternetBankingLogonCountMTD"),
            F.col("qty").alias("MobileBankingLogonCountMTD"),
            F.col("m").alias("EndOfDayDate"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        flag = F.col("l_returnflag")
        plus = (flag == "A") | ((flag == "N") & (F.col("l_linestatus") == "O"))
        n = F.col("l_linenumber")
        lines = self.told(
            "l_linenumber",
            F.col("l_shipdate").cast("date").alias("TransactionDate"),
            F.col("l_extendedprice").cast(MONEY).alias("TransactionAmount"),
            F.when(F.col("l_discount") == 0, 0).when(plus, 1).otherwise(-1).alias("sign"),
            F.when(n != 4, F.col("l_suppkey").cast("string")).alias("CounterPartyBSB"),
            F.col("l_partkey").cast("string").alias("CounterPartyAccountNumber"),
            F.when(F.col("l_tax") == 0, "472").otherwise("100").alias("TransactionCode"),
        )
        lines = lines.withColumn("HasCounterParty", has_counterparty())
        ext, sign = F.col("TransactionAmount"), F.col("sign")
        text = (
            F.when(n == 1, "Home Repayment")
            .when(n == 2, "MORTGAGE transfer")
            .when(n == 3, "Car Loan")
            .otherwise("Card purchase")
        )
        return self._branded(
            self.held_lines(lines),
            _acc().alias("AccountNumber"),
            "TransactionDate",
            F.when(sign == 0, F.lit(0)).when(sign == 1, ext).otherwise(-ext).cast(MONEY).alias("SourceTransactionAmount"),
            "TransactionAmount",
            F.col("kind").alias("GeneralAccountTypeDescription"),
            "CounterPartyBSB",
            "CounterPartyAccountNumber",
            "TransactionCode",
            "HasCounterParty",
            text.alias("TransactionDescription"),
        )

    def calendar(self, start: dt.date, end: dt.date) -> DataFrame:
        return calendar_days(self.spark, start, end)

    @cached_property
    def loans(self) -> DataFrame:
        daily = self.orders.groupBy("o_custkey", "d").agg(F.sum("total").cast(MONEY).alias("total"))
        nxt = F.lead("d").over(Window.partitionBy("o_custkey").orderBy("d"))
        return daily.select(
            F.col("o_custkey").alias("ACC_NO"),
            F.when(F.col("total") >= 50000, F.floor("total").cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias("NORM_PYMT"),
            F.col("d").alias("RowStartDate"),
            nxt.alias("RowEndDate"),
        )

    @cached_property
    def applications(self) -> DataFrame:
        number = (F.col("o_orderkey") + 100000).cast("string")
        status = F.col("o_orderstatus")
        form = (
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
            .when(status == "F", F.concat(F.lit("AB"), number))
            .when(status == "O", F.concat(F.lit("ABC"), number))
            .otherwise(number)
        )
        return self.orders.select(
            F.col("o_custkey").alias("ACC_NO"),
            form.alias("ALPS_APPL_NO"),
            F.date_format("d", "yyyyMMdd").cast("bigint").alias("PROC_DATE"),
        )

    @cached_property
    def serviceability(self) -> DataFrame:
        total = F.col("total")
        return self.orders.select(
            (F.col("o_orderkey") + 100000).alias("applicationId"),
            F.when(F.col("o_orderpriority") == "2-HIGH", "OTHER").otherwise("APPLICANT").alias("type"),
            _times("total", "0.005").cast("decimal(21,5)").alias("repaymentAmount"),
            F.when(total < 20000, F.lit(50)).otherwise(_times("total", "0.05")).cast("decimal(20,4)").alias("totalIncomeValue"),
            _times("total", "0.02").cast("decimal(20,4)").alias("totalExpenseValue"),
            F.col("d").alias("RowStartDate"),
            F.when(F.col("o_orderstatus") != "F", F.date_add("d", 400)).alias("RowEndDate"),
        )

    @cached_property
    def customer_history(self) -> DataFrame:
        nxt = F.lead("m").over(Window.partitionBy("l_suppkey").orderBy("m"))
        return self._supplier_months.select(
            F.col("l_suppkey").alias("CUS_NO"),
            F.concat("flag", "status").alias("OCC_CDE"),
            F.col("m").alias("RowStartDate"),
            nxt.alias("RowEndDate"),
        )

    @cached_property
    def market(self) -> DataFrame:
        p = self.table("part").select("p_partkey", "p_size", "p_type")
        kind = F.when(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE"), "H").otherwise("U")
        g = self.lines.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy(
            "p_size", "m", kind.alias("kind")
        )
        ext = F.col("l_extendedprice").cast(MONEY)
        return g.agg(
            F.sum(F.col("l_discount").cast(MONEY)).alias("disc"),
            F.sum(ext).cast(MONEY).alias("ext"),
            F.max(ext).alias("top"),
            F.max("l_quantity").alias("days"),
            F.max("l_linenumber").alias("hold"),
        ).select(
            (F.col("p_size") + 2000).alias("Postcode"),
            F.col("m").alias("Month_end"),
            F.col("kind").alias("Property_Type"),
            F.col("disc").cast("double").alias("percentage_stock_on_market"),
            F.col("ext").cast("double").alias("Median_sales_price_last_12_months"),
            F.col("top").cast("double").alias("Median_sales_price_last_6_months"),
            F.col("days").alias("Median_days_on_market_for_properties_sold_in_last_12_months"),
            F.col("hold").cast("double").alias("Average_hold_period"),
        )

    @cached_property
    def rates(self) -> DataFrame:
        return self.orders.groupBy("m").agg(F.max("total").alias("top")).select(
            F.col("m").alias("Month"), F.round(F.col("top").cast("double") / 100000, 4).alias("FLRHOOVA")
        )

    @cached_property
    def loan_repayment(self) -> DataFrame:
        monthly = self.orders.groupBy("o_custkey", "m").agg(
            F.sum("total").cast(MONEY).alias("balance"),
            F.max("total").alias("largest"),
            _letter(F.min(F.ascii("o_orderpriority"))).alias("first"),
        )
        channel = F.when(F.col("first") == "1", "Broker").when(F.col("first") != "5", "Branch")
        return self._branded(
            monthly,
            _acc().alias("Accountnumber"),
            F.col("m").alias("EndOfMonth"),
            _times("balance", "0.01").cast("double").alias("MtdInterestCharge"),
            (F.col("balance") - F.col("largest")).cast("double").alias("MtdLoanRunoff"),
            channel.alias("LoanChannel"),
        )
