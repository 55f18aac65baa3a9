"""The bank-shaped tables as SQL, for the side-by-side check."""

BANK = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total,
         CAST(o_orderdate AS DATE) AS d, last_day(CAST(o_orderdate AS DATE)) AS m
  FROM orders),
ln AS (
  SELECT l.*, o_custkey, d, m FROM lineitem l JOIN o ON l_orderkey = o_orderkey),
holders AS (
  SELECT c_custkey AS o_custkey, opened,
         CASE WHEN last + 10 <= DATE '2001-08-02' THEN last + 10 END AS closed,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Home Loan' WHEN 'AUTOMOBILE' THEN 'Personal Loan'
              WHEN 'MACHINERY' THEN 'Transaction' WHEN 'HOUSEHOLD' THEN 'Savings'
              WHEN 'FURNITURE' THEN 'Credit Card' END AS kind,
         CASE WHEN c_acctbal >= 0 THEN 'Variable' ELSE 'Fixed' END AS ratetype,
         CASE WHEN c_acctbal < 5000 THEN 'Principal and Interest' ELSE 'Interest Only' END AS repay,
         CASE WHEN c_nationkey < 5 THEN 'Home Deposit' WHEN c_nationkey < 10 THEN 'Refinance Home Mortgage'
              WHEN c_nationkey < 15 THEN 'Debt Consolidation' WHEN c_nationkey < 20 THEN 'Line of Credit'
              ELSE 'Other purpose' END AS product
  FROM customer
  JOIN (SELECT o_custkey AS k, min(d) AS opened, max(d) AS last FROM o GROUP BY 1) s ON k = c_custkey),
account AS (
  SELECT '0' || CAST(a.o_custkey AS VARCHAR) AS AccountNumber, m AS EndOfDayDate,
         kind AS GeneralAccountTypeDescription, ratetype AS InterestRateTypeDescription,
         CASE WHEN closed <= m THEN 'Closed' ELSE 'Open' END AS AccountStatusType,
         repay AS RepaymentTypeDescription, product AS LoanProductTypeDescription,
         opened AS CreationDateTimeAEDT, closed AS ClosedDateTimeAEDT,
         CAST(opened + INTERVAL 120 MONTH AS DATE) AS MaturityDate,
         largest AS ApprovedAmount, balance + f + ob AS FinancedAmount, balance AS BalanceAmount,
         f AS InAdvanceAmount, ob AS ArrearsAmount, p AS AvailableForRedrawAmount,
         round(CAST(f AS DOUBLE) / CAST(balance AS DOUBLE) / 10, 4) AS InterestRate,
         round(CAST(largest AS DOUBLE) / CAST(balance AS DOUBLE), 4) AS ActualLoanValueRatio,
         low AS InactiveMonthsCount
  FROM (SELECT o_custkey, m, sum(total) AS balance, max(total) AS largest,
               sum(CASE WHEN o_orderstatus = 'F' THEN total ELSE 0 END) AS f,
               sum(CASE WHEN o_orderstatus = 'O' THEN total ELSE 0 END) AS ob,
               sum(CASE WHEN o_orderstatus = 'P' THEN total ELSE 0 END) AS p,
               count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low
        FROM o GROUP BY 1, 2) a
  JOIN holders h ON h.o_custkey = a.o_custkey),
account_now AS (
  SELECT '0' || CAST(o_custkey AS VARCHAR) AS AccountNumber, kind AS GeneralAccountTypeDescription,
         closed AS ClosedDateTimeAEDT FROM holders),
held AS (SELECT DISTINCT o_custkey, m, l_suppkey FROM ln),
bridge AS (
  SELECT '0' || CAST(b.o_custkey AS VARCHAR) AS AccountNumber, CAST(l_suppkey AS VARCHAR) AS ClientNumber,
         CAST(round(CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY b.o_custkey, m), 4) AS DECIMAL(5,4)) AS SimpleWeighting,
         CASE WHEN closed <= m THEN 'Closed' ELSE 'Open' END AS AccountStatusType,
         kind AS GeneralAccountTypeDescription, m AS EndOfDayDate
  FROM held b JOIN holders h ON h.o_custkey = b.o_custkey),
supplier_months AS (
  SELECT l_suppkey, m, count(*) FILTER (WHERE l_returnflag = 'N') AS n_lines,
         sum(CAST(l_quantity AS BIGINT)) AS qty, max(l_returnflag) AS flag, min(l_linestatus) AS status
  FROM ln GROUP BY 1, 2),
client AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ClientNumber,
         DATE '1960-03-01' + CAST(floor(s_acctbal) AS INTEGER) AS BirthDate,
         CASE WHEN s_nationkey < 13 THEN 'Female' ELSE 'Male' END AS GenderCodeDescription,
         m AS EndOfDayDate
  FROM supplier_months JOIN supplier ON l_suppkey = s_suppkey),
security_bridge AS (
  SELECT '0' || CAST(o_custkey AS VARCHAR) AS AccountNumber, CAST(l_partkey AS VARCHAR) AS SecurityNumber,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS PledgedAmount, m AS EndOfDayDate
  FROM ln GROUP BY o_custkey, m, l_partkey),
security AS (
  SELECT CAST(l_partkey AS VARCHAR) AS SecurityNumber,
         CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS ValueAmount,
         CAST(p_size + 2000 AS VARCHAR) AS PostCode, m AS EndOfDayDate
  FROM (SELECT DISTINCT l_partkey, m FROM ln) u JOIN part ON l_partkey = p_partkey),
address AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ClientNumber,
         CASE WHEN l_linestatus = 'O' THEN 'Postal' ELSE 'Residential' END AS AddressTypeDescription,
         CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE max(l_returnflag) END AS StreetAddressName1, m AS EndOfDayDate
  FROM ln GROUP BY l_suppkey, m, 2),
offset_bridge AS (
  SELECT DISTINCT '0' || CAST(o.o_custkey AS VARCHAR) AS AccountNumber,
         '0' || CAST(o.o_custkey + 1 AS VARCHAR) AS OffsetAccountNumber,
         kind AS GeneralAccountTypeDescription, m AS EndOfDayDate
  FROM o JOIN holders h ON h.o_custkey = o.o_custkey),
activity AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ClientNumber, n_lines AS web, qty AS app, m AS EndOfDayDate
  FROM supplier_months),
txns AS (
  SELECT '0' || CAST(ln.o_custkey AS VARCHAR) AS AccountNumber, CAST(l_shipdate AS DATE) AS TransactionDate,
         CASE WHEN l_discount = 0 THEN 0
              WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'O')
              THEN CAST(l_extendedprice AS DECIMAL(18,2))
              ELSE -CAST(l_extendedprice AS DECIMAL(18,2)) END AS amt,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS TransactionAmount,
         kind,
         CASE WHEN l_linenumber <> 4 THEN CAST(l_suppkey AS VARCHAR) END AS bsb,
         CAST(l_partkey AS VARCHAR) AS counterparty,
         CASE WHEN l_tax = 0 THEN '472' ELSE '100' END AS code,
         CASE l_linenumber WHEN 1 THEN 'Home Repayment' WHEN 2 THEN 'MORTGAGE transfer'
              WHEN 3 THEN 'Car Loan' ELSE 'Card purchase' END AS descr
  FROM ln JOIN holders h ON h.o_custkey = ln.o_custkey),
loans AS (
  SELECT o_custkey AS ACC_NO, CASE WHEN total >= 50000 THEN CAST(floor(total) AS DECIMAL(16,0)) * 0.01 END AS NORM_PYMT,
         d AS RowStartDate, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS RowEndDate
  FROM (SELECT o_custkey, d, sum(total) AS total FROM o GROUP BY 1, 2)),
applications AS (
  SELECT o_custkey AS ACC_NO,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
              WHEN o_orderstatus = 'F' THEN 'AB' || CAST(o_orderkey + 100000 AS VARCHAR)
              WHEN o_orderstatus = 'O' THEN 'ABC' || CAST(o_orderkey + 100000 AS VARCHAR)
              ELSE CAST(o_orderkey + 100000 AS VARCHAR) END AS ALPS_APPL_NO,
         CAST(strftime(d, '%Y%m%d') AS BIGINT) AS PROC_DATE
  FROM o),
serviceability AS (
  SELECT o_orderkey + 100000 AS applicationId,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 'OTHER' ELSE 'APPLICANT' END AS type,
         total * 0.005 AS repaymentAmount,
         CASE WHEN total < 20000 THEN 50 ELSE total * 0.05 END AS totalIncomeValue,
         total * 0.02 AS totalExpenseValue, d AS RowStartDate,
         CASE WHEN o_orderstatus <> 'F' THEN d + 400 END AS RowEndDate
  FROM o),
customer_history AS (
  SELECT l_suppkey AS CUS_NO, flag || status AS OCC_CDE, m AS RowStartDate,
         lead(m) OVER (PARTITION BY l_suppkey ORDER BY m) AS RowEndDate
  FROM supplier_months),
market AS (
  SELECT p_size + 2000 AS Postcode, m AS Month_end,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'H' ELSE 'U' END AS Property_Type,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS percentage_stock_on_market,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Median_sales_price_last_12_months,
         max(l_extendedprice) AS Median_sales_price_last_6_months,
         max(l_quantity) AS Median_days_on_market_for_properties_sold_in_last_12_months,
         CAST(max(l_linenumber) AS DOUBLE) AS Average_hold_period
  FROM ln JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
rates AS (
  SELECT m AS Month, round(CAST(max(total) AS DOUBLE) / 100000, 4) AS FLRHOOVA FROM o GROUP BY 1),
loan_repayment AS (
  SELECT '0' || CAST(o_custkey AS VARCHAR) AS AccountNumber, m AS EndOfMonth,
         CAST(sum(total) * 0.01 AS DOUBLE) AS MtdInterestCharge,
         CAST(sum(total) - max(total) AS DOUBLE) AS MtdLoanRunoff,
         CASE min(o_orderpriority) WHEN '1-URGENT' THEN 'Broker' WHEN '5-LOW' THEN NULL ELSE 'Branch' END AS LoanChannel
  FROM o GROUP BY o_custkey, m),
asof_days AS (
  SELECT CAST(DATE '1998-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS as_of,
         CAST(DATE '1998-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) - 1 AS as_of_date,
         CASE WHEN i < 24 THEN 'train' ELSE 'test' END AS split
  FROM range(0, 36) t(i)),
series AS (
  SELECT as_of_date, k, CAST(CAST(as_of - to_months(CAST(k AS INTEGER)) AS DATE) - 1 AS DATE) AS snap
  FROM asof_days, range(0, 10) t(k))
"""

# Feature blocks over the tables above.
PAID = """
paid AS (
  SELECT as_of_date, ACC_NO, NORM_PYMT FROM loans JOIN asof_days
    ON RowStartDate <= as_of_date AND (RowEndDate > as_of_date OR RowEndDate IS NULL)
   AND as_of_date <= coalesce(RowEndDate, DATE '2001-08-02')
  WHERE NORM_PYMT IS NOT NULL)"""

BASE = PAID + """,
base AS (
  SELECT s.as_of_date, a.*, p.NORM_PYMT AS CurrentMonthlyInstallment,
         CAST(CAST(floor(a.FinancedAmount / 50000) AS BIGINT) * 50000 AS VARCHAR) || '-' ||
         CAST(CAST(floor(a.FinancedAmount / 50000) AS BIGINT) * 50000 + 49999 AS VARCHAR) AS FinancedAmountBucket,
         CASE LoanProductTypeDescription WHEN 'Home Deposit' THEN 'first home purchase'
              WHEN 'Refinance Home Mortgage' THEN 'refinancing - house'
              WHEN 'Debt Consolidation' THEN 'refinancing - debt management'
              WHEN 'Line of Credit' THEN 'refinancing - personal'
              ELSE LoanProductTypeDescription END AS LoanCategory
  FROM account a JOIN asof_days s ON a.EndOfDayDate = s.as_of_date
  LEFT JOIN paid p ON p.as_of_date = s.as_of_date AND p.ACC_NO = TRY_CAST(a.AccountNumber AS BIGINT)
  WHERE GeneralAccountTypeDescription = 'Home Loan' AND InterestRateTypeDescription = 'Variable'
    AND AccountStatusType = 'Open' AND BalanceAmount >= 100000
    AND s.as_of_date - a.CreationDateTimeAEDT >= 200),
cmap AS (
  SELECT as_of_date, AccountNumber, ClientNumber, SimpleWeighting, AccountStatusType, GeneralAccountTypeDescription
  FROM bridge JOIN asof_days ON EndOfDayDate = as_of_date)"""

DETAILS = """
details AS (
  SELECT m.as_of_date, AccountNumber, count(DISTINCT m.ClientNumber) AS NumClients,
         max(year(m.as_of_date) - year(BirthDate)
             - CASE WHEN dayofyear(m.as_of_date) < dayofyear(BirthDate) THEN 1 ELSE 0 END) AS MaxAge,
         CASE WHEN count(DISTINCT GenderCodeDescription) > 1 THEN 'Couple'
              ELSE min(GenderCodeDescription) END AS Gendercomposition
  FROM cmap m JOIN client c ON c.ClientNumber = m.ClientNumber AND c.EndOfDayDate = m.as_of_date
  GROUP BY 1, 2)"""

SECURITIES = """
securities AS (
  SELECT as_of_date, AccountNumber, sum(ValueAmount) AS TotalSecurityValue, max(ValueAmount) AS MaxSecurityValue,
         max(CASE WHEN rn = 1 THEN PostCode END) AS PostCode
  FROM (SELECT s.as_of_date, b.AccountNumber, v.ValueAmount, v.PostCode,
               row_number() OVER (PARTITION BY s.as_of_date, b.AccountNumber
                                  ORDER BY PledgedAmount DESC, b.SecurityNumber DESC) AS rn
        FROM security_bridge b JOIN asof_days s ON b.EndOfDayDate = s.as_of_date
        JOIN security v ON v.SecurityNumber = b.SecurityNumber AND v.EndOfDayDate = b.EndOfDayDate)
  GROUP BY 1, 2)"""

CHANGED = """
changed AS (
  SELECT c.as_of_date, c.AccountNumber, CASE WHEN sum(n) > 0 THEN 1 ELSE 0 END AS AddressChangedIn6M
  FROM (SELECT as_of_date, ClientNumber, sum(CAST(StreetAddressName1 <> prev AS INTEGER)) AS n
        FROM (SELECT s.as_of_date, a.*, lag(StreetAddressName1) OVER (
                PARTITION BY s.as_of_date, ClientNumber, AddressTypeDescription ORDER BY EndOfDayDate) AS prev
              FROM address a JOIN series s ON s.snap = a.EndOfDayDate AND s.k <= 5)
        GROUP BY 1, 2) x
  JOIN cmap c ON c.as_of_date = x.as_of_date AND c.ClientNumber = x.ClientNumber
   AND c.GeneralAccountTypeDescription = 'Home Loan'
  GROUP BY 1, 2)"""

RELATED = """
related AS (
  SELECT p.as_of_date, p.AccountNumber,
         count(*) FILTER (WHERE st = 'Open') AS OtherOpenAccounts,
         count(*) FILTER (WHERE st = 'Closed') AS AccountsClosedInLast3M,
         sum(bal) FILTER (WHERE st = 'Open' AND kind IN ('Savings', 'Transaction', 'Term Share')) AS CurrentHoldings,
         sum(bal) FILTER (WHERE st = 'Open' AND kind IN ('Personal Loan', 'Home Loan')) AS CurrentlyOwingLoans,
         count(*) FILTER (WHERE st = 'Open' AND kind = 'Transaction') AS NumTransactionAccounts,
         count(*) FILTER (WHERE st = 'Open' AND kind IN ('Savings', 'Term Share')) AS NumSavingsAccounts,
         count(*) FILTER (WHERE st = 'Open' AND kind IN ('Credit Card', 'Personal Loan', 'Home Loan')) AS NumLendingAccounts
  FROM (SELECT DISTINCT b.as_of_date, b.AccountNumber, c2.AccountNumber AS rel
        FROM base b
        JOIN cmap c1 ON c1.as_of_date = b.as_of_date AND c1.AccountNumber = b.AccountNumber
        JOIN cmap c2 ON c2.as_of_date = b.as_of_date AND c2.ClientNumber = c1.ClientNumber
        WHERE c2.GeneralAccountTypeDescription IN
          ('Transaction', 'Savings', 'Term Share', 'Home Loan', 'Credit Card', 'Personal Loan')) p
  JOIN (SELECT AccountNumber AS an, EndOfDayDate AS ed, AccountStatusType AS st, BalanceAmount AS bal,
               GeneralAccountTypeDescription AS kind, ClosedDateTimeAEDT AS cl FROM account) a
    ON a.an = p.rel AND a.ed = p.as_of_date
  WHERE st = 'Open' OR (year(p.as_of_date) - year(cl)) * 12 + month(p.as_of_date) - month(cl) BETWEEN 0 AND 6
  GROUP BY 1, 2)"""

LOGINS = """
logins AS (
  SELECT as_of_date, AccountNumber, (w3 - w6) / nullif(w6, 0) AS WebLoginsRelChange,
         (a3 - a6) / nullif(a6, 0) AS ApploginsRelChange
  FROM (SELECT as_of_date, AccountNumber,
               avg(CASE WHEN back BETWEEN 0 AND 2 THEN web END) AS w3,
               avg(CASE WHEN back BETWEEN 3 AND 8 THEN web END) AS w6,
               avg(CASE WHEN back BETWEEN 0 AND 2 THEN app END) AS a3,
               avg(CASE WHEN back BETWEEN 3 AND 8 THEN app END) AS a6
        FROM (SELECT c.as_of_date, c.AccountNumber,
                     (year(c.as_of_date) - year(v.EndOfDayDate)) * 12
                       + month(c.as_of_date) - month(v.EndOfDayDate) AS back,
                     CAST(sum(web) AS DOUBLE) AS web, CAST(sum(app) AS DOUBLE) AS app
              FROM cmap c JOIN series s ON s.as_of_date = c.as_of_date
              JOIN activity v ON v.ClientNumber = c.ClientNumber AND v.EndOfDayDate = s.snap
              GROUP BY 1, 2, 3)
        GROUP BY 1, 2))"""

INCOME = """
income AS (
  SELECT b.as_of_date, b.AccountNumber, l.app_no AS ApplicationNumber, r.repaymentAmount,
         CASE WHEN r.totalIncomeValue < 100 THEN NULL ELSE r.totalIncomeValue END AS MonthlyIncome,
         r.totalExpenseValue AS MonthlyExpenses
  FROM base b
  LEFT JOIN (SELECT as_of_date, CAST(ACC_NO AS VARCHAR) AS loan,
                    CASE WHEN length(ALPS_APPL_NO) = 8 THEN substr(ALPS_APPL_NO, 3)
                         WHEN length(ALPS_APPL_NO) = 9 THEN substr(ALPS_APPL_NO, 4)
                         ELSE ALPS_APPL_NO END AS app_no
             FROM (SELECT s.as_of_date, h.*, row_number() OVER (
                            PARTITION BY s.as_of_date, ACC_NO ORDER BY PROC_DATE DESC, ALPS_APPL_NO DESC) AS rn
                   FROM applications h JOIN asof_days s
                     ON h.PROC_DATE <= CAST(strftime(s.as_of_date, '%Y%m%d') AS BIGINT)
                   WHERE length(CAST(PROC_DATE AS VARCHAR)) = 8 AND ALPS_APPL_NO IS NOT NULL)
             WHERE rn = 1) l
    ON l.as_of_date = b.as_of_date AND l.loan = substr(b.AccountNumber, 2)
  LEFT JOIN (SELECT * FROM serviceability JOIN asof_days
               ON RowStartDate <= as_of_date AND (RowEndDate > as_of_date OR RowEndDate IS NULL)
             WHERE type = 'APPLICANT') r
    ON r.as_of_date = b.as_of_date AND CAST(r.applicationId AS VARCHAR) = l.app_no)"""

LATER = """
later AS (
  SELECT b.as_of_date, b.AccountNumber, sum(c2.SimpleWeighting * p.NORM_PYMT) AS AdditionalRepayments
  FROM base b
  JOIN cmap c1 ON c1.as_of_date = b.as_of_date AND c1.AccountNumber = b.AccountNumber
  JOIN cmap c2 ON c2.as_of_date = b.as_of_date AND c2.ClientNumber = c1.ClientNumber
  JOIN account a ON a.AccountNumber = c2.AccountNumber AND a.EndOfDayDate = b.as_of_date
  LEFT JOIN paid p ON p.as_of_date = b.as_of_date AND p.ACC_NO = TRY_CAST(a.AccountNumber AS BIGINT)
  WHERE c2.GeneralAccountTypeDescription IN ('Home Loan', 'Commercial Loan', 'Personal Loan')
    AND a.AccountStatusType = 'Open' AND a.CreationDateTimeAEDT > b.CreationDateTimeAEDT
    AND a.CreationDateTimeAEDT <= b.as_of_date
  GROUP BY 1, 2)"""

REPAYMENTS = """
repayments AS (
  SELECT b.as_of_date, b.AccountNumber, sum(r) AS TotalMonthlyRepayments
  FROM base b
  LEFT JOIN cmap c ON c.as_of_date = b.as_of_date AND c.AccountNumber = b.AccountNumber
  LEFT JOIN (SELECT m.as_of_date AS ad, m.ClientNumber AS cn, sum(p.NORM_PYMT * m.SimpleWeighting) AS r
             FROM cmap m
             JOIN account a ON a.AccountNumber = m.AccountNumber AND a.EndOfDayDate = m.as_of_date
             LEFT JOIN paid p ON p.as_of_date = m.as_of_date AND p.ACC_NO = TRY_CAST(a.AccountNumber AS BIGINT)
             WHERE m.AccountStatusType = 'Open'
               AND m.GeneralAccountTypeDescription IN ('Home Loan', 'Commercial Loan', 'Personal Loan')
             GROUP BY 1, 2) x
    ON x.ad = c.as_of_date AND x.cn = c.ClientNumber
  GROUP BY 1, 2)"""

CODES = """
codes AS (
  SELECT b.as_of_date, b.AccountNumber, c.ClientNumber, h.OCC_CDE AS OccupationCode
  FROM base b
  LEFT JOIN cmap c ON c.as_of_date = b.as_of_date AND c.AccountNumber = b.AccountNumber
  LEFT JOIN (SELECT * FROM customer_history JOIN asof_days
               ON RowStartDate <= as_of_date AND (RowEndDate >= as_of_date OR RowEndDate IS NULL)) h
    ON h.as_of_date = b.as_of_date AND h.CUS_NO = TRY_CAST(c.ClientNumber AS BIGINT))"""

IMPUTED = """
means AS (
  SELECT o.as_of_date, o.OccupationCode, avg(CAST(i.MonthlyIncome AS DOUBLE)) AS mi,
         avg(CAST(i.MonthlyExpenses AS DOUBLE)) AS me
  FROM codes o JOIN details d ON d.as_of_date = o.as_of_date AND d.AccountNumber = o.AccountNumber
  LEFT JOIN income i ON i.as_of_date = o.as_of_date AND i.AccountNumber = o.AccountNumber
  WHERE d.NumClients = 1 GROUP BY 1, 2),
imputed AS (
  SELECT i.as_of_date, i.AccountNumber, coalesce(CAST(i.MonthlyIncome AS DOUBLE), e.mi) AS IncomeMonthly,
         coalesce(CAST(i.MonthlyExpenses AS DOUBLE), e.me) AS ExpensesMonthly
  FROM income i
  LEFT JOIN (SELECT o.as_of_date AS ad, o.AccountNumber AS an, sum(mi) AS mi, sum(me) AS me
             FROM codes o LEFT JOIN means m
               ON m.as_of_date = o.as_of_date AND m.OccupationCode = o.OccupationCode
             GROUP BY 1, 2) e ON e.ad = i.as_of_date AND e.an = i.AccountNumber)"""

LOOKUPS = """
market_at AS (
  SELECT s.as_of_date, CAST(Postcode AS VARCHAR) AS pc, percentage_stock_on_market,
         Median_sales_price_last_12_months, Median_sales_price_last_6_months,
         Median_days_on_market_for_properties_sold_in_last_12_months, Average_hold_period
  FROM asof_days s JOIN market ON Month_end = least(s.as_of_date, DATE '2000-06-30') AND Property_Type = 'H'),
rate_at AS (
  SELECT s.as_of_date, FLRHOOVA FROM asof_days s JOIN rates ON Month = least(s.as_of_date, DATE '2000-06-30'))"""

LABEL = """
labelled AS (
  SELECT b.as_of_date, b.AccountNumber,
         CASE WHEN b.as_of_date + 90 > DATE '2001-08-02' THEN NULL
              WHEN n.ClosedDateTimeAEDT - b.as_of_date BETWEEN 0 AND 90 THEN 1 ELSE 0 END AS ChurnedIn90D
  FROM base b LEFT JOIN account_now n
    ON n.AccountNumber = b.AccountNumber AND n.GeneralAccountTypeDescription = 'Home Loan')"""


def trend(expr: str, alias_slope: str, alias_change: str) -> str:
    """Slope over six rows and relative change of three rows to the six before."""
    y = f"CAST({expr} AS DOUBLE)"
    out = []
    if alias_slope:
        out.append(f"covar_samp(t, {y}) OVER w6 / nullif(var_samp(t) OVER w6, 0) AS {alias_slope}")
    if alias_change:
        out.append(
            f"(avg({y}) OVER w3 - avg({y}) OVER wp) / nullif(avg({y}) OVER wp, 0) AS {alias_change}"
        )
    return ", ".join(out)


def windows(key: str, ts: str) -> str:
    base = f"PARTITION BY {key} ORDER BY {ts} ROWS BETWEEN"
    return (
        f"WINDOW w6 AS ({base} 5 PRECEDING AND CURRENT ROW), w3 AS ({base} 2 PRECEDING AND CURRENT ROW), "
        f"wp AS ({base} 8 PRECEDING AND 3 PRECEDING)"
    )


OFFSETS = """
offsets AS (
  SELECT x.AccountNumber AS LoanAccountNumber, x.EndOfDayDate, sum(a.BalanceAmount) AS OffsetBalance
  FROM offset_bridge x JOIN account a
    ON a.AccountNumber = x.OffsetAccountNumber AND a.EndOfDayDate = x.EndOfDayDate
  WHERE x.GeneralAccountTypeDescription = 'Home Loan'
    AND x.EndOfDayDate + 1 BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'
  GROUP BY 1, 2)"""

ACCOUNT_TREND = OFFSETS + """,
account_trend AS (
  SELECT AccountNumber, EndOfDayDate, OffsetBalance,
    """ + ", ".join([
    trend("BalanceAmount", "BalanceSlope", "BalanceRelChange"),
    trend("InAdvanceAmount", "AdvanceSlope", "AdvanceRelChange"),
    trend("ArrearsAmount", "ArrearsSlope", "ArrearsRelChange"),
    trend("InterestRate", "RatesSlope", "RateRelChange"),
    trend("ActualLoanValueRatio", "LVRSlope", "LvrRelChange"),
    trend("OffsetBalance", "OffsetBalanceSlope", "OffsetBalRelChange"),
]) + """
  FROM (SELECT a.*, coalesce(f.OffsetBalance, 0) AS OffsetBalance,
               CAST(date_diff('day', DATE '1970-01-01', a.EndOfDayDate) AS DOUBLE) * 86400 AS t
        FROM account a
        LEFT JOIN offsets f ON f.LoanAccountNumber = a.AccountNumber AND f.EndOfDayDate = a.EndOfDayDate
        WHERE a.EndOfDayDate BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'
          AND a.GeneralAccountTypeDescription = 'Home Loan' AND a.InterestRateTypeDescription = 'Variable'
          AND a.AccountNumber IN (
            SELECT AccountNumber FROM account WHERE EndOfDayDate = DATE '2000-12-31'
               AND GeneralAccountTypeDescription = 'Home Loan' AND InterestRateTypeDescription = 'Variable'
               AND (AccountStatusType = 'Open'
                    OR ClosedDateTimeAEDT BETWEEN DATE '1997-01-01' AND DATE '2000-12-30')))
  """ + windows("AccountNumber", "EndOfDayDate") + ")"

SCOPE = """
scope AS (
  SELECT a.AccountNumber AS HomeLoanAccountNumber, c1.ClientNumber AS AssociatedClientNumber,
         c2.AccountNumber AS RelatedTransactionAccount, c2.SimpleWeighting
  FROM account a
  JOIN bridge c1 ON c1.AccountNumber = a.AccountNumber AND c1.EndOfDayDate = a.EndOfDayDate
  JOIN bridge c2 ON c2.ClientNumber = c1.ClientNumber AND c2.EndOfDayDate = a.EndOfDayDate
  WHERE a.EndOfDayDate = DATE '2000-12-31' AND a.GeneralAccountTypeDescription = 'Home Loan'
    AND a.InterestRateTypeDescription = 'Variable'
    AND (a.AccountStatusType = 'Open' OR a.ClosedDateTimeAEDT BETWEEN DATE '1997-01-01' AND DATE '2000-12-31')
    AND c2.GeneralAccountTypeDescription IN
      ('Transaction', 'Savings', 'Term Share', 'Home Loan', 'Credit Card', 'Personal Loan'))"""

CLASSIFIED = """
classified AS (
  SELECT *, kind AS AccountType,
    CASE WHEN kind IN ('Transaction', 'Savings', 'Term Share')
         THEN CASE WHEN amt > 0 THEN 'Credit' WHEN amt < 0 THEN 'Debit' END
         WHEN kind IN ('Home Loan', 'Credit Card', 'Personal Loan')
         THEN CASE WHEN amt > 0 THEN 'Debit' WHEN amt < 0 THEN 'Credit' END END AS TransactionType,
    CASE WHEN kind = 'Transaction' AND amt < 0 AND bsb IS NOT NULL AND counterparty IS NOT NULL AND code <> '472'
         THEN CASE WHEN lower(descr) LIKE '%home%' OR lower(descr) LIKE '%mortgage%' THEN 'home loan payment'
                   WHEN lower(descr) LIKE '%loan%' THEN 'other loans'
                   WHEN TransactionAmount >= 2500 THEN 'large transaction (2.5K)' END END AS ExternalPaymenttype,
    CASE WHEN kind IN ('Home Loan', 'Credit Card', 'Personal Loan') AND amt > 0 AND bsb IS NOT NULL
          AND counterparty IS NOT NULL AND code <> '472' THEN 'PaymentFromExternalBank' END AS IncomingPaymentType
  FROM txns)"""

MONTHLY = SCOPE + "," + CLASSIFIED + """,
monthly AS (
  SELECT HomeLoanAccountNumber, last_day(TransactionDate) AS TransactionMonth, AccountType, TransactionType,
         ExternalPaymenttype, IncomingPaymentType, sum(abs(amt) * SimpleWeighting) AS Amount, count(*) AS NumRows
  FROM classified LEFT JOIN scope ON RelatedTransactionAccount = AccountNumber
  WHERE TransactionDate BETWEEN DATE '1997-01-01' AND DATE '2000-12-31' AND amt <> 0
  GROUP BY 1, 2, 3, 4, 5, 6)"""

_SAV = "AccountType IN ('Transaction', 'Savings', 'Term Share')"
_LEND = "AccountType IN ('Home Loan', 'Personal Loan', 'Credit Card')"

PIVOT = MONTHLY + f""",
pivot_ AS (
  SELECT HomeLoanAccountNumber, coalesce(TransactionMonth, DateValue) AS TransactionMonth,
    sum(Amount) FILTER (WHERE {_SAV} AND TransactionType = 'Credit') AS Savings_Credit,
    sum(1) FILTER (WHERE {_SAV} AND TransactionType = 'Credit') AS NumTrans_Savings_Credit,
    sum(Amount) FILTER (WHERE {_SAV} AND TransactionType = 'Debit') AS Savings_Debit,
    sum(1) FILTER (WHERE {_SAV} AND TransactionType = 'Debit') AS NumTrans_Savings_Debit,
    sum(Amount) FILTER (WHERE {_LEND} AND TransactionType = 'Credit') AS Lending_Credit,
    sum(Amount) FILTER (WHERE {_LEND} AND TransactionType = 'Debit') AS Lending_Debit,
    sum(1) FILTER (WHERE {_LEND} AND TransactionType = 'Debit') AS NumTrans_Lending_Debit,
    sum(Amount) FILTER (WHERE ExternalPaymenttype = 'home loan payment') AS ExternalHomeLoanPayments,
    sum(Amount) FILTER (WHERE ExternalPaymenttype = 'other loans') AS ExternalOtherLoanPayments,
    sum(Amount) FILTER (WHERE ExternalPaymenttype = 'large transaction (2.5K)') AS ExternalLargePayments,
    sum(1) FILTER (WHERE IncomingPaymentType = 'PaymentFromExternalBank') AS NumPaymentsFromExternalBanks
  FROM (SELECT DISTINCT last_day(CAST(DATE '1997-01-01' + CAST(i AS INTEGER) AS DATE)) AS DateValue
        FROM range(0, 1461) t(i))
  LEFT JOIN monthly ON DateValue = TransactionMonth
  GROUP BY 1, 2)"""

TXN_TREND = PIVOT + """,
txn_trend AS (
  SELECT HomeLoanAccountNumber, TransactionMonth,
    """ + ", ".join([
    trend("Savings_Credit", "Savings_Credit_Slope", "SavingsCreditRelChange"),
    trend("NumTrans_Savings_Credit", "NumTrans_Savings_Credit_Slope", "NumTransSavingsCreditRelChange"),
    trend("Savings_Debit", "Savings_Debit_Slope", "SavingsDebitRelChange"),
    trend("NumTrans_Savings_Debit", "NumTrans_Savings_Debit_Slope", "NumTrans_Savings_DebitRelChange"),
    trend("Lending_Credit", "Lending_Credit_Slope", "LendingCreditRelChange"),
    trend("Lending_Debit", "Lending_Debit_Slope", "LendingDebitRelChange"),
    trend("NumTrans_Lending_Debit", "NumTrans_Lending_Debit_Slope", "NumTrans_Lending_DebitRelChange"),
]) + """,
    count(CASE WHEN ExternalHomeLoanPayments > 0 THEN 1 END) OVER w6 >= 1 AS HasHomeLoanPayments,
    count(CASE WHEN ExternalOtherLoanPayments > 0 THEN 1 END) OVER w6 >= 1 AS HasOtherLoanPayments,
    count(CASE WHEN ExternalLargePayments > 0 THEN 1 END) OVER w6 >= 5 AS HasLargePayments,
    sum(CASE WHEN NumPaymentsFromExternalBanks > 1 THEN 1 ELSE 0 END) OVER w6 >= 5 AS LoanPaymentsFromExternalBanks
  FROM (SELECT *, CAST(date_diff('day', DATE '1970-01-01', TransactionMonth) AS DOUBLE) AS t FROM pivot_)
  """ + windows("HomeLoanAccountNumber", "TransactionMonth") + ")"
