"""Queries over the quality and drift operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.catalogue.bank import Bank
from ebbline.catalogue.registry import query
from ebbline.operators import drift, quality
from ebbline.plans import churn
from ebbline.session import shared_dir
from ebbline.sources import io

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Bank(spark, sf_dir).table("lineitem")


# --- quality --------------------------------------------------------------------------


def _gaps(df: DataFrame) -> DataFrame:
    """The table has no NULLs, so zero taxes and discounts, and one flag, become gaps."""
    return df.withColumns(
        {
            "l_tax": F.expr("nullif(l_tax, 0.0D)"),
            "l_discount": F.expr("nullif(l_discount, 0.0D)"),
            "l_linestatus": F.expr("nullif(l_linestatus, 'F')"),
        }
    )


_GAPS = """g AS (SELECT * REPLACE (nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount,
  nullif(l_linestatus, 'F') AS l_linestatus) FROM lineitem)"""
LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


def _missing_sql(col: str) -> str:
    pct = f"CAST(count(*) - count({col}) AS DOUBLE) / count(*)"
    return (
        f"SELECT '{col}' AS column_name, count(*) - count({col}) AS null_count, {pct} AS null_percentage, "
        f"{pct} <= 0.4 AS valid FROM g"
    )


@query(
    "dq_missing",
    "column_name string, null_count bigint, null_percentage double, valid boolean",
    ctes=_GAPS,
    sql=" UNION ALL ".join(_missing_sql(c) for c in LINE_COLUMNS),
)
def q_dq_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.check_missing_values(_gaps(lines(spark, sf_dir)), 0.4)
    return report.withColumnRenamed("column", "column_name")


@query(
    "dq_duplicates",
    "total_rows bigint, unique_rows bigint, duplicate_count bigint, duplicate_percentage double, valid boolean",
    sql="""
SELECT t AS total_rows, u AS unique_rows, t - u AS duplicate_count,
       CAST(t - u AS DOUBLE) / t AS duplicate_percentage, t = u AS valid
FROM (SELECT (SELECT count(*) FROM lineitem) AS t,
             (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS u)""",
)
def q_dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_duplicates(lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


def _describe_sql(col: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, count({col}) AS n, avg({col}) AS mean, stddev_samp({col}) AS stddev, "
        f"min({col}) AS lo, max({col}) AS hi, {'max(l_quantity) <= 40' if col == 'l_quantity' else 'true'} AS valid "
        "FROM lineitem"
    )


@query(
    "dq_describe",
    "column_name string, n bigint, mean double, stddev double, lo double, hi double, valid boolean",
    sql=" UNION ALL ".join(_describe_sql(c) for c in MEASURES),
)
def q_dq_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.check_value_ranges(lines(spark, sf_dir), MEASURES, bounds={"l_quantity": (None, 40)})
    return report.withColumnsRenamed({"column": "column_name", "count": "n", "min": "lo", "max": "hi"})


_ALL_SQL = """
SELECT 'null_check' AS check_name, c AS column_name, 'null_count' AS metric, n AS value, p <= 0.5 AS valid FROM nulls
UNION ALL SELECT 'null_check', c, 'null_percentage', p, p <= 0.5 FROM nulls
UNION ALL SELECT 'duplicate_check', 'l_orderkey,l_linenumber', k, v, t = u FROM dup,
  (SELECT unnest(['total_rows', 'unique_rows', 'duplicate_count', 'duplicate_percentage']) AS k,
          unnest([t, u, t - u, (t - u) / t]) AS v FROM dup)
UNION ALL SELECT 'range_check', 'l_tax', k, v, true FROM
  (SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS k,
          unnest([CAST(count(l_tax) AS DOUBLE), avg(l_tax), stddev_samp(l_tax), min(l_tax), max(l_tax)]) AS v FROM g)
UNION ALL SELECT 'table_check', '', 'total_rows', count(*), true FROM g
UNION ALL SELECT 'table_check', '', 'total_columns', 11, true
UNION ALL SELECT 'overall', '', 'valid', NULL,
  (SELECT bool_and(p <= 0.5) FROM nulls) AND (SELECT t = u FROM dup)
"""


@query(
    "dq_all",
    "check_name string, column_name string, metric string, value double, valid boolean",
    ctes=_GAPS
    + """,
nulls AS (
"""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, CAST(count(*) - count({c}) AS DOUBLE) AS n, "
        f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS p FROM g"
        for c in LINE_COLUMNS
    )
    + """),
dup AS (SELECT (SELECT CAST(count(*) AS DOUBLE) FROM g) AS t,
               (SELECT CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM g)) AS u)""",
    sql=_ALL_SQL,
)
def q_dq_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _gaps(lines(spark, sf_dir))
    report = quality.run_all_checks(df, ["l_orderkey", "l_linenumber"], ["l_tax"])
    return report.withColumnsRenamed({"check": "check_name", "column": "column_name"})


_TYPES = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END"
_COUNTS = " UNION ALL ".join(f"SELECT '{c}' AS c, count({c}) AS n FROM g" for c in LINE_COLUMNS)


@query(
    "dq_schema",
    "column_name string, expected string, actual string, change string, valid boolean, non_null bigint",
    ctes=_GAPS
    + f""",
actual AS (SELECT column_name AS c, {_TYPES} AS t FROM (DESCRIBE lineitem)),
wanted AS (SELECT c, CASE c WHEN 'l_orderkey' THEN 'int' WHEN 'l_linenumber' THEN 'bigint' WHEN 'l_shipdate' THEN 'date'
                     WHEN 'l_quantity' THEN 'decimal(15,2)' ELSE t END AS t FROM actual WHERE c <> 'l_tax'
           UNION ALL SELECT 'l_shipmode', 'string'),
told AS (SELECT coalesce(w.c, a.c) AS c, w.t AS e, a.t AS a,
                CASE WHEN w.c IS NULL THEN 'added' WHEN a.c IS NULL THEN 'missing' WHEN w.t = a.t THEN 'same'
                     WHEN w.c IN ('l_orderkey', 'l_shipdate') THEN 'widened' ELSE 'changed' END AS change
         FROM wanted w FULL JOIN actual a ON w.c = a.c),
filled AS ({_COUNTS})""",
    sql="""SELECT told.c AS column_name, e AS expected, a AS actual, change, change NOT IN ('changed', 'missing') AS valid,
                  n AS non_null FROM told LEFT JOIN filled ON filled.c = told.c""",
)
def q_dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines against a stored contract of an earlier delivery."""
    df = _gaps(lines(spark, sf_dir))
    older = {"l_orderkey": T.IntegerType(), "l_linenumber": T.LongType(), "l_shipdate": T.DateType(), "l_quantity": T.DecimalType(15, 2)}
    fields = [T.StructField(f.name, older.get(f.name, f.dataType)) for f in df.schema if f.name != "l_tax"]
    earlier = spark.createDataFrame([], T.StructType([*fields, T.StructField("l_shipmode", T.StringType())]))
    stored = fresh_path(spark, "contract")
    io.overwrite(quality.schema_contract(earlier), stored)
    report = quality.check_schema(df, io.read_table(spark, stored)).withColumnRenamed("column", "column_name")
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    counts = filled.select(
        F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in filled.columns]), F.array(*filled.columns))).alias(
            "column_name", "non_null"
        )
    )
    return report.join(counts, "column_name", "left")


@query(
    "dq_volume",
    "rows bigint, baseline_rows bigint, drop_percentage double, valid boolean",
    sql="""SELECT n AS rows, b AS baseline_rows, 1 - CAST(n AS DOUBLE) / b AS drop_percentage,
                  1 - CAST(n AS DOUBLE) / b <= 0.2 AS valid
           FROM (SELECT count(*) FILTER (WHERE l_returnflag <> 'R') AS n, count(*) AS b FROM lineitem)""",
)
def q_dq_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = lines(spark, sf_dir)
    return quality.check_volume(df.filter("l_returnflag <> 'R'"), df.count())


# --- drift ----------------------------------------------------------------------------

CUT = dt.datetime(1998, 7, 1)


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before and after the cut.  The week of shipping drifts by design."""
    week = F.floor(F.datediff(F.col("l_shipdate").cast("date"), F.lit(dt.date(1995, 1, 1))) / 7)
    df = lines(spark, sf_dir).withColumn("ship_week", week.cast("int"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    return df.filter(F.col("l_shipdate") < cut), df.filter(F.col("l_shipdate") >= cut)


# All numeric columns; line numbers also serve as categories below.
FEATURES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES, "ship_week"]

_SIDES = """li AS (SELECT *, CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7.0) AS INTEGER) AS ship_week,
              CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 1 ELSE 0 END AS b FROM lineitem),
long AS (
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, b FROM li" for c in FEATURES) + ")"


@query(
    "baseline_stats",
    "feature string, mean double, std double",
    ctes=_SIDES,
    sql="SELECT feature, avg(v) AS mean, stddev_samp(v) AS std FROM long WHERE b = 1 GROUP BY 1",
)
def q_baseline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.baseline_stats(sides(spark, sf_dir)[0], FEATURES)


_Z = """
SELECT feature, abs(avg(v) FILTER (WHERE b = 0) - avg(v) FILTER (WHERE b = 1))
         / stddev_samp(v) FILTER (WHERE b = 1) AS z_score,
       abs(avg(v) FILTER (WHERE b = 0) - avg(v) FILTER (WHERE b = 1))
         / stddev_samp(v) FILTER (WHERE b = 1) > 1.5 AS drifted, 'dev' AS environment
FROM long GROUP BY 1"""


@query(
    "zscore_drift",
    "feature string, z_score double, drifted boolean, environment string",
    ctes=_SIDES,
    sql=_Z,
)
def q_zscore_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, cur = sides(spark, sf_dir)
    stats = drift.baseline_stats(base, FEATURES)
    return drift.zscore_drift(stats, cur.select(*FEATURES), environment="dev", threshold=1.5)


_KS = """cnt AS (SELECT feature, v, count(*) FILTER (WHERE b = 1) AS nb, count(*) FILTER (WHERE b = 0) AS nc
                FROM long GROUP BY 1, 2),
cum AS (SELECT *, sum(nb) OVER w AS cb, sum(nc) OVER w AS cc,
               sum(nb) OVER (PARTITION BY feature) AS tb, sum(nc) OVER (PARTITION BY feature) AS tc
        FROM cnt WINDOW w AS (PARTITION BY feature ORDER BY v)),
ks AS (SELECT feature, max(tb) AS n_base, max(tc) AS n_cur,
              max(abs(CAST(cb AS DOUBLE) / tb - CAST(cc AS DOUBLE) / tc)) AS ks_statistic FROM cum GROUP BY 1),
ksp AS (SELECT *, ks_statistic * sqrt(CAST(n_base AS DOUBLE) * n_cur / (n_base + n_cur)) AS x FROM ks),
kst AS (SELECT feature, n_base, n_cur, ks_statistic,
               CASE WHEN x < 0.2 THEN 1 ELSE least(greatest(2 * s, 0), 1) END AS ks_p
        FROM (SELECT k.*, (SELECT sum(CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * i * i * x * x))
                           FROM range(1, 101) r(i)) AS s FROM ksp k))"""


@query(
    "ks_drift",
    "feature string, n_base bigint, n_cur bigint, ks_statistic double, ks_p double, ks_drift boolean",
    ctes=_SIDES + "," + _KS,
    sql="SELECT *, ks_p < 0.05 AS ks_drift FROM kst",
)
def q_ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.ks_drift(*sides(spark, sf_dir), FEATURES)


CATEGORIES = ["l_returnflag", "l_linestatus", "l_shipdate", "l_linenumber"]

_CHI = """cat AS (
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, b FROM li" for c in CATEGORIES) + """),
cc2 AS (SELECT feature, v, count(*) FILTER (WHERE b = 1) AS nb, count(*) FILTER (WHERE b = 0) AS nc
        FROM cat GROUP BY 1, 2),
ct AS (SELECT *, CAST(sum(nb) OVER f AS DOUBLE) AS tb, CAST(sum(nc) OVER f AS DOUBLE) AS tc,
              count(*) OVER f - 1 AS dof FROM cc2 WINDOW f AS (PARTITION BY feature)),
ce AS (SELECT *, (nb + nc) * tb / (tb + tc) AS eb, (nb + nc) * tc / (tb + tc) AS ec,
              CASE WHEN dof = 1 THEN 0.5 ELSE 0 END AS y FROM ct),
chi AS (SELECT feature, dof,
               sum(pow(abs(nb - eb) - least(abs(nb - eb), y), 2) / eb
                   + pow(abs(nc - ec) - least(abs(nc - ec), y), 2) / ec) AS chi2
        FROM ce GROUP BY 1, 2)"""

# The tail by the series of the lower incomplete gamma function; far above the mean it is 0.
_CHI += """,
chit AS (SELECT feature, dof, chi2, CASE WHEN chi2 / 2 > dof / 2.0 + 40 + 12 * sqrt(dof / 2.0) THEN 0.0
           ELSE 1 - (SELECT sum(exp((dof / 2.0 + n) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0 + n + 1)))
                     FROM range(0, 2000) t(n)) END AS chi2_p FROM chi)"""


@query(
    "chi2_drift",
    "feature string, chi2 double, dof bigint, chi2_p double, chi2_drift boolean",
    ctes=_SIDES + "," + _CHI,
    sql="SELECT *, chi2_p < 0.05 AS chi2_drift FROM chit",
)
def q_chi2_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.chi_square_drift(*sides(spark, sf_dir), CATEGORIES)


_PSI = """edge AS (SELECT feature, quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q
                 FROM long WHERE b = 1 GROUP BY 1),
bins AS (SELECT l.feature, b, v, q,
                CASE WHEN v = q[11] + 0.1 THEN 9
                     WHEN v >= q[1] - 0.1 AND v < q[11] + 0.1
                     THEN (SELECT count(*) FROM range(2, 11) r(i) WHERE q[i] <= v) END AS bin
         FROM long l JOIN edge e ON e.feature = l.feature),
hist AS (SELECT feature, bin, count(*) FILTER (WHERE b = 1) AS nb, count(*) FILTER (WHERE b = 0) AS nc
         FROM bins GROUP BY 1, 2),
share AS (SELECT feature, bin, CAST(nb AS DOUBLE) / sum(nb) OVER (PARTITION BY feature) AS e,
                 CAST(nc AS DOUBLE) / sum(nc) OVER (PARTITION BY feature) AS a FROM hist),
psi AS (SELECT feature, sum((a - e) * ln((a + 0.0001) / (e + 0.0001))) FILTER (WHERE bin IS NOT NULL) AS psi
        FROM share GROUP BY 1)"""


@query(
    "psi",
    "feature string, psi double, high boolean",
    ctes=_SIDES + "," + _PSI,
    sql="SELECT feature, psi, psi > 0.25 AS high FROM psi",
)
def q_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.population_stability_index(*sides(spark, sf_dir), FEATURES)


@query(
    "jsd_hist",
    "feature string, jsd double",
    ctes=_SIDES
    + """, h AS (SELECT feature, v, count(*) FILTER (WHERE b = 1) AS nb, count(*) FILTER (WHERE b = 0) AS nc
              FROM long GROUP BY 1, 2),
n AS (SELECT feature, CAST(nb AS DOUBLE) / sum(nb) OVER (PARTITION BY feature) AS p,
             CAST(nc AS DOUBLE) / sum(nc) OVER (PARTITION BY feature) AS q FROM h)""",
    sql="""SELECT feature, sqrt(0.5 * (sum(p * ln(p / (0.5 * (p + q)) + 1e-10))
                                  + sum(q * ln(q / (0.5 * (p + q)) + 1e-10)))) AS jsd FROM n GROUP BY 1""",
)
def q_jsd(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = drift.value_counts(*sides(spark, sf_dir), FEATURES)
    return drift.jsd_distance(counts, ["feature"], "n_base", "n_cur")


@query(
    "drift_report",
    "feature string, type string, statistic double, p_value double, psi double, drift_detected boolean, overall_drift boolean",
    ctes=_SIDES + "," + _KS + "," + _CHI + "," + _PSI,
    sql="""
SELECT *, bool_or(drift_detected) OVER () AS overall_drift FROM (
  SELECT k.feature, 'numerical' AS type, ks_statistic AS statistic, ks_p AS p_value, p.psi,
         ks_p < 0.05 OR p.psi > 0.25 AS drift_detected
  FROM kst k JOIN psi p ON p.feature = k.feature
  UNION ALL
  SELECT feature, 'categorical', chi2, chi2_p, NULL, chi2_p < 0.05 FROM chit WHERE feature <> 'l_linenumber')""",
)
def q_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the lines, and the week of shipping."""
    return drift.detect_drift(*sides(spark, sf_dir))


@query(
    "metric_append",
    "feature string, z_score double, drifted boolean, environment string",
    ctes=_SIDES,
    sql=f"SELECT * FROM ({_Z}) UNION ALL SELECT * FROM ({_Z})",
)
def q_metric_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monitoring runs append to one table."""
    rows = q_zscore_drift(spark, sf_dir)
    target = fresh_path(spark, "drift_metrics")
    io.append(rows, target)
    io.append(rows, target)
    return io.read_table(spark, target)


@query(
    "drift_job",
    "run_id string, feature string, z_score double, drifted boolean, environment string",
    ctes=_SIDES,
    sql=f"SELECT r AS run_id, z.* FROM ({_Z}) z, (VALUES ('r1'), ('r2')) t(r)",
)
def q_drift_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored baseline and two runs, the first of which is repeated and replaces itself."""
    base, cur = sides(spark, sf_dir)
    stats, target = fresh_path(spark, "baseline"), fresh_path(spark, "drift_runs")
    churn.baseline_job(base.select(*FEATURES), stats)
    for run in ("r1", "r2", "r1"):
        churn.drift_job(spark, stats, cur.select(*FEATURES), target, environment="dev", run_id=run, threshold=1.5)
    return io.read_batches(spark, target, "run_id")


def fresh_path(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


