"""Distribution drift between a baseline and a current table (DR1-DR8).

All features go through one job, so the number of jobs does not grow with the number of
columns.  Exact order statistics are selected by refining a histogram, in three scans:

1. range and number of values of every column, in one aggregation without a shuffle;
2. counts of both sides in ``COARSE`` bins per column;
3. counts of equal values, but only in bins that can hold a percentile, a bin edge or the
   largest gap of the two distribution functions.  The gap inside a bin is bounded by the
   functions at its ends, so a bin whose bound is not above the largest gap at an end is out.

What is left is summed in order without one task per feature.  Results are exact for any
data; where very many bins can hold the largest gap, more of the table is left.

NULL and NaN values are left out on both sides.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.functions.scalars import no_nan, ratio
from ebbline.operators.ordered import prefix_sums
from ebbline.session import freeze

COARSE = 4096
PSI_BINS = 10
PSI_EDGE_MARGIN = 0.1
PSI_SMOOTHING = 0.0001
PSI_HIGH = 0.25
JSD_SMOOTHING = 1e-10


def split_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, other) column names.  Every numeric type counts as numeric."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in df.schema if f.name not in numeric]


def _long(df: DataFrame, cols: Sequence[str], dtype: str) -> DataFrame:
    def value(c: str) -> Column:
        v = F.col(f"`{c}`").try_cast(dtype)
        return no_nan(v) if dtype == "double" else v

    entries = [F.struct(F.lit(c).alias("feature"), value(c).alias("value")) for c in cols]
    return (
        df.select(F.explode(F.array(*entries)).alias("_e"))
        .select("_e.*")
        .filter(F.col("value").isNotNull())
    )


def value_counts(baseline: DataFrame, current: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """feature, value, n_base, n_cur (AG17).  Equal values meet before the shuffle, so a
    value that fills a third of the table is one row per task."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    base = _long(baseline, cols, dtype).select("*", one.alias("b"), none.alias("c"))
    cur = _long(current, cols, dtype).select("*", none.alias("b"), one.alias("c"))
    return (
        base.unionByName(cur)
        .groupBy("feature", "value")
        .agg(F.sum("b").alias("n_base"), F.sum("c").alias("n_cur"))
    )


def baseline_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """feature, mean, std with the sample standard deviation (DR1)."""
    return (
        _long(df, cols, "double")
        .groupBy("feature")
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    )


def zscore_drift(
    stats: DataFrame, current: DataFrame, *, environment: str, threshold: float = 3.0
) -> DataFrame:
    """feature, z_score, drifted, environment against stored statistics (DR2, DR8).

    A zero deviation gives no score and no drift.
    """
    cols = split_columns(current)[0]
    now = _long(current, cols, "double").groupBy("feature").agg(F.avg("value").alias("_now"))
    z = ratio(F.abs(F.col("_now") - F.col("mean")), F.col("std"))
    return (
        stats.join(now, "feature", "left")
        .withColumn("z_score", z)
        .select(
            "feature",
            "z_score",
            F.coalesce(F.col("z_score") > threshold, F.lit(False)).alias("drifted"),
            F.lit(environment).alias("environment"),
        )
    )


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value: 2 * sum over k of (-1)^(k-1) * exp(-2 k^2 x^2)."""
    x = d * F.sqrt(n.cast("double") * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    total = 2.0 * F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def percentile_edges(cum: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """feature, edges: exact baseline percentiles with linear interpolation (AG16), the
    outer two moved out by 0.1."""
    # Percentile i sits at position h = (n - 1) * i / bins of the sorted baseline; a value
    # covers the positions [cum - n, cum - 1].
    last = F.col("cum_n_base") - 1
    first = F.col("cum_n_base") - F.col("n_base")
    top = F.col("total_base") - 1

    def low(i: Column) -> Column:
        return F.floor(top * i / bins)

    def high(i: Column) -> Column:
        return F.ceil(top * i / bins)

    def covers(pos: Column) -> Column:
        return pos.between(first, last)

    i = F.col("_i")
    # A plain comparison first: some i * top / bins lies within one position of the value's
    # range.  It leaves a few rows per feature for the array work.
    near = F.floor((last + 1) * bins / top) >= F.ceil((first - 1) * bins / top)
    hits = (
        cum.filter(F.col("n_base") > 0)
        .filter(F.when(top > 0, near).otherwise(True))
        .select(
            "feature",
            "value",
            "total_base",
            first.alias("_first"),
            last.alias("_last"),
            F.explode(
                F.filter(
                    F.sequence(F.lit(0), F.lit(bins)), lambda k: covers(low(k)) | covers(high(k))
                )
            ).alias("_i"),
        )
        .groupBy("feature", "_i")
        .agg(
            F.max(F.when(low(i).between(F.col("_first"), F.col("_last")), F.col("value"))).alias("_lo"),
            F.max(F.when(high(i).between(F.col("_first"), F.col("_last")), F.col("value"))).alias("_hi"),
            F.max(top * i / bins - low(i)).alias("_frac"),
        )
    )
    edge = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")
    moved = F.when(i == 0, edge - PSI_EDGE_MARGIN).when(i == bins, edge + PSI_EDGE_MARGIN).otherwise(edge)
    return hits.groupBy("feature").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(i.alias("i"), moved.alias("e")))), lambda s: s["e"]
        ).alias("edges")
    )


def _finite(v: Column) -> Column:
    return F.when(F.abs(v) < float("inf"), v)


def _coarse(v: Column, lo: Column, hi: Column) -> Column:
    """Number of the bin of a value; it never falls as the value rises.

    Bins are of equal width over the finite values.  Halves keep the width finite.
    """
    width = hi / 2 - lo / 2
    at = (v / 2 - lo / 2) / width * COARSE
    last = float(COARSE - 1)
    inside = F.when(width > 0, F.floor(F.least(F.greatest(at, F.lit(0.0)), F.lit(last))).cast("int")).otherwise(F.lit(0))
    return F.when(v == float("-inf"), F.lit(0)).when(v == float("inf"), F.lit(COARSE - 1)).otherwise(inside)


def _columns(baseline: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Both sides as doubles, named by the place of the column."""

    def side(df: DataFrame, now: bool) -> DataFrame:
        values = [no_nan(F.col(f"`{c}`").try_cast("double")).alias(f"v{j}") for j, c in enumerate(cols)]
        return df.select(F.lit(now).alias("now"), *values)

    return side(baseline, False).unionByName(side(current, True))


def _placed(rows: DataFrame, ranges: DataFrame, n: int) -> DataFrame:
    """now, feature (a number), bin, value: one row per value.  ``ranges`` is one row."""
    # The bin is taken after the rows are made: one short expression, whatever the columns.
    entries = [F.struct(F.lit(j).alias("feature"), *[F.col(f"{k}{j}").alias(k) for k in ("lo", "hi")], F.col(f"v{j}").alias("value")) for j in range(n)]
    return (
        rows.join(F.broadcast(ranges))
        .select("now", F.explode(F.array(*entries)).alias("e"))
        .select("now", "e.*")
        .filter(F.col("value").isNotNull())
        .select("now", "feature", _coarse(F.col("value"), F.col("lo"), F.col("hi")).alias("bin"), "value")
    )


def _both_sides() -> list[Column]:
    return [F.count_if(~F.col("now")).alias("n_base"), F.count_if("now").alias("n_cur")]


def _histogram(rows: DataFrame, n: int, bins: int) -> DataFrame:
    """The coarse bins that hold values: their counts, the counts up to them, what is known
    of the feature, and whether the bin is to be refined."""
    base, value = ~F.col("now"), lambda j: F.col(f"v{j}")
    ranges = rows.agg(
        *[f(_finite(value(j))).alias(f"{name}{j}") for j in range(n) for name, f in (("lo", F.min), ("hi", F.max))],
        *[f(F.when(base, value(j))).alias(f"{name}{j}") for j in range(n) for name, f in (("first", F.min), ("last", F.max))],
        *[F.count(F.when(base, value(j))).alias(f"base{j}") for j in range(n)],
        *[F.count(F.when(F.col("now"), value(j))).alias(f"cur{j}") for j in range(n)],
    )
    names = {"lo": "lo", "hi": "hi", "first": "first", "last": "last", "base": "total_base", "cur": "total_cur"}
    about = ranges.select(
        F.inline(F.array(*[F.struct(F.lit(j).alias("feature"), *[F.col(f"{k}{j}").alias(v) for k, v in names.items()]) for j in range(n)]))
    )
    by_bin = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    tb, tc = F.col("total_base"), F.col("total_cur")

    def share(count: Column, total: Column) -> Column:
        return F.when(total > 0, count / total.cast("double"))

    # At most COARSE rows per feature from here on.
    hist = (
        _placed(rows, ranges, n)
        .groupBy("feature", "bin")
        .agg(*_both_sides())
        .join(F.broadcast(about), "feature")
        .withColumns({"cum_base": F.sum("n_base").over(by_bin), "cum_cur": F.sum("n_cur").over(by_bin)})
        .withColumns({"before_base": F.col("cum_base") - F.col("n_base"), "before_cur": F.col("cum_cur") - F.col("n_cur")})
        .withColumn("gap", F.abs(share(F.col("cum_base"), tb) - share(F.col("cum_cur"), tc)))
        .withColumn("gap", F.max("gap").over(Window.partitionBy("feature")))
    )
    up = share(F.col("cum_base"), tb) - share(F.col("before_cur"), tc)
    down = share(F.col("cum_cur"), tc) - share(F.col("before_base"), tb)
    may_gap = (F.col("n_base") > 0) & (F.col("n_cur") > 0) & (F.greatest(up, down) > F.col("gap"))
    top = tb - 1
    holds_rank = F.exists(
        F.sequence(F.lit(0), F.lit(bins)),
        lambda k: (F.col("cum_base") > F.floor(top * k / bins)) & (F.col("before_base") <= F.ceil(top * k / bins)),
    )
    outer = [_coarse(e, F.col("lo"), F.col("hi")) for e in (F.col("first") - PSI_EDGE_MARGIN, F.col("last") + PSI_EDGE_MARGIN)]
    holds_edge = (F.col("bin") == outer[0]) | (F.col("bin") == outer[1])
    return hist.withColumn("refine", F.coalesce((tb > 0) & (holds_rank | holds_edge), F.lit(False)) | F.coalesce(may_gap, F.lit(False)))


def numeric_profile(baseline: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """feature, n_base, n_cur, ks_statistic, psi for every column that has a value.

    The statistic is NULL and the index 0 where a side has no values.
    """
    n = len(cols)
    rows = _columns(baseline, current, cols)
    hist = freeze(_histogram(rows, n, bins))
    # One row again: the range of every column.
    ranges = hist.agg(*[F.max(F.when(F.col("feature") == j, F.col(k))).alias(f"{k}{j}") for j in range(n) for k in ("lo", "hi")])
    cells = hist.filter("refine").select("feature", "bin", "before_base", "before_cur", "total_base", "total_cur")
    exact = (
        _placed(rows, ranges, n)
        .join(F.broadcast(cells.select("feature", "bin")), ["feature", "bin"])
        .groupBy("feature", "bin", "value")
        .agg(*_both_sides())
    )
    inner = prefix_sums(exact, ["feature", "bin"], ["value"], ["n_base", "n_cur"])
    cum = inner.join(F.broadcast(cells), ["feature", "bin"]).withColumns(
        {"cum_n_base": F.col("cum_n_base") + F.col("before_base"), "cum_n_cur": F.col("cum_n_cur") + F.col("before_cur")}
    )
    both = (F.col("total_base") > 0) & (F.col("total_cur") > 0)
    gap = F.abs(F.col("cum_n_base") / F.col("total_base").cast("double") - F.col("cum_n_cur") / F.col("total_cur").cast("double"))
    gaps = cum.groupBy("feature").agg(F.max(F.when(both, gap)).alias("_inner"))

    # Counts below every edge: whole bins before the edge's, and values of its bin.
    edges = percentile_edges(cum, bins).join(hist.select("feature", "lo", "hi").distinct(), "feature")
    edges = edges.select("feature", "edges", F.transform("edges", lambda e: _coarse(e, F.col("lo"), F.col("hi"))).alias("at"))
    sides = ("n_base", "n_cur")

    def below(frame: DataFrame, inside) -> DataFrame:
        return frame.join(F.broadcast(edges), "feature").groupBy("feature").agg(
            *[F.sum(F.when(inside(F.get("at", F.lit(k)), F.get("edges", F.lit(k)), k == bins), F.col(c)).otherwise(0)).alias(f"{c}_{k}") for c in sides for k in range(bins + 1)]
        )

    value, place = F.col("value"), F.col("bin")
    coarse = below(hist, lambda at, e, last: place < at)
    fine = below(inner, lambda at, e, last: (place == at) & ((value <= e) if last else (value < e)))
    summed = coarse.unionByName(fine).groupBy("feature").agg(*[F.sum(c).alias(c) for c in coarse.columns if c != "feature"])
    totals = hist.groupBy("feature").agg(F.max("total_base").alias("n_base"), F.max("total_cur").alias("n_cur"), F.max("gap").alias("gap"))
    names = F.array(*[F.lit(c) for c in cols])

    def term(k: int) -> Column:
        e = (F.col(f"n_base_{k + 1}") - F.col(f"n_base_{k}")) / F.col("n_base").cast("double")
        a = (F.col(f"n_cur_{k + 1}") - F.col(f"n_cur_{k}")) / F.col("n_cur").cast("double")
        return (a - e) * F.ln((a + PSI_SMOOTHING) / (e + PSI_SMOOTHING))

    psi = F.lit(0.0)
    for k in range(bins):
        psi = psi + term(k)
    known = (F.col("n_base") > 0) & (F.col("n_cur") > 0)
    # One row per feature.
    return (
        totals.join(F.broadcast(gaps), "feature", "left")
        .join(F.broadcast(summed), "feature", "left")
        .select(
            F.get(names, F.col("feature")).alias("feature"),
            "n_base",
            "n_cur",
            F.greatest("gap", "_inner").alias("ks_statistic"),
            F.coalesce(F.when(known, psi), F.lit(0.0)).alias("psi"),
        )
    )


def with_ks(profile: DataFrame, p_threshold: float = 0.05) -> DataFrame:
    """A profile with ks_p and ks_drift; fewer than two values on a side give no drift."""
    enough = (F.col("n_base") >= 2) & (F.col("n_cur") >= 2)
    p = F.when(enough, kolmogorov_p(F.col("ks_statistic"), F.col("n_base"), F.col("n_cur")))
    return profile.withColumn("ks_p", p).withColumn("ks_drift", F.coalesce(F.col("ks_p") < p_threshold, F.lit(False)))


def ks_drift(
    baseline: DataFrame, current: DataFrame, cols: Sequence[str], p_threshold: float = 0.05
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov per feature (DR3): feature, n_base, n_cur,
    ks_statistic, ks_p, ks_drift."""
    return with_ks(numeric_profile(baseline, current, cols), p_threshold).drop("psi")


def population_stability_index(
    baseline: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = PSI_BINS
) -> DataFrame:
    """feature, psi, high over baseline percentile bins (DR6).

    Current values outside the bins stay in the denominator.  A side without values gives 0.
    """
    return numeric_profile(baseline, current, cols, bins).select("feature", "psi", (F.col("psi") > PSI_HIGH).alias("high"))


def jsd_distance(hist: DataFrame, keys: Sequence[str], p: str, q: str) -> DataFrame:
    """Jensen-Shannon distance between two columns of bin weights, per key (DR5).

    Natural logarithm, so the range ends at sqrt(ln 2).  Bins empty on both sides add
    nothing.
    """
    keys = list(keys)
    # Totals per key by a window over bins would hold a key in one task; an aggregate and a
    # join do not.
    totals = hist.groupBy(*keys).agg(F.sum(p).alias("_tp"), F.sum(q).alias("_tq"))
    if keys:
        joined = hist.join(totals, keys)
    else:
        both = totals.first()
        joined = hist.withColumns({"_tp": F.lit(both["_tp"]), "_tq": F.lit(both["_tq"])})
    pp = F.col(p) / F.col("_tp").cast("double")
    qq = F.col(q) / F.col("_tq").cast("double")
    m = 0.5 * (pp + qq)

    def kl(x: Column) -> Column:
        return F.sum(F.when(m > 0, x * F.ln(x / m + JSD_SMOOTHING)))

    half = 0.5 * (kl(pp) + kl(qq))
    return joined.groupBy(*keys).agg(F.sqrt(F.greatest(half, F.lit(0.0))).alias("jsd"))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of a positive number, by Stirling's series at x + 8."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.ln(x + i)
    return (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + series - shift


def chi2_tail(stat: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: the regularised incomplete gamma function,
    by its series below the mean and its continued fraction above.

    The number of steps follows the root of the degrees of freedom, as both need."""
    a, z = dof.cast("double") / 2, stat / 2
    steps = F.sequence(F.lit(1), (F.lit(60) + 10 * F.sqrt(a)).cast("int"))
    front = F.exp(-z + a * F.ln(z) - log_gamma(a))

    def add(s: Column, n: Column) -> Column:
        term = s["term"] * z / (a + n)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    lower = F.aggregate(steps, F.struct((1 / a).alias("term"), (1 / a).alias("total")), add, lambda s: s["total"])

    def fraction(s: Column, n: Column) -> Column:
        an, b = -n * (n - a), s["b"] + 2
        d = 1 / F.nullif(an * s["d"] + b, F.lit(0.0))
        c = b + an / s["c"]
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    b = z + 1 - a
    first = F.struct(b.alias("b"), F.lit(1e300).alias("c"), (1 / b).alias("d"), (1 / b).alias("h"))
    upper = F.aggregate(steps, first, fraction, lambda s: s["h"])
    return (
        F.when((dof <= 0) | (stat <= 0), F.lit(1.0))
        .when(z < a + 1, F.greatest(F.lit(0.0), 1 - lower * front))
        .when(z >= a + 1, F.when(front > 0, front * upper).otherwise(F.lit(0.0)))
    )


def chi_square_drift(
    baseline: DataFrame, current: DataFrame, cols: Sequence[str], p_threshold: float = 0.05
) -> DataFrame:
    """Chi-square test of the 2 x K category table per feature (DR4).

    feature, chi2, dof, chi2_p, chi2_drift.  With one degree of freedom each difference is
    reduced by at most one half.  A side without values gives no statistic and no drift.
    """
    counts = value_counts(baseline, current, cols, "string")
    totals = counts.groupBy("feature").agg(
        F.sum("n_base").alias("_tb"), F.sum("n_cur").alias("_tc"), (F.count(F.lit(1)) - 1).alias("dof")
    )
    tb, tc = F.col("_tb").cast("double"), F.col("_tc").cast("double")
    row = (F.col("n_base") + F.col("n_cur")).cast("double")

    def cell(observed: str, side: Column) -> Column:
        expected = row * side / (tb + tc)
        gap = F.abs(F.col(observed) - expected)
        gap = F.when(F.col("dof") == 1, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
        return gap * gap / expected

    usable = (F.col("_tb") > 0) & (F.col("_tc") > 0)
    # One row per feature.
    return (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature", "dof")
        .agg(F.sum(F.when(usable, cell("n_base", tb) + cell("n_cur", tc))).alias("chi2"))
        .withColumn("chi2_p", chi2_tail(F.col("chi2"), F.col("dof")))
        .select(
            "feature",
            "chi2",
            "dof",
            "chi2_p",
            F.coalesce(F.col("chi2_p") < p_threshold, F.lit(False)).alias("chi2_drift"),
        )
    )


def detect_drift(baseline: DataFrame, current: DataFrame, p_threshold: float = 0.05) -> DataFrame:
    """Drift verdict per shared column, and overall (DR7).

    feature, type, statistic, p_value, psi, drift_detected, overall_drift.  Numeric columns
    drift by Kolmogorov-Smirnov or a high PSI, the others by chi-square.  A column without
    any value on both sides has no row.
    """
    shared = baseline.select(*[c for c in baseline.columns if c in set(current.columns)])
    numeric, other = split_columns(shared)
    parts = []
    if numeric:
        parts.append(
            with_ks(numeric_profile(baseline, current, numeric), p_threshold).select(
                "feature",
                F.lit("numerical").alias("type"),
                F.col("ks_statistic").alias("statistic"),
                F.col("ks_p").alias("p_value"),
                "psi",
                (F.col("ks_drift") | (F.col("psi") > PSI_HIGH)).alias("drift_detected"),
            )
        )
    if other:
        parts.append(
            chi_square_drift(baseline, current, other, p_threshold).select(
                "feature",
                F.lit("categorical").alias("type"),
                F.col("chi2").alias("statistic"),
                F.col("chi2_p").alias("p_value"),
                F.lit(None).cast("double").alias("psi"),
                F.col("chi2_drift").alias("drift_detected"),
            )
        )
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # One row per column, so the whole-report window is small by construction.
    return report.withColumn("overall_drift", F.max("drift_detected").over(Window.partitionBy()))
