import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.operators import drift, quality


def frame(spark, **cols):
    names = list(cols)
    return spark.createDataFrame(list(zip(*cols.values())), names)


def test_missing_values_share_and_limit(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1.0), (4, float("nan"))], "a int, b double")
    got = {r["column"]: (r.null_count, r.null_percentage, r.valid) for r in quality.check_missing_values(df).collect()}
    assert got == {"a": (0, 0.0, True), "b": (2, 0.5, True)}
    strict = {r["column"]: r.valid for r in quality.check_missing_values(df, nan_is_missing=True).collect()}
    assert strict == {"a": True, "b": False}
    empty = quality.check_missing_values(df.limit(0)).collect()
    assert all(r.null_percentage == 0.0 and r.valid for r in empty)


def test_duplicates_treat_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int")
    r = quality.check_duplicates(df, ["k", "v"]).first()
    assert (r.total_rows, r.unique_rows, r.duplicate_count, r.valid) == (3, 2, 1, False)
    assert quality.check_duplicates(df.limit(0), ["k"]).first().valid


def test_ranges_describe_and_bounds(spark):
    df = spark.range(1, 5)
    r = quality.check_value_ranges(df, ["id"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"], r.valid) == (4, 2.5, 1.0, 4.0, True)
    assert r.stddev == pytest.approx(1.2909944487)
    assert not quality.check_value_ranges(df, ["id"], bounds={"id": (2, None)}).first().valid


def test_overall_verdict(spark):
    good = spark.range(3)
    rows = quality.run_all_checks(good, ["id"], ["id"]).collect()
    assert [r.valid for r in rows if r.check == "overall"] == [True]
    bad = quality.run_all_checks(good.union(good), ["id"], ["id"]).collect()
    assert [r.valid for r in bad if r.check == "overall"] == [False]


def test_schema_volume_and_required_columns(spark):
    df = spark.createDataFrame([("30", 1, 2.0, 5)], "age string, id int, rate double, extra int")
    contract = quality.schema_contract(spark.createDataFrame([], "age bigint, id int, rate float, gone string"))
    got = {r["column"]: (r.change, r.valid) for r in quality.check_schema(df, contract).collect()}
    assert got == {
        "age": ("changed", False),
        "id": ("same", True),
        "rate": ("widened", True),
        "gone": ("missing", False),
        "extra": ("added", True),
    }
    assert quality.missing_columns(df, ["id", "x"]) == ["x"]
    assert not quality.check_volume(spark.range(70), 100).first().valid
    assert quality.check_volume(spark.range(80), 100).first().valid


def ks_brute(a, b):
    a, b = np.sort(a), np.sort(b)
    grid = np.concatenate([a, b])
    return np.max(np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)))


def psi_brute(e, a):
    q = np.percentile(e, np.linspace(0, 100, 11))
    q[0] -= 0.1
    q[-1] += 0.1
    p = np.histogram(e, q)[0] / len(e)
    c = np.histogram(a, q)[0] / len(a)
    return float(np.sum((c - p) * np.log((c + 0.0001) / (p + 0.0001))))


CASES = {
    "shift": (np.arange(50.0), np.arange(50.0) * 1.7 - 3),
    "ties": (np.repeat([1.0, 2.0, 3.0], [30, 5, 5]), np.repeat([1.0, 3.0, 9.0], [4, 4, 20])),
    "short": (np.array([1.0, 2.0]), np.array([5.0, 6.0, 7.0])),
}


@pytest.mark.parametrize("case", CASES)
def test_ks_and_psi_equal_brute_force(spark, case):
    a, b = CASES[case]
    base = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    ks = drift.ks_drift(base, cur, ["x"]).first()
    assert ks.ks_statistic == pytest.approx(ks_brute(a, b))
    assert (ks.n_base, ks.n_cur) == (len(a), len(b))
    assert drift.population_stability_index(base, cur, ["x"]).first().psi == pytest.approx(psi_brute(a, b), abs=1e-9)


def test_identity_has_no_drift(spark):
    df = spark.createDataFrame([(float(i % 7), "ab"[i % 2]) for i in range(60)], "x double, c string")
    r = {x.feature: x for x in drift.detect_drift(df, df).collect()}
    assert r["x"].statistic == 0 and r["x"].psi == 0 and r["c"].statistic == 0
    assert not any(x.drift_detected or x.overall_drift for x in r.values())
    jsd = drift.jsd_distance(drift.value_counts(df, df, ["x"]), ["feature"], "n_base", "n_cur").first().jsd
    assert jsd == pytest.approx(0, abs=1e-4)


def test_jsd_without_a_key(spark):
    hist = spark.createDataFrame([(1.0, 0.0), (0.0, 3.0), (0.0, 0.0)], "p double, q double")
    assert drift.jsd_distance(hist, [], "p", "q").first().jsd == pytest.approx(math.sqrt(math.log(2)), abs=1e-6)


def test_too_few_values_and_nan_are_no_drift(spark):
    one = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    many = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    r = drift.ks_drift(one, many, ["x"]).first()
    assert (r.n_base, r.n_cur, r.ks_drift) == (1, 100, False)


def test_chi_square_with_and_without_correction(spark):
    def rows(counts):
        return spark.createDataFrame([(c,) for c, n in counts.items() for _ in range(n)], "c string")

    r = drift.chi_square_drift(rows({"a": 30, "b": 10}), rows({"a": 20, "b": 20}), ["c"]).first()
    assert (r.dof, r.chi2_drift) == (1, True)
    assert r.chi2 == pytest.approx(4.32) and r.chi2_p == pytest.approx(0.0376671, abs=1e-6)
    three = drift.chi_square_drift(rows({"a": 10, "b": 10}), rows({"a": 10, "b": 10, "z": 3}), ["c"]).first()
    want = 2 * (10 - 20 * 20 / 43) ** 2 / (20 * 20 / 43) + 2 * (10 - 20 * 23 / 43) ** 2 / (20 * 23 / 43)
    want += (3 * 20 / 43) + (3 - 3 * 23 / 43) ** 2 / (3 * 23 / 43)
    assert three.dof == 2 and three.chi2 == pytest.approx(want)
    assert three.chi2_p == pytest.approx(math.exp(-want / 2))
    single = drift.chi_square_drift(rows({"a": 5}), rows({"a": 9}), ["c"]).first()
    assert single.chi2_p == 1.0 and not single.chi2_drift


def test_chi_square_tail(spark):
    """Even degrees of freedom have a closed form, one has the error function, and many are
    nearly normal (Wilson and Hilferty)."""
    xs = [0.01, 0.5, 1.9, 2.0, 2.1, 3.84, 6.0, 20.0, 90.0, 200.0]
    rows = [(x, d) for x in xs for d in (1, 2, 4, 6, 40)] + [(1e6 + 3000.0, 1_000_000), (1e6 - 3000.0, 1_000_000), (5e7, 2526), (0.0, 3), (7.0, 0)]
    df = spark.createDataFrame(rows, "x double, dof long").select("*", drift.chi2_tail(F.col("x"), F.col("dof")).alias("p"))
    for x, dof, p in df.collect():
        z, half = x / 2, dof // 2
        if x == 0 or dof == 0:
            want = 1.0
        elif dof == 1:
            want = math.erfc(math.sqrt(z))
        elif dof <= 40:
            want = math.exp(-z) * sum(z**i / math.factorial(i) for i in range(half))
        elif x > 1e7:
            want = 0.0
        else:
            t = 2 / (9 * dof)
            assert p == pytest.approx(math.erfc(((x / dof) ** (1 / 3) - 1 + t) / math.sqrt(2 * t)) / 2, abs=1e-4)
            continue
        assert p == pytest.approx(want, rel=1e-9, abs=1e-14), (x, dof)


RNG = np.random.default_rng(11)
HARD = {
    "heavy tail": (np.exp(RNG.normal(0, 12, 3000)), np.exp(RNG.normal(0.2, 12, 2500))),
    "far offset": (1.7e15 + RNG.integers(0, 50, 2000), 1.7e15 + RNG.integers(3, 60, 900)),
    "whole range": (np.concatenate([[-1.7e308, 1.7e308], RNG.normal(size=999)]), RNG.normal(0.1, 1, 1500)),
    "one value": (np.full(500, 3.0), np.full(70, 3.0)),
    "no overlap": (RNG.normal(0, 1, 400), RNG.normal(50, 1, 400)),
    "same": (np.arange(5000.0), np.arange(5000.0)),
    "fine shift": (RNG.random(20_000), RNG.random(20_000) * 1.01),
}


@pytest.mark.parametrize("case", HARD)
def test_refined_histogram_is_exact(spark, case):
    import pandas as pd

    a, b = HARD[case]
    base, cur = (spark.createDataFrame(pd.DataFrame({"x": x, "y": -x})) for x in (a, b))
    got = {r.feature: r for r in drift.numeric_profile(base, cur, ["x", "y"]).collect()}
    for name, sign in (("x", 1), ("y", -1)):
        assert got[name].ks_statistic == pytest.approx(ks_brute(sign * a, sign * b), abs=1e-12)
        assert got[name].psi == pytest.approx(psi_brute(sign * a, sign * b), abs=1e-9)


def test_infinite_values_and_empty_sides(spark):
    inf = float("inf")
    base = spark.createDataFrame([(x, None) for x in (-inf, 1.0, 2.0, 3.0)], "x double, y double")
    cur = spark.createDataFrame([(x, 1.0) for x in (1.0, 2.0, inf)], "x double, y double")
    got = {r.feature: r for r in drift.detect_drift(base, cur).collect()}
    assert got["x"].statistic == pytest.approx(1 / 3)
    assert (got["y"].statistic, got["y"].psi, got["y"].drift_detected) == (None, 0.0, False)
    assert drift.numeric_profile(base.limit(0), cur.limit(0), ["x", "y"]).isEmpty()


def test_only_bins_that_matter_are_refined(spark):
    """Of 4096 bins a wider sample needs those around the edges and the largest gap."""
    base = spark.range(100_000).select((F.col("id") * 1.0).alias("v0"), F.lit(False).alias("now"))
    cur = spark.range(100_000).select((F.col("id") * 2.0).alias("v0"), F.lit(True).alias("now"))
    hist = drift._histogram(base.unionByName(cur), 1, 10)
    assert hist.count() > 4000 and hist.filter("refine").count() < 40


def test_zscore_zero_deviation_and_threshold(spark):
    base = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    stats = drift.baseline_stats(base, ["a", "b"])
    cur = spark.createDataFrame([(2.0 + 3.1 * math.sqrt(2), 9.0)], "a double, b double")
    got = {r.feature: (r.z_score, r.drifted) for r in drift.zscore_drift(stats, cur, environment="dev").collect()}
    assert got["a"] == (pytest.approx(3.1), True)
    assert got["b"] == (None, False)


def test_psi_counts_outsiders_in_the_denominator(spark):
    a, b = np.arange(100.0), np.concatenate([np.arange(50.0), np.full(50, 500.0)])
    base = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    r = drift.population_stability_index(base, cur, ["x"]).first()
    assert r.psi == pytest.approx(psi_brute(a, b), abs=1e-9) and r.high


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 12), min_size=2, max_size=60), st.lists(st.integers(0, 15), min_size=2, max_size=60))
def test_ks_psi_property(spark, a, b):
    base = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    r = drift.numeric_profile(base, cur, ["x"]).first()
    assert r.ks_statistic == pytest.approx(ks_brute(np.array(a), np.array(b)))
    assert r.psi == pytest.approx(psi_brute(np.array(a, float), np.array(b, float)), abs=1e-9)


@pytest.mark.parametrize(
    "old,new,wider",
    [
        ("int", "bigint", True), ("bigint", "int", False), ("int", "decimal(12,2)", True), ("int", "decimal(11,2)", False),
        ("decimal(10,2)", "decimal(12,4)", True), ("decimal(10,2)", "decimal(11,4)", False), ("float", "double", True),
        ("double", "float", False), ("bigint", "double", False), ("int", "double", True), ("date", "timestamp", True),
        ("timestamp", "date", False), ("string", "int", False), ("decimal(10,2)", "double", False),
    ],
)
def test_widening(old, new, wider):
    assert quality.widens(old, new) is wider


def test_missing_current_columns_are_skipped(spark):
    base = spark.range(10).withColumn("x", F.lit("a"))
    assert {r.feature for r in drift.detect_drift(base, spark.range(10)).collect()} == {"id"}
