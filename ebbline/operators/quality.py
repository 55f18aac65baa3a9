"""Table-level data quality (QC1-QC4, X1-X3).

A report has one row per measured column and metric.  All columns are measured in one
aggregation, which shuffles one row per task.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.functions.scalars import ratio


def _is_missing(df: DataFrame, name: str, nan_is_missing: bool) -> Column:
    c = F.col(f"`{name}`")
    if nan_is_missing and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 for an empty table."""
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def _rows(one_row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Turn the single aggregate row into one row per struct."""
    return one_row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def check_missing_values(
    df: DataFrame, max_null_pct: float = 0.5, *, nan_is_missing: bool = False
) -> DataFrame:
    """column, null_count, null_percentage, valid (QC1).  Only a share above the limit fails."""
    names = df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_is_missing(df, n, nan_is_missing)).alias(f"_n{i}") for i, n in enumerate(names)],
    )
    entries = []
    for i, n in enumerate(names):
        share = _share(F.col(f"_n{i}"), F.col("_rows"))
        entries.append(
            F.struct(
                F.lit(n).alias("column"),
                F.col(f"_n{i}").alias("null_count"),
                share.alias("null_percentage"),
                (share <= max_null_pct).alias("valid"),
            )
        )
    return _rows(agg, entries)


def check_duplicates(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """total_rows, unique_rows, duplicate_count, duplicate_percentage, valid (QC2).

    NULL keys equal each other.  Rows are counted per key before the shuffle, so a key that
    fills a large part of the table costs no more than any other.
    """
    per_key = df.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("_n"))
    total, unique = F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))
    return per_key.agg(total.alias("total_rows"), unique.alias("unique_rows")).select(
        "total_rows",
        "unique_rows",
        (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_count"),
        _share(F.col("total_rows") - F.col("unique_rows"), F.col("total_rows")).alias("duplicate_percentage"),
        (F.col("total_rows") == F.col("unique_rows")).alias("valid"),
    )


STATS = {
    "count": F.count,
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


def _stat_columns(numeric_cols: Sequence[str]) -> list[Column]:
    return [
        measure(F.col(c).cast("double")).cast("double").alias(f"_{i}_{stat}")
        for i, c in enumerate(numeric_cols)
        for stat, measure in STATS.items()
    ]


def check_value_ranges(
    df: DataFrame,
    numeric_cols: Sequence[str],
    *,
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """column, count, mean, stddev, min, max, valid (QC3).

    Without ``bounds`` the check describes and never fails.
    """
    agg = df.agg(*_stat_columns(numeric_cols))
    entries = []
    for i, c in enumerate(numeric_cols):
        lo, hi = (bounds or {}).get(c, (None, None))
        ok = F.lit(True)
        if lo is not None:
            ok = ok & F.coalesce(F.col(f"_{i}_min") >= lo, F.lit(True))
        if hi is not None:
            ok = ok & F.coalesce(F.col(f"_{i}_max") <= hi, F.lit(True))
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_{i}_count").cast("bigint").alias("count"),
                *[F.col(f"_{i}_{s}").alias(s) for s in list(STATS)[1:]],
                ok.alias("valid"),
            )
        )
    return _rows(agg, entries)


def run_all_checks(
    df: DataFrame,
    key_columns: Sequence[str] | None = None,
    numeric_cols: Sequence[str] | None = None,
    *,
    max_null_pct: float = 0.5,
) -> DataFrame:
    """All checks as check, column, metric, value, valid, and an ``overall`` row (QC4).

    The check ``table_check`` gives the number of rows and of columns.
    """
    report = _long(check_missing_values(df, max_null_pct), "null_check", ["null_count", "null_percentage"])
    if key_columns:
        dup = check_duplicates(df, key_columns).withColumn("column", F.lit(",".join(key_columns)))
        report = report.unionByName(
            _long(
                dup,
                "duplicate_check",
                ["total_rows", "unique_rows", "duplicate_count", "duplicate_percentage"],
            )
        )
    if numeric_cols:
        ranges = check_value_ranges(df, numeric_cols)
        report = report.unionByName(_long(ranges, "range_check", list(STATS)))
    size = df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit("").alias("column"), "total_rows", F.lit(len(df.columns)).alias("total_columns"), F.lit(True).alias("valid")
    )
    report = report.unionByName(_long(size, "table_check", ["total_rows", "total_columns"]))
    # Each row also feeds the overall row, so the table is not measured a second time.
    overall = F.struct(F.lit("overall").alias("check"), F.lit("").alias("column"), F.lit("valid").alias("metric"))
    own = F.struct("check", "column", "metric")
    return (
        report.withColumn("_k", F.explode(F.array(own, overall)))
        .groupBy("_k")
        .agg(F.max("value").alias("_v"), F.min("valid").alias("valid"))
        .select(
            "_k.*",
            F.when(F.col("_k.check") != "overall", F.col("_v")).alias("value"),
            "valid",
        )
    )


def _long(report: DataFrame, check: str, metrics: Sequence[str]) -> DataFrame:
    entries = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    )
    return report.select(
        F.lit(check).alias("check"), "column", F.explode(entries).alias("_e"), "valid"
    ).select("check", "column", "_e.metric", "_e.value", "valid")


def schema_contract(df: DataFrame) -> DataFrame:
    """position, column, type: what a later delivery of the table has to have.

    One row per column; written to a table, it is the contract that ``check_schema`` reads.
    """
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, `column` string, type string")


_WHOLE = ["tinyint", "smallint", "int", "bigint"]
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))


def widens(old: str, new: str) -> bool:
    """Whether every value of the old type is a value of the new one."""

    def decimal(kind: str) -> tuple[int, int] | None:
        """(digits before the point, digits after it)"""
        if kind in _DIGITS:
            return _DIGITS[kind], 0
        if kind.startswith("decimal("):
            digits, scale = map(int, kind[8:-1].split(","))
            return digits - scale, scale
        return None

    if old in _WHOLE and new in _WHOLE:
        return _WHOLE.index(old) <= _WHOLE.index(new)
    a, b = decimal(old), decimal(new)
    if a and b and new.startswith("decimal("):
        return a[0] <= b[0] and a[1] <= b[1]
    exact = {"float": ("double",), "date": ("timestamp", "timestamp_ntz")}
    exact |= {k: ("float", "double") for k in ("tinyint", "smallint")} | {"int": ("double",)}
    return new in exact.get(old, ())


def check_schema(df: DataFrame, contract: DataFrame) -> DataFrame:
    """column, expected, actual, change, valid for every column of either side.

    ``contract`` is a stored ``schema_contract``.  A column is the same, widened, changed,
    missing or added; a changed or missing one breaks the contract.
    """
    expected = {r["column"]: r["type"] for r in contract.orderBy("position").select("column", "type").collect()}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}

    def change(name: str) -> str:
        old, new = expected.get(name), actual.get(name)
        if old is None or new is None:
            return "added" if old is None else "missing"
        return "same" if old == new else "widened" if widens(old, new) else "changed"

    rows = []
    for name in dict.fromkeys([*expected, *actual]):
        what = change(name)
        rows.append((name, expected.get(name), actual.get(name), what, what in ("same", "widened", "added")))
    return df.sparkSession.createDataFrame(
        rows, "`column` string, expected string, actual string, change string, valid boolean"
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that are not there."""
    return [c for c in required if c not in set(df.columns)]


def check_volume(df: DataFrame, baseline_rows: int, max_drop: float = 0.2) -> DataFrame:
    """rows, baseline_rows, drop_percentage, valid: row loss against a baseline."""
    drop = F.lit(1.0) - ratio(F.col("rows"), F.col("baseline_rows"))
    return (
        df.agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("baseline_rows", F.lit(baseline_rows).cast("bigint"))
        .withColumn("drop_percentage", drop)
        .withColumn("valid", F.coalesce(drop <= max_drop, F.lit(True)))
    )
