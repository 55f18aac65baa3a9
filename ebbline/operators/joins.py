"""Point-in-time joins (J6, J8-J10, PF10-PF12)."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.dates import AsOf, date_array
from ebbline.functions.scalars import least_or_null


def valid_at(
    df: DataFrame,
    asof: AsOf,
    *,
    run_date: dt.date,
    start: str = "RowStartDate",
    end: str = "RowEndDate",
    inclusive: bool = False,
) -> DataFrame:
    """Rows of a validity-interval table at each ``E`` (PF10, PF11, J9).

    An open end counts as valid up to ``run_date``.  A closed end is exclusive unless
    ``inclusive``.  A row is written for each month that its interval shares with the
    calendar, and meets the as-of dates of that month by equality; the days are compared
    in the join.  The date table is broadcast, so rows are not shuffled and only matches
    leave the join, however many dates there are.
    """
    s, e = F.col(start).cast("date"), F.col(end).cast("date")
    days = asof.snapshots
    until = F.least(F.coalesce(e, F.lit(run_date)), F.lit(days[-1]))
    since = F.greatest(s, F.lit(days[0]))
    dates = asof.frame(df.sparkSession).select("as_of_date", F.trunc("as_of_date", "MM").alias("_month"))
    day = F.col("as_of_date")
    before_end = F.col("_end").isNull() | ((F.col("_end") >= day) if inclusive else (F.col("_end") > day))
    # First a plain range filter, which reaches the scan.
    return (
        df.filter((F.col(start) <= F.lit(days[-1])) & (F.col(end).isNull() | (F.col(end) >= F.lit(days[0]))))
        .withColumns({"_start": s, "_end": e, "_from": F.trunc(since, "MM"), "_to": F.trunc(until, "MM")})
        .filter(F.col("_from") <= F.col("_to"))
        .withColumn("_month", F.explode(F.expr("sequence(_from, _to, interval 1 month)")))
        .join(F.broadcast(dates), "_month")
        .filter((F.col("_start") <= day) & (day <= F.coalesce("_end", F.lit(run_date))) & before_end)
        .drop("_month", "_start", "_end", "_from", "_to")
    )


def open_or_closed_within(status: str, closed: str, start: Column, end: Column) -> Column:
    """Open, or closed between the two days, both included (PF12)."""
    return (F.col(status) == "Open") | F.col(closed).cast("date").between(start, end)


def latest_as_of(
    df: DataFrame,
    asof: AsOf,
    keys: Sequence[str],
    date_col: str,
    payload: Sequence[str],
    tiebreak: Sequence[str],
) -> DataFrame:
    """Latest row per key with ``date_col <= E``, for every ``E``.

    Two mergeable ``max_by`` steps: first inside the gap between two as-of dates, where
    a whole history shrinks to one row per key and gap, then forward over the dates.
    No window and so no single-task group for a key with a long history.
    """
    days = asof.snapshots
    keys, payload = list(keys), list(payload)
    d = F.col(date_col)
    first = F.array_min(F.filter(date_array(days), lambda x: x >= d))
    rank = F.struct(F.col("_d"), *[F.col(c) for c in tiebreak])
    carried = list(dict.fromkeys([*payload, *tiebreak]))
    per_gap = (
        df.filter(d <= F.lit(days[-1]))
        .withColumn("_d", d)
        .withColumn("_first", first)
        .groupBy(*keys, "_first")
        .agg(F.max_by(F.struct("_d", *carried), rank).alias("_row"))
        .select(*keys, "_first", "_row.*")
    )
    later = F.filter(date_array(days), lambda x: x >= F.col("_first"))
    return (
        per_gap.withColumn("as_of_date", F.explode(later))
        .groupBy("as_of_date", *keys)
        .agg(F.max_by(F.struct(*payload), rank).alias("_row"))
        .select("as_of_date", *keys, "_row.*")
    )


def capped_lookup(
    asof: AsOf,
    lookup: DataFrame,
    *,
    cap: dt.date,
    month_col: str,
    columns: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Lookup rows for the month ``least(E, cap)`` of every ``E`` (FE17, J8).

    Gives (as_of_date, keys, columns).  Only the months in question are read.
    """
    months = sorted({min(e, cap) for e in asof.snapshots})
    frame = asof.frame(lookup.sparkSession).select(
        "as_of_date", least_or_null(F.col("as_of_date"), F.lit(cap)).alias("_month")
    )
    picked = (
        lookup.withColumn("_month", F.col(month_col).cast("date"))
        .filter(F.col("_month").isin(months))
        .select("_month", *keys, *columns)
    )
    # The date side has one row per as-of date.
    return picked.join(F.broadcast(frame), "_month").drop("_month")
