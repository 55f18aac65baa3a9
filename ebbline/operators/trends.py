"""Row-frame trends over an ordered series per entity (W2, W3, W6-W8, FE20).

Frames count rows, not months.  The series is already one row per entity and day or
month, so a window group is bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ebbline.functions.scalars import ratio, relative_change


@dataclass(frozen=True)
class Frames:
    """The three frames all trends share; one sort per entity serves them all."""

    key: str
    ts: str
    slope_rows: int = 6
    recent_rows: int = 3
    prior_rows: int = 6

    def _base(self) -> WindowSpec:
        return Window.partitionBy(self.key).orderBy(self.ts)

    @property
    def slope(self) -> WindowSpec:
        return self._base().rowsBetween(-(self.slope_rows - 1), 0)

    @property
    def recent(self) -> WindowSpec:
        return self._base().rowsBetween(-(self.recent_rows - 1), 0)

    @property
    def prior(self) -> WindowSpec:
        last = -self.recent_rows
        return self._base().rowsBetween(last - self.prior_rows + 1, last)


def time_axis(ts: str, unit: str) -> Column:
    """Days or seconds since 1970 as double (SC12)."""
    days = F.unix_date(F.col(ts).cast("date")).cast("double")
    if unit == "days":
        return days
    if unit == "seconds":
        return F.unix_timestamp(F.col(ts).cast("timestamp")).cast("double")
    raise ValueError(f"unit must be 'days' or 'seconds', not {unit!r}")


def slope(value: Column, t: Column, w: WindowSpec) -> Column:
    """cov(t, y) over rows where y is present, divided by var(t) over all rows of the
    frame.  With gaps in y this is not the regression slope; it is what is specified."""
    return ratio(F.covar_samp(t, value.cast("double")).over(w), F.var_samp(t).over(w))


def regression_slope(value: Column, t: Column, w: WindowSpec) -> Column:
    """Least-squares slope over the pairs present in the frame (the gap-aware variant)."""
    return F.regr_slope(value.cast("double"), t).over(w)


def change(value: Column, frames: Frames) -> Column:
    """(mean of the recent rows - mean of the rows before) / mean of the rows before."""
    v = value.cast("double")
    return relative_change(F.avg(v).over(frames.recent), F.avg(v).over(frames.prior))


def densify_months(
    df: DataFrame, key: str, ts: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Add the missing month-end rows of each entity, with NULL measures.

    Month ends come from a per-entity ``sequence``; the range defaults to the entity's
    own first and last month.
    """
    lo = F.lit(first) if first else F.min(ts)
    hi = F.lit(last) if last else F.max(ts)
    grid = (
        df.groupBy(key)
        .agg(F.trunc(lo, "MM").alias("_lo"), F.trunc(hi, "MM").alias("_hi"))
        .select(key, F.explode(F.expr("sequence(_lo, _hi, interval 1 month)")).alias("_m"))
        .select(key, F.last_day("_m").alias(ts))
    )
    return grid.join(df, [key, ts], "left")


def account_trends(
    series: DataFrame,
    *,
    key: str,
    ts: str,
    cols: dict[str, tuple[str, str]],
    unit: str = "seconds",
    n_slope: int = 6,
    recent: int = 3,
    prior: int = 6,
    dense: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Slope and relative change of each measure (FE20).

    ``cols`` maps a measure to the names of its slope and its change column; an empty
    name leaves that column out.
    """
    if dense:
        series = densify_months(series, key, ts)
    frames = Frames(key, ts, n_slope, recent, prior)
    t = time_axis(ts, unit)
    out: list[Column] = [F.col(key), F.col(ts), *[F.col(c) for c in keep]]
    for measure, (slope_name, change_name) in cols.items():
        if slope_name:
            out.append(slope(F.col(measure), t, frames.slope).alias(slope_name))
        if change_name:
            out.append(change(F.col(measure), frames).alias(change_name))
    return series.select(*out)


def positive_months_flag(value: Column, w: WindowSpec, at_least: int) -> Column:
    """True when ``value`` is positive in at least that many rows of the frame."""
    return F.count(F.when(value > 0, F.lit(1))).over(w) >= at_least


def repeated_count_flag(value: Column, w: WindowSpec, more_than: int, at_least: int) -> Column:
    """True when ``value`` exceeds ``more_than`` in at least that many rows."""
    return F.sum(F.when(value > more_than, 1).otherwise(0)).over(w) >= at_least
