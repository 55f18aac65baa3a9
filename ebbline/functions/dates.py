"""Calendar arithmetic and the as-of frame (FE1, SC7-SC14)."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def add_months(day: dt.date, n: int) -> dt.date:
    """Shift by whole months, clipping to the last day of a shorter month."""
    total = day.year * 12 + day.month - 1 + n
    year, month = divmod(total, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(day.day, last))


def monthly(start: dt.date, end: dt.date) -> list[dt.date]:
    """start, start + 1 month, ... up to and including ``end`` (SC10)."""
    out: list[dt.date] = []
    while (day := add_months(start, len(out))) <= end:
        out.append(day)
    return out


@dataclass(frozen=True)
class AsOf:
    """As-of dates ``D`` with their split.  Snapshots are read at ``E = D - 1 day``,
    and ``E`` is the ``as_of_date`` key of every feature block."""

    dates: tuple[tuple[dt.date, str], ...]

    def __post_init__(self) -> None:
        days = [d for d, _ in self.dates]
        if not days:
            raise ValueError("no as-of dates")
        if len(set(days)) != len(days):
            raise ValueError("an as-of date belongs to two splits")

    @property
    def days(self) -> list[dt.date]:
        return sorted(d for d, _ in self.dates)

    @property
    def snapshots(self) -> list[dt.date]:
        return [d - dt.timedelta(days=1) for d in self.days]

    def frame(self, spark: SparkSession) -> DataFrame:
        """(as_of, as_of_date, split), one row per as-of date."""
        rows = [(d, d - dt.timedelta(days=1), s) for d, s in self.dates]
        return spark.createDataFrame(rows, "as_of date, as_of_date date, split string")

    def series(self, months: int) -> list[tuple[dt.date, dt.date]]:
        """(snapshot day, as_of_date): the day before each date of the monthly series
        that runs from ``D - months`` to ``D`` (PF7)."""
        pairs = []
        for day in self.days:
            for step in monthly(add_months(day, -months), day):
                pairs.append((step - dt.timedelta(days=1), day - dt.timedelta(days=1)))
        return pairs


# Days of one chain are the bits of a long.
CHAIN_DAYS = 62


def chains(asof: AsOf, months: int) -> list[tuple[list[dt.date], dict[dt.date, int]]]:
    """The month series of all as-of dates as bit masks (PF7).

    A chain is a list of snapshot days in order and, per ``as_of_date``, the mask of the
    days of its series, which follow each other in the chain.  As-of dates one month apart
    share a chain; a day is in a further chain only where a chain is full or the days of
    the month differ.
    """
    one = dt.timedelta(days=1)
    out: list[tuple[list[dt.date], dict[dt.date, list[dt.date]]]] = []

    def follows(days: list[dt.date], series: list[dt.date]) -> bool:
        at = days.index(series[0])
        return days[at : at + len(series)] == series

    for day in asof.days:
        series = [s - one for s in monthly(add_months(day, -months), day)]
        for days, dates in reversed(out):
            both = sorted({*days, *series})
            if len(both) <= CHAIN_DAYS and all(follows(both, s) for s in [series, *dates.values()]):
                days[:] = both
                dates[day - one] = series
                break
        else:
            out.append((sorted(series), {day - one: series}))
    return [(days, {d: sum(1 << days.index(s) for s in series) for d, series in dates.items()}) for days, dates in out]


def asof_dates(
    train: tuple[dt.date, dt.date] | None = None,
    test: tuple[dt.date, dt.date] | None = None,
) -> AsOf:
    """Monthly as-of dates for the training and the test range (FE1)."""
    dates = [(d, "train") for d in (monthly(*train) if train else [])]
    dates += [(d, "test") for d in (monthly(*test) if test else [])]
    return AsOf(tuple(dates))


def date_array(days: Iterable[dt.date]) -> Column:
    """A constant array<date>."""
    return F.array(*[F.lit(d) for d in days])


def at_snapshot(df: DataFrame, asof: AsOf, date_col: str = "EndOfDayDate") -> DataFrame:
    """Rows of a daily snapshot table at each ``E``, keyed by ``as_of_date`` (PF4).

    The dates are literals, so the filter reaches the scan and prunes date partitions;
    no join is needed because the snapshot day *is* the key.
    """
    return df.filter(F.col(date_col).isin(asof.snapshots)).withColumnRenamed(
        date_col, "as_of_date"
    )


def at_month_series(
    df: DataFrame, asof: AsOf, months: int, date_col: str = "EndOfDayDate"
) -> DataFrame:
    """Rows whose day is in the month series of an as-of date, once per such date (PF7).

    The date map holds at most ``dates * (months + 1)`` rows and is built from
    literals, so broadcasting it is bounded by construction.
    """
    pairs = asof.series(months)
    days = sorted({s for s, _ in pairs})
    frame = df.sparkSession.createDataFrame(pairs, f"`{date_col}` date, as_of_date date")
    return df.filter(F.col(date_col).isin(days)).join(F.broadcast(frame), date_col)


def month_diff(a: Column, b: Column) -> Column:
    """Month boundaries crossed from ``b`` to ``a`` (SC7)."""
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)


def age_years(at: Column, birth: Column) -> Column:
    """Calendar years minus one when the day of year is earlier (SC8)."""
    before = F.dayofyear(at) < F.dayofyear(birth)
    return F.year(at) - F.year(birth) - F.when(before, 1).otherwise(0)


def ymd_to_date(value: Column) -> Column:
    """yyyymmdd integer to date; NULL when it is not a date (SC14)."""
    return F.to_date(F.try_to_timestamp(value.cast("string"), F.lit("yyyyMMdd")))


def calendar_days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, ``DateValue``."""
    span = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(span).alias("DateValue"))


def month_ends(dates: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Month-end days of a calendar table before ``end`` (PF8): ``TransactionMonth``."""
    day = F.col("DateValue")
    return (
        dates.filter(day.between(F.lit(start), F.lit(end - dt.timedelta(days=1))))
        .filter(day == F.last_day(day))
        .select(day.alias("TransactionMonth"))
        .distinct()
    )
