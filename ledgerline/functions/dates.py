"""Business-date expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Days of the week that are not business days, Sunday being 1.
WEEKEND = (1, 7)

_NO_DATES = "array<date>"


def is_weekday(day: Column) -> Column:
    """True from Monday to Friday."""
    return ~F.dayofweek(day).isin(*WEEKEND)


def business_dates(
    as_of: Column,
    days: int = 2,
    mode: str = "calendar",
    holidays: Iterable[dt.date] = (),
) -> Column:
    """Array of the recent business dates before ``as_of``, earliest first.

    ``calendar`` looks back ``days`` calendar days and leaves weekends out, so it may be empty;
    ``business`` goes back until there are ``days`` dates. ``holidays`` are left out in both.
    """
    if days < 0:
        raise ValueError("days must not be negative")
    if mode not in ("calendar", "business"):
        raise ValueError(f"unknown mode: {mode}")
    off = sorted(set(holidays))
    if days == 0:
        return F.array().cast(_NO_DATES)
    as_of = as_of.cast("date")
    # Seven days hold five weekdays; each holiday can cost one more.
    span = days if mode == "calendar" else (days + len(off)) // 5 * 7 + 7
    past = F.sequence(F.date_sub(as_of, span), F.date_sub(as_of, 1))

    def open_day(day: Column) -> Column:
        return is_weekday(day) & ~day.isin(off) if off else is_weekday(day)

    dates = F.filter(past, open_day)
    return dates if mode == "calendar" else F.slice(dates, -days, days)


def business_date_list(
    spark: SparkSession,
    as_of: dt.date | None = None,
    days: int = 2,
    mode: str = "calendar",
    holidays: Iterable[dt.date] = (),
) -> list[dt.date]:
    """The same dates as values (at most ``days``), so that filters on them reach the scan."""
    start = F.current_date() if as_of is None else F.lit(as_of)
    one = spark.range(1).select(business_dates(start, days, mode, holidays).alias("dates"))
    return list(one.first()["dates"])
