"""Dates, clock times and register period names."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def second_of_day(time: Column) -> Column:
    """Whole seconds of a time-of-day text ``HH:MM`` or ``HH:MM:SS``; anything else is an error."""
    part = F.split(time, ":")
    second = F.coalesce(F.floor(F.get(part, F.lit(2)).cast("double")), F.lit(0))
    return (part[0].cast("int") * 3600 + part[1].cast("int") * 60 + second).cast("long")


def seconds_between(start_date: Column, start_time: Column, end_date: Column, end_time: Column) -> Column:
    """Wall-clock seconds between two dates with times of day; null if one of the four is missing.

    Plain arithmetic on days and seconds, so no time zone enters: a night across a clock change
    keeps its 12 hours.
    """
    days = F.datediff(end_date, start_date).cast("long")
    return days * 86_400 + second_of_day(end_time) - second_of_day(start_time)


def quarter_index(date: Column) -> Column:
    """Calendar quarters counted from year 0, so neighbours differ by one."""
    return F.year(date) * 4 + F.quarter(date) - 1


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def iso_week_start(year: int, week: int) -> dt.date:
    """Monday of an ISO week; a week the year does not have is an error."""
    try:
        return dt.date.fromisocalendar(year, week, 1)
    except ValueError as err:
        raise ValueError(f"year {year} has no week {week}") from err


def week_column(name: str) -> tuple[dt.date, dt.date]:
    """``y_YYWW`` → that ISO week as [start, end); two-digit years from 70 on are 19xx.

    The column-name format is our assumption; pass another parser where a
    delivery names its weeks differently.
    """
    found = re.fullmatch(r"y_(\d{2})(\d{2})", name.lower())
    if not found:
        raise ValueError(f"{name!r} is not a week column")
    short, week = int(found[1]), int(found[2])
    start = iso_week_start(short + (1900 if short >= 70 else 2000), week)
    return start, start + dt.timedelta(days=7)


def month_column(name: str) -> tuple[dt.date, dt.date]:
    """``…YYYY_MM`` → that month as [start, end)."""
    found = re.search(r"(\d{4})_(\d{1,2})$", name)
    if not found:
        raise ValueError(f"{name!r} is not a month column")
    year, month = int(found[1]), int(found[2])
    start = dt.date(year, month, 1)
    return start, dt.date(year + month // 12, month % 12 + 1, 1)
