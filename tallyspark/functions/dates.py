"""ISO-week arithmetic."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def week_start(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def week_end(start: Column) -> Column:
    return F.date_add(start, 6)


def period_of(day: datetime.date, grain: str) -> datetime.date:
    """The first day of the "day", "week", "month" or "year" that a day lies in."""
    if grain == "week":
        return day - datetime.timedelta(day.weekday())
    return day.replace(day=1) if grain == "month" else day.replace(month=1, day=1) if grain == "year" else day


def next_period(day: datetime.date, grain: str) -> datetime.date:
    """The first day of the period after the one that begins on ``day``."""
    longest = {"day": 1, "week": 7, "month": 31, "year": 366}[grain]
    return period_of(day + datetime.timedelta(longest), grain)


def in_dates(column: str, days: Iterable[datetime.date], grain: str = "day") -> Column:
    """Whether a date is among some days, or first days of periods; runs of them become ranges.

    All are literals, so that a scan prunes partitions by itself, and a whole calendar is one range.
    """
    runs: list[list[datetime.date]] = []
    for day in sorted(set(days)):
        if runs and next_period(runs[-1][1], grain) == day:
            runs[-1][1] = day
        else:
            runs.append([day, day])
    single = [f"DATE '{a}'" for a, b in runs if a == b]
    ranges = [f"`{column}` BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in runs if a != b]
    return F.expr(" OR ".join([*ranges, *([f"`{column}` IN ({', '.join(single)})"] if single else [])]) or "false")
