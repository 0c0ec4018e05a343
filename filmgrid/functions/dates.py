"""Date expressions: week buckets, release estimates, calendar offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column) -> Column:
    """ISO date text; empty and null give null, anything else that is no date is an error."""
    return F.to_date(F.nullif(text, F.lit("")), "yyyy-MM-dd")


def week_ending_on(day: Column, weekday: int) -> Column:
    """The first date on or after ``day`` that falls on ``weekday`` (1 = Sunday ... 7 = Saturday)."""
    return F.date_add(day, F.pmod(F.lit(weekday + 7) - F.dayofweek(day), F.lit(7)))


def sunday_week(day: Column) -> Column:
    """Label of the Monday-to-Sunday week that holds ``day``: its Sunday."""
    return week_ending_on(day, 1)


def last_sunday(day: Column) -> Column:
    """The most recent Sunday on or before ``day``."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def likely_release(week_end: Column, weeks: Column) -> Column:
    """A film in its n-th chart week opened about n + 1 weeks before the week's end."""
    return F.date_sub(week_end, (weeks + 1) * 7)


def days_apart(left: Column, right: Column) -> Column:
    return F.abs(F.datediff(left, right))


def first_friday(year: Column) -> Column:
    return F.next_day(F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1), "FRI")


def last_date(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def strictly_within(day: Column, centre: Column, days: int) -> Column:
    """Open interval: exactly ``days`` away is outside."""
    return (day > F.date_sub(centre, days)) & (day < F.date_add(centre, days))


def update_window(run_date: Column, months_back: int = 0) -> Column:
    """Struct ``(start, end)``: the week up to ``run_date``, moved back by whole months."""
    return F.struct(
        F.add_months(F.date_sub(run_date, 7), -months_back).alias("start"),
        F.add_months(run_date, -months_back).alias("end"),
    )
