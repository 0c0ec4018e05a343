"""The 52-week chart calendar and the week ranges a load has to cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.functions import dates

WEEKS_PER_YEAR = 52
# Years covered by default (the end is exclusive).
FIRST_YEAR, END_YEAR = 2021, 2030


def week_end(year: Column, week: Column) -> Column:
    """Thursday that closes a chart week; week 1 starts on the first Friday of the year."""
    return F.date_add(dates.first_friday(year), F.lit(6) + (week - 1) * 7)


def weeks_in(year: Column) -> Column:
    """Number of chart weeks that start in a year, 52 or 53: its Fridays."""
    return F.floor(F.datediff(dates.last_date(year), dates.first_friday(year)) / 7).cast("int") + 1


def week_problem(year: Column, week: Column) -> Column:
    """Why a chart week does not exist; null if it does."""
    return F.when(year.isNull() | week.isNull(), F.lit("no year or week")).when(
        (week < 1) | (week > weeks_in(year)), F.lit("no such week in the year")
    )


def week_ends_in(year: Column, week: Column) -> Column:
    """Array of the ends that a numbered week has in a calendar year, be it a week of that year or of the year before."""
    ends = F.array(*[F.when(week_problem(y, week).isNull(), week_end(y, week)) for y in (year - 1, year)])
    return F.filter(ends, lambda end: F.year(end) == year)


def weeks_of(years: DataFrame, legacy_year: bool = False) -> DataFrame:
    """``(year, week, week_end_date)`` for each row of a one-column frame of years.

    With ``legacy_year`` the label is the year in which the week ends, so that the last week of most years carries
    the next year's number.
    """
    weeks = years.select(
        F.col("year").cast("int").alias("year"),
        F.explode(F.sequence(F.lit(1), F.lit(WEEKS_PER_YEAR))).alias("week"),
    ).withColumn("week_end_date", week_end(F.col("year"), F.col("week")))
    if legacy_year:
        weeks = weeks.withColumn("year", F.year("week_end_date"))
    return weeks


def chart_calendar(spark, first_year: int = FIRST_YEAR, end_year: int = END_YEAR, legacy_year: bool = False) -> DataFrame:
    """Calendar of a year range; its size is 52 rows a year whatever the data."""
    return weeks_of(spark.range(first_year, end_year).select(F.col("id").alias("year")), legacy_year)


def _weeks(year: Column, numbers: Column) -> Column:
    """Array of ``(year, week)``; numbers below 1 fall into the year before."""

    def entry(number: Column) -> Column:
        before = number < 1
        return F.struct(
            F.when(before, year - 1).otherwise(year).cast("int").alias("year"),
            F.when(before, number + WEEKS_PER_YEAR).otherwise(number).cast("int").alias("week"),
        )

    return F.transform(numbers, entry)


def trailing_weeks(year: Column, week: Column) -> Column:
    """The four weeks from five before to two before a given one, back into the last year if need be."""
    return _weeks(year, F.sequence(week - 5, week - 2))


def _up_to(year: Column, first: Column, last: Column) -> Column:
    """Weeks ``first`` to ``last``, an empty array if the range is empty."""
    return F.filter(
        _weeks(year, F.sequence(first, F.greatest(first, last))), lambda entry: entry["week"] <= last
    )


def _last_closed(year: Column, run_date: Column) -> Column:
    """Last week of a year that has its data when the run starts."""
    current = F.year(run_date)
    return (
        F.when(year < current, F.lit(WEEKS_PER_YEAR))
        .when(year == current, dates.iso_week(run_date) - 2)
        .otherwise(F.lit(0))
    )


def weeks_to_reload(year: Column, run_date: Column) -> Column:
    """Past year: weeks 49 to 52. Running year: from five to two weeks before the run. Later years: none."""
    first = F.when(year < F.year(run_date), F.lit(49)).otherwise(F.greatest(F.lit(1), dates.iso_week(run_date) - 5))
    return _up_to(year, first, _last_closed(year, run_date))


def weeks_to_load(year: Column, run_date: Column) -> Column:
    """All weeks of a past year; in the running year those up to two weeks before the run. Later years: none."""
    return _up_to(year, F.lit(1), _last_closed(year, run_date))


def check_batch(year: Column, week: Column, run_date: Column) -> Column:
    """Why a (year, week) cannot be requested; null if it can."""
    current = F.year(run_date)
    # Week of the year counted from the first Sunday, days before it in week 0.
    sunday_week = F.floor((F.dayofyear(run_date) + 6 - (F.dayofweek(run_date) - 1)) / 7)
    return (
        F.when(year < 1982, F.lit("no charts before 1982"))
        .when(week > WEEKS_PER_YEAR, F.lit("week above 52"))
        .when(year > current, F.lit("year in the future"))
        .when((year == current) & (week > sunday_week - 1), F.lit("week not closed yet"))
    )


def is_year(year: Column, run_date: Column) -> Column:
    return (year > 1982) & (year < F.year(run_date))


def is_month(month: Column) -> Column:
    return month.between(1, 12)


def is_week(week: Column) -> Column:
    return week.between(1, WEEKS_PER_YEAR)
