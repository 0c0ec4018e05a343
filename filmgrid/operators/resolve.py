"""Which film does a chart row mean? Same normalised title, nearest release date, at most 50 days away.

A title common to many films and chart rows would make a join on the title quadratic. Instead films and rows are put
into one frame, folded to one row per (title, day) before the shuffle, and a forward and a backward window over the days
carry the neighbouring films along. However often a title occurs, it has no more rows there than there are days and
chart weeks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: farther matches are not trusted.
MAX_DAYS = 50


def _with_nearest(marks: DataFrame) -> DataFrame:
    """Add ``best``, the ``(days_diff, movie_id)`` of the film nearest to each row's day; null without any film.

    ``marks`` has ``title_cleaned, day, movie_id``, the last one only on film rows, of which there is at most one per
    title and day. Rows of the same day see each other's film. On equal distance the smaller id wins. A missing title
    has no film; this is decided here and not in a filter, which Spark would push down to where the title is computed
    and so compute it twice.
    """
    film = F.when(F.col("movie_id").isNotNull(), F.struct(F.col("day").alias("released"), "movie_id"))
    by_title = Window.partitionBy("title_cleaned")

    def candidate(neighbour: str) -> Column:
        released = F.col(f"{neighbour}.released")
        distance = F.abs(F.datediff("day", released)).alias("days_diff")
        known = released.isNotNull() & F.col("title_cleaned").isNotNull()
        return F.when(known, F.struct(distance, F.col(f"{neighbour}.movie_id").alias("movie_id")))

    # a backward frame is written as a descending order, since Spark would evaluate it anew for every row
    return (
        marks.withColumn("before", F.last(film, ignorenulls=True).over(by_title.orderBy("day")))
        .withColumn("after", F.last(film, ignorenulls=True).over(by_title.orderBy(F.col("day").desc())))
        .withColumn("best", F.least(candidate("before"), candidate("after")))
        .drop("before", "after")
    )


def _film_marks(films: DataFrame) -> DataFrame:
    dated = films.where("release_date IS NOT NULL")
    return dated.select("title_cleaned", F.col("release_date").alias("day"), "movie_id")


def nearest_films(wanted: DataFrame, films: DataFrame) -> DataFrame:
    """``(title_cleaned, day, days_diff, movie_id)``: the film released nearest to each different (title, day).

    ``wanted`` has ``title_cleaned, day``; ``films`` has ``title_cleaned, release_date, movie_id``.
    """
    dated = wanted.where("day IS NOT NULL").select("title_cleaned", "day", F.lit(True).alias("is_wanted"))
    marks = _film_marks(films).withColumn("is_wanted", F.lit(False)).unionByName(dated, allowMissingColumns=True)
    days = marks.groupBy("title_cleaned", "day").agg(
        F.min("movie_id").alias("movie_id"), F.max("is_wanted").alias("is_wanted")
    )
    found = _with_nearest(days).where("is_wanted AND best IS NOT NULL")
    return found.select("title_cleaned", "day", "best.days_diff", "best.movie_id")


def resolve_chart(chart: DataFrame, films: DataFrame, max_days: int = MAX_DAYS) -> DataFrame:
    """Chart rows with their film, one per (title, week).

    ``chart`` has ``title_cleaned, week_end_date, likely_release_date, rank, gross, theaters``. The nearest pair per
    (title, week) is taken and then tested against the cut-off. Testing first gives the same rows, as a group whose
    nearest film is too far loses all its pairs either way.

    The chart is read once. After the windows the rows lie together by title, so that picking one per week needs no
    further shuffle.
    """
    row = F.struct("rank", "gross", "theaters").alias("row")
    entries = chart.select("title_cleaned", "week_end_date", F.col("likely_release_date").alias("day"), row)
    marks = _film_marks(films).unionByName(entries.where("day IS NOT NULL"), allowMissingColumns=True)
    folded = marks.groupBy("title_cleaned", "week_end_date", "day").agg(
        F.min("movie_id").alias("movie_id"), F.min("row").alias("row")
    )
    near = _with_nearest(folded).where(F.col("week_end_date").isNotNull() & (F.col("best.days_diff") <= max_days))
    winner = F.min(F.struct("best.days_diff", "best.movie_id", "row")).alias("winner")
    return (
        near.groupBy("title_cleaned", "week_end_date")
        .agg(winner)
        .select(
            "title_cleaned",
            "week_end_date",
            "winner.movie_id",
            "winner.row.rank",
            F.col("winner.row.gross").alias("domestic_gross"),
            F.col("winner.row.theaters").alias("domestic_theaters_count"),
            "winner.days_diff",
        )
    )
