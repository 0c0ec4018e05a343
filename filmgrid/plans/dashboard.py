"""The result set behind every dashboard panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.functions import dates, nested, numbers, text
from filmgrid.operators import competitors as matching
from filmgrid.operators import distribution, reshape
from filmgrid.session import written

# Department of the people table behind each role, and the count columns of trailers.
DEPARTMENTS = {"director_id": "Directing", "producer_id": "Production"}
ROLES = {"Director": "director_id", "Producer": "producer_id"}
ENGAGEMENT = ["view_count", "like_count", "comment_count"]


def in_range(df: DataFrame, ranges: dict[str, tuple[float, float]] | None) -> DataFrame:
    """Keep rows inside all closed ranges; null is in no range."""
    for column, (low, high) in (ranges or {}).items():
        df = df.where(F.col(column).between(low, high))
    return df


def with_profit(movies: DataFrame) -> DataFrame:
    """Films with a budget, and their profit."""
    return movies.where("budget > 0").withColumn("profit", numbers.profit(F.col("revenue"), F.col("budget")))


def _genre_weeks(movies: DataFrame, weekly: DataFrame, metric: Column, name: str) -> DataFrame:
    """``(genres, week_end_date, metric)`` per film, chart week and genre; only the needed columns meet in the join."""
    films = movies.select("movie_id", "genres", metric.alias(name))
    rows = weekly.select("movie_id", dates.sunday_week(F.col("week_end_date")).alias("week_end_date")).join(films, "movie_id")
    return rows.select(F.explode("genres").alias("genres"), "week_end_date", name)


def genre_money(movies: DataFrame, weekly: DataFrame, measure: str = "revenue") -> DataFrame:
    """Revenue or profit of films with a budget, by genre and week.

    A film's whole revenue counts in every week it is in the charts, and once for each of its genres.
    """
    if measure not in ("revenue", "profit"):
        raise ValueError(f"unknown measure {measure}")
    # decimals make the sums independent of their order; the cast is done once per film
    rows = _genre_weeks(with_profit(movies), weekly, F.col(measure).cast("decimal(24,4)"), measure)
    total = F.coalesce(F.sum(measure), F.lit(0)).cast("double")
    return rows.where("genres IS NOT NULL").groupBy("genres", "week_end_date").agg(total.alias(measure))


def genre_popularity(movies: DataFrame, weekly: DataFrame, metric: str = "tmdb_popularity") -> DataFrame:
    """Popularity or vote average (rounded mean) or vote count (sum) by genre and week."""
    counted = metric == "tmdb_vote_count"
    exact = F.col(metric) if counted else F.col(metric).cast("decimal(24,6)")
    rows = _genre_weeks(movies, weekly, exact, metric).where("genres IS NOT NULL")
    total = F.coalesce(F.sum(metric), F.lit(0)).cast("bigint")
    value = total if counted else numbers.round_half_even(F.avg(metric)).cast("bigint")
    return rows.groupBy("genres", "week_end_date").agg(value.alias(metric))


def genre_series(
    series: DataFrame, measure: str, genres: Sequence[str], value_range: tuple[float, float] | None = None
) -> DataFrame:
    """The chosen genres' series, inside a range of values. No genre chosen gives no rows."""
    chosen = series.where(F.col("genres").isin(*genres)) if genres else series.limit(0)
    return in_range(chosen.where(F.col(measure).isNotNull()), {measure: value_range} if value_range else None)


def genre_grid(series: DataFrame, measure: str, genres: Sequence[str] | None = None) -> DataFrame:
    """``(week_end_date, Genre, measure)`` for every week and genre, null where a genre had no film.

    Weeks, genres and values are three looks at the series, so it is written once and read back.
    """
    named = written(series.withColumnRenamed("genres", "Genre"), "genre-series")
    return reshape.full_grid(named, "week_end_date", "Genre", measure, genres)


def all_genres(movies: DataFrame) -> DataFrame:
    return movies.select(F.explode("genres").alias("genre")).distinct()


def films_with_trailers(movies: DataFrame, video_stats: DataFrame) -> DataFrame:
    stats = video_stats.drop("insertion_datetime")
    films = movies.drop("insertion_datetime", "video_key_id")
    return films.join(stats, "movie_id")


def top_metrics(movies: DataFrame, video_stats: DataFrame) -> DataFrame:
    """Films with the highest and lowest revenue, vote average and view count, with the value as shown."""
    metrics = ["revenue", "tmdb_vote_average", "view_count"]
    films = films_with_trailers(movies, video_stats)
    found = distribution.extremes(films, metrics, ["movie_id", "video_key_id"], ["title"])
    shown = (
        F.when(F.col("metric") == "revenue", text.as_usd(F.col("value")))
        .when(F.col("metric") == "tmdb_vote_average", text.as_rating(F.col("value")))
        .otherwise(text.as_count(F.col("value")))
    )
    return found.withColumn("shown", shown)


def budget_points(movies: DataFrame, measure: str = "revenue") -> DataFrame:
    return with_profit(movies).select("budget", measure)


def budget_trend(movies: DataFrame, measure: str = "revenue") -> DataFrame:
    """Least-squares line of revenue or profit over budget."""
    return distribution.trend(with_profit(movies), "budget", measure)


def people_films(movies: DataFrame, people: DataFrame, role_id: str) -> DataFrame:
    """Films with their director or producer, as far as that is the person's department."""
    wanted = people.where(F.col("known_for") == DEPARTMENTS[role_id])
    named = wanted.select(F.col("people_id").alias(role_id), "name")
    return movies.join(named, role_id)


def profit_margins(movies: DataFrame, people: DataFrame, role: str = "Director", per_film: bool = False) -> DataFrame:
    """Mean profit margin per director or producer, best first.

    ``per_film`` repeats a person's row for each of their films, as a join back to the films does.
    """
    role_id = ROLES[role]
    margin = numbers.return_on_budget(F.col("revenue"), F.col("budget"))
    films = movies.where("budget > 0").select(role_id, margin.alias("margin"))
    # films are folded per person before people are looked up, so a busy person costs one row per task
    means = films.where(F.col(role_id).isNotNull()).groupBy(role_id).agg(F.avg("margin").alias("profit_margin"))
    result = people_films(means, people, role_id)
    if per_film:
        result = films.select(role_id).join(result, role_id)
    return result.select(role_id, "profit_margin", "name").orderBy(F.col("profit_margin").desc(), role_id)


def collection_revenue(
    movies: DataFrame, collections: DataFrame, value_range: tuple[float, float] | None = None, per_film: bool = False
) -> DataFrame:
    """Total revenue per collection, highest first; ``per_film`` repeats a collection for each of its films."""
    films = movies.where("collection_id IS NOT NULL")
    total = F.coalesce(F.sum(F.col("revenue").cast("decimal(24,4)")), F.lit(0)).cast("double")
    totals = films.groupBy("collection_id").agg(total.alias("revenue"))
    result = in_range(totals, {"revenue": value_range} if value_range else None)
    result = result.join(collections.select("collection_id", "name"), "collection_id")
    if per_film:
        result = films.select("collection_id").join(result, "collection_id")
    return result.select("collection_id", "revenue", "name").orderBy(F.col("revenue").desc(), "collection_id")


def domestic_and_international(
    movies: DataFrame,
    weekly: DataFrame,
    ranges: dict[str, tuple[float, float]] | None = None,
    cumulative: bool = False,
) -> DataFrame:
    """``(title, Revenue Type, Revenue)``: domestic gross, and what is left of the worldwide revenue.

    By default each chart week's gross stands alone. ``cumulative`` adds up a film's weeks first.
    """
    films = movies.select("movie_id", "title", "revenue")
    gross = weekly.select("movie_id", "domestic_gross")
    if cumulative:
        gross = gross.groupBy("movie_id").agg(F.sum("domestic_gross").alias("domestic_gross"))
    rest = numbers.international(F.col("revenue"), F.col("domestic_gross"))
    rows = gross.join(films, "movie_id").select(
        "title", F.col("domestic_gross").cast("double").alias("domestic_gross"), rest.alias("international_revenue")
    )
    kept = in_range(rows, ranges)
    return reshape.to_long(kept, ["title"], ["domestic_gross", "international_revenue"], "Revenue Type", "Revenue")


def films_with_cast_names(movies: DataFrame, people: DataFrame) -> DataFrame:
    """Films with the names of both leading actors, null where unknown.

    Films without an actor are spread by their own id: they match no one, and need not meet in one task for that.
    """
    actors = people.where("known_for = 'Acting'")
    for slot in ("cast1", "cast2"):
        named = actors.select(F.col("people_id").alias("_person"), F.col("name").alias(f"{slot}_name"))
        actor = F.col(f"{slot}_id")
        known = F.coalesce(actor, -F.abs(F.xxhash64("movie_id") % 2**31)) == F.col("_person")
        movies = movies.join(named, known & actor.isNotNull(), "left").drop("_person")
    return movies


def actor_revenue(movies: DataFrame, people: DataFrame) -> DataFrame:
    """Mean revenue per actor name over both cast places; namesakes count as one.

    Sums per id are taken before names are looked up, so a hot id is folded in every task and one join does for both
    places.
    """
    slots = reshape.to_long(
        movies.select(F.col("revenue").cast("decimal(24,4)").alias("revenue"), "cast1_id", "cast2_id"),
        ["revenue"], ["cast1_id", "cast2_id"], "slot", "people_id",
    )
    sums = slots.where("people_id IS NOT NULL").groupBy("people_id").agg(
        F.sum("revenue").alias("total"), F.count("revenue").alias("films")
    )
    actors = people.where("known_for = 'Acting' AND name IS NOT NULL").select("people_id", F.col("name").alias("actor"))
    mean = F.sum("total").cast("double") / F.nullif(F.sum("films"), F.lit(0))
    return sums.join(actors, "people_id").groupBy("actor").agg(mean.alias("revenue"))


def film_roi(movies: DataFrame) -> DataFrame:
    """Films with their return on investment, null without a budget."""
    return movies.withColumn("ROI", numbers.return_on_budget(F.col("revenue"), F.col("budget")))


def roi_trimmed(movies: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    # written, since the bounds take several passes and the rows another one
    return distribution.trim(written(film_roi(movies), "roi-films"), "ROI", low, high)


def roi_values(movies: DataFrame) -> DataFrame:
    """All ROI values, written out once for the passes that trimming, histogram and density take over them."""
    return written(film_roi(movies).select("ROI").where("ROI IS NOT NULL"), "roi")


def roi_histogram(movies: DataFrame, max_bins: int = 50) -> DataFrame:
    return distribution.histogram(distribution.trim(roi_values(movies), "ROI"), "ROI", max_bins)


def roi_density(movies: DataFrame, steps: int = 100) -> DataFrame:
    return distribution.density(distribution.trim(roi_values(movies), "ROI"), "ROI", steps)


def engagement(
    movies: DataFrame, video_stats: DataFrame, ranges: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """``(title, Metric, Count)`` for every trailer with counts inside the ranges."""
    rows = films_with_trailers(movies, video_stats).select("title", *ENGAGEMENT)
    return reshape.to_long(in_range(rows, ranges), ["title"], ENGAGEMENT, "Metric", "Count")


def top_films(movies: DataFrame, n: int = 5) -> DataFrame:
    """The films with the highest revenue, with marks for the best and worst value of each column."""
    columns = {
        "title": "Movie Title",
        "revenue": "Revenue",
        "tmdb_popularity": "TMDB Popularity",
        "tmdb_vote_average": "TMDB Vote Average",
    }
    best = movies.orderBy(F.col("revenue").desc_nulls_last(), "movie_id").limit(n)
    shown = best.select(*[F.col(c).alias(name) for c, name in columns.items()], text.join_list(F.col("genres")).alias("Genres"))
    # the list holds n rows at most, so that marking them needs no second look at the films
    films = shown.agg(F.collect_list(F.struct(*shown.columns)).alias("films"))

    def marked(film: Column) -> Column:
        flags = []
        for mark, extreme in (("best", F.array_max), ("worst", F.array_min)):
            for measure in list(columns.values())[1:]:
                flag = film[measure] == extreme(F.col("films")[measure])
                flags.append(flag.alias(f"{measure} is {mark}"))
        return F.struct(*[film[c].alias(c) for c in shown.columns], *flags)

    return films.select(F.inline(F.transform("films", marked)))


def competitors(movies: DataFrame, planned: DataFrame) -> DataFrame:
    """Films with a budget that compete with each planned film (see ``operators.competitors``)."""
    films = with_profit(movies).select(
        "movie_id", "title", "revenue", "budget", "release_date", "tmdb_popularity", "tmdb_vote_average", "genres"
    )
    return matching.competitors(planned, films)


def competitors_of_one(movies: DataFrame, release_date, genres: Sequence[str]) -> DataFrame:
    """Competitors of a single planned film, by revenue: a plain filter, no join."""
    day = F.lit(release_date).cast("date")
    near = with_profit(movies).where(dates.strictly_within(F.col("release_date"), day, matching.WINDOW_DAYS))
    return near.where(nested.overlaps(F.col("genres"), list(genres))).orderBy(F.col("revenue").desc(), "movie_id")


def name_choices(df: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Names to choose from, and the extra choices."""
    more = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(e) for e in extra])).alias("name"))
    return df.select("name").unionByName(more)
