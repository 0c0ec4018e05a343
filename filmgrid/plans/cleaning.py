"""Raw records to the five warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrid.functions import dates, nested, numbers, text
from filmgrid.operators import calendar, dedup, lookup, reshape, resolve

# First release year no longer counted for a collection, and the change keys that are kept.
COLLECTION_CUTOFF_YEAR = 2020
PEOPLE_FIELDS = {
    "name": "name",
    "birthday": "birthday",
    "gender": "gender",
    "popularity": "tmdb_popularity",
    "known_for_department": "known_for",
}
YOUTUBE_NAMES = {
    "id": "video_key_id",
    "viewCount": "view_count",
    "likeCount": "like_count",
    "commentCount": "comment_count",
}
COUNTS = ["view_count", "like_count", "comment_count"]


def clean_movies(raw: DataFrame, languages: DataFrame) -> DataFrame:
    """Film details to the movie table: films shown in cinemas that earned something.

    Apart from the language lookup everything is an expression inside one row.
    """
    shown = raw.where(nested.shown_in_cinemas(F.col("release_dates")) & (F.col("revenue") > 0))
    cast, crew = F.col("credits.cast"), F.col("credits.crew")
    films = shown.select(
        F.col("id").alias("movie_id"),
        "revenue",
        "budget",
        "imdb_id",
        "title",
        "original_language",
        dates.parse_date(F.col("release_date")).alias("release_date"),
        nested.field_of_each(F.col("genres"), "name").alias("genres"),
        "runtime",
        "status",
        nested.size_or_zero(F.col("production_companies")).alias("production_companies_count"),
        numbers.flag_unless_false(F.col("adult")).alias("is_adult"),
        nested.any_keyword_contains(F.col("keywords.keywords"), "based on").alias("is_adaptation"),
        F.col("belongs_to_collection.id").alias("collection_id"),
        nested.id_at(cast, 1).alias("cast1_id"),
        nested.id_at(cast, 2).alias("cast2_id"),
        nested.last_with_job(crew, "Director").alias("director_id"),
        nested.last_with_job(crew, "Producer").alias("producer_id"),
        F.col("popularity").alias("tmdb_popularity"),
        F.col("vote_average").alias("tmdb_vote_average"),
        F.col("vote_count").alias("tmdb_vote_count"),
        nested.trailer_keys(F.col("videos.results")).alias("video_key_id"),
    )
    # a table's array column knows no null, only empty
    empty = F.array().cast("array<string>")
    films = films.withColumns({c: F.coalesce(c, empty) for c in ("genres", "video_key_id")})
    return lookup.replace_code(films, "original_language", languages, "iso_639_1", "english_name")


def clean_people(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("people_id"),
        "name",
        dates.parse_date(F.col("birthday")).alias("birthday"),
        "gender",
        F.col("popularity").alias("tmdb_popularity"),
        F.col("known_for_department").alias("known_for"),
        nested.size_or_zero(F.col("movie_credits.cast")).alias("total_number_cast_credits"),
        nested.size_or_zero(F.col("movie_credits.crew")).alias("total_number_crew_credits"),
    )


def _typed_people_fields(df: DataFrame) -> DataFrame:
    return df.dropna(how="all", subset=list(PEOPLE_FIELDS.values())).select(
        "people_id",
        "name",
        dates.parse_date(F.col("birthday")).alias("birthday"),
        F.col("gender").cast("bigint").alias("gender"),
        F.col("tmdb_popularity").cast("double").alias("tmdb_popularity"),
        "known_for",
    )


def clean_people_changes(raw: DataFrame) -> DataFrame:
    """Change records to sparse people rows; of several changes to one field the last counts. No shuffle."""
    pairs = raw.select("people_id", nested.kept_changes(F.col("changes")).alias("pairs"))
    fields = pairs.select(
        "people_id", *[nested.last_value_for(F.col("pairs"), key).alias(name) for key, name in PEOPLE_FIELDS.items()]
    )
    return _typed_people_fields(fields)


def change_log(raw: DataFrame) -> DataFrame:
    """Change records, with whatever order columns they have, as one row per edit of a kept field.

    ``change`` is the place of the edit in its record.
    """
    order = [c for c in raw.columns if c not in ("people_id", "changes")]
    pairs = raw.select("people_id", *order, F.posexplode(nested.kept_changes(F.col("changes"))).alias("change", "edit"))
    return pairs.select("people_id", *order, "change", "edit.key", F.lit("updated").alias("action"), "edit.value")


def kept_changes(log: DataFrame) -> DataFrame:
    return log.where(~F.col("action").isin(*nested.DISCARDED_ACTIONS))


def fold_people_changes(log: DataFrame, order: list[str]) -> DataFrame:
    """The same from a log of single edits ``(people_id, key, action, value, *order)`` over any number of rows."""
    edits = kept_changes(log)
    return _typed_people_fields(dedup.latest_values(edits, "people_id", "key", "value", order, PEOPLE_FIELDS))


def clean_collections(raw: DataFrame) -> DataFrame:
    """Collection records, possibly several per key from several files, of which the last file's counts."""
    if "_file" in raw.columns:
        raw = dedup.keep_last(raw, ["_key"], ["_file"])
    early = raw.withColumn("early", nested.films_before(F.col("parts"), COLLECTION_CUTOFF_YEAR))
    return early.select(
        F.col("id").alias("collection_id"),
        text.strip(F.col("name")).alias("name"),
        nested.size_or_zero(F.col("early")).alias("number_movies_before_2020"),
        nested.mean_of(F.col("early"), "popularity").alias("avg_popularity_before_2020"),
    )


def video_details(raw: DataFrame) -> DataFrame:
    """Film details to one row per different video."""
    videos = raw.select(F.col("id").alias("movie_id"), F.col("videos.results").alias("results"))
    return reshape.explode_structs(videos, ["movie_id"], "results").distinct()


def flatten_youtube(records: DataFrame) -> DataFrame:
    """Records with a statistics object to flat rows with numbers."""
    flat = records.select("id", "statistics.*")
    return flat.select("id", *[F.col(c).cast("double").alias(c) for c in flat.columns if c != "id"])


def video_statistics(youtube: DataFrame, vimeo: DataFrame) -> DataFrame:
    """Statistics of both sites under one set of names, exact repeats dropped."""
    return youtube.withColumnsRenamed(YOUTUBE_NAMES).unionByName(vimeo).distinct()


def latest_statistics(statistics: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per video: the last in ``order``, such as that of the files; missing counts are 0.

    Rows that ``order`` does not tell apart, or all without one, are told apart by their counts, the larger ones
    being taken as the later ones. Taken before the join to the films, it keeps a video that many films share from
    being paired with each refresh.
    """
    return dedup.keep_last(statistics.na.fill(dict.fromkeys(COUNTS, 0.0)), ["video_key_id"], [*order, *COUNTS])


def named_videos(details: DataFrame) -> DataFrame:
    """The columns of the statistics that come from the films."""
    return details.select(
        "movie_id",
        F.col("key").cast("string").alias("video_key_id"),
        F.col("site").alias("video_site"),
        F.col("type").alias("video_type"),
        "published_at",
    )


def counted_videos(named: DataFrame, statistics: DataFrame) -> DataFrame:
    """Videos that have statistics; missing counts are 0."""
    joined = named.join(statistics.withColumn("video_key_id", F.col("video_key_id").cast("string")), "video_key_id")
    filled = joined.na.fill(dict.fromkeys(COUNTS, 0.0))
    counted = filled.withColumns({c: F.col(c).cast("bigint") for c in COUNTS})
    columns = ["movie_id", "video_key_id", "video_site", "video_type", "published_at", *COUNTS]
    return counted.select(*columns).distinct()


def clean_video_stats(details: DataFrame, statistics: DataFrame) -> DataFrame:
    """Videos of films with their statistics."""
    return counted_videos(named_videos(details), statistics)


def clean_weekly_chart(raw: DataFrame, years: tuple[int, int] | None = None, legacy_year: bool = False) -> DataFrame:
    """Chart rows parsed, re-releases left out, with the week's end and the likely release date.

    The week's end follows from year and week alone, for any year. Rows whose week does not exist are left out; see
    ``chart_rejects``. ``years`` (first and last) is a filter. With ``legacy_year`` the row's year is that in which
    the week ends, so a year's first weeks may have two meanings, or its last week none.
    """
    first = raw.where(text.is_rerelease(F.col("Release")) == 0)
    if years:
        first = first.where(F.col("year").between(*years))
    chart = first.select(
        "year",
        "week",
        text.normalise_title(F.col("Release")).alias("title_cleaned"),
        F.col("Rank").alias("rank"),
        text.parse_money(F.col("Gross")).alias("gross"),
        text.parse_count(F.col("Theaters")).alias("theaters"),
        text.parse_weeks(F.col("Weeks")).alias("weeks"),
    )
    year, week = F.col("year"), F.col("week")
    if legacy_year:
        dated = chart.select("*", F.explode(calendar.week_ends_in(year, week)).alias("week_end_date"))
    else:
        dated = chart.where(calendar.week_problem(year, week).isNull()).withColumn("week_end_date", calendar.week_end(year, week))
    return dated.withColumn("likely_release_date", dates.likely_release(F.col("week_end_date"), F.col("weeks")))


def chart_rejects(raw: DataFrame) -> DataFrame:
    """The chart rows whose week does not exist, as they are, with the ``reason``."""
    return raw.withColumn("reason", calendar.week_problem(F.col("year"), F.col("week"))).where("reason IS NOT NULL")


def lower_case_names(df: DataFrame) -> DataFrame:
    """The frame with all column names in lower case; two names that become one are an error."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("two columns would have one name")
    return df.toDF(*names)


def titled_films(movies: DataFrame) -> DataFrame:
    return movies.select("movie_id", "release_date", text.normalise_title(F.col("title")).alias("title_cleaned"))


def weekly_performance(raw: DataFrame, movies: DataFrame, **chart_options) -> DataFrame:
    """Raw chart rows to weekly performance per film."""
    chart = clean_weekly_chart(raw, **chart_options)
    columns = ["week_end_date", "movie_id", "rank", "domestic_gross", "domestic_theaters_count"]
    return resolve.resolve_chart(chart, titled_films(movies)).select(*columns)


def in_chart_order(performance: DataFrame) -> DataFrame:
    """By week and rank. Files written in this order can be skipped by week."""
    return performance.orderBy("week_end_date", "rank", "movie_id")


def latest_chart(initial: DataFrame, updates: DataFrame) -> DataFrame:
    """All chart rows, the newest file's for every (year, week, film title).

    Both frames carry ``_file`` and ``_landed`` (see ``readers.with_file_order``). Update files beat initial files.
    """
    ranked = initial.withColumn("_source", F.lit(0)).unionByName(updates.withColumn("_source", F.lit(1)))
    order = ["_source", "_landed", "_file", "Rank", "Gross", "Theaters", "Weeks"]
    return dedup.keep_last(ranked, ["year", "week", "Release"], order).drop("_source", "_landed", "_file")


def film_keyed_stats(movies: DataFrame, stats: DataFrame) -> DataFrame:
    """Video statistics keyed by film through the film's own list of video keys.

    ``stats`` may repeat a video for each of its films; a film gets each different statistic once.
    """
    stats = stats.drop("movie_id", "insertion_datetime").distinct().withColumn("movie_id", F.lit(None))
    keys = movies.select("movie_id", F.explode("video_key_id").alias("video_key_id"))
    keys = keys.withColumn("video_key_id", text.first_token(F.col("video_key_id"), "__"))
    return keys.join(stats.drop("movie_id"), "video_key_id").drop("video_key_id")
