"""Declared schemas: raw records as landed, and the five warehouse tables.

Reading with a declared schema costs no inference pass and gives the same types for every file.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

BOOL, DATE, DOUBLE, INT, LONG = BooleanType(), DateType(), DoubleType(), IntegerType(), LongType()
STRING, TIME, STRINGS = StringType(), TimestampType(), ArrayType(StringType())


def record(**fields: DataType) -> StructType:
    schema = StructType()
    for name, data_type in fields.items():
        schema.add(name, data_type)
    return schema


def list_of(**fields: DataType) -> ArrayType:
    return ArrayType(record(**fields))


FILM_DETAILS = record(
    id=LONG,
    title=STRING,
    adult=BOOL,
    popularity=DOUBLE,
    vote_average=DOUBLE,
    vote_count=LONG,
    budget=DOUBLE,
    imdb_id=STRING,
    original_language=STRING,
    release_date=STRING,
    revenue=DOUBLE,
    runtime=DOUBLE,
    status=STRING,
    belongs_to_collection=record(id=LONG),
    production_companies=list_of(id=LONG),
    genres=list_of(name=STRING),
    credits=record(cast=list_of(id=LONG), crew=list_of(id=LONG, job=STRING)),
    videos=record(results=list_of(key=STRING, site=STRING, type=STRING, published_at=STRING)),
    keywords=record(keywords=list_of(name=STRING)),
    release_dates=record(results=list_of(release_dates=list_of(type=INT))),
)

COLLECTION_DETAILS = record(
    id=LONG, name=STRING, parts=list_of(media_type=STRING, release_date=STRING, popularity=DOUBLE)
)

PEOPLE_DETAILS = record(
    id=LONG,
    name=STRING,
    birthday=STRING,
    gender=LONG,
    popularity=DOUBLE,
    known_for_department=STRING,
    movie_credits=record(cast=list_of(id=LONG), crew=list_of(id=LONG)),
)

PEOPLE_CHANGES = record(people_id=LONG, changes=list_of(key=STRING, items=list_of(action=STRING, value=STRING)))

LANGUAGES = record(iso_639_1=STRING, english_name=STRING)

YOUTUBE_STATS = record(id=STRING, viewCount=DOUBLE, likeCount=DOUBLE, commentCount=DOUBLE)
YOUTUBE_RECORDS = record(id=STRING, statistics=record(viewCount=STRING, likeCount=STRING, commentCount=STRING))
# The key stays a string on both sites: a number-like key must still meet the string key of the film record.
VIMEO_STATS = record(video_key_id=STRING, view_count=DOUBLE, like_count=DOUBLE, comment_count=DOUBLE)

WEEKLY_CHART = record(year=INT, week=INT, Release=STRING, Rank=LONG, Gross=STRING, Theaters=STRING, Weeks=STRING)

CHART_PAGES = record(url=STRING, html=STRING)

MOVIE = record(
    movie_id=LONG,
    revenue=DOUBLE,
    budget=DOUBLE,
    imdb_id=STRING,
    title=STRING,
    original_language=STRING,
    release_date=DATE,
    genres=STRINGS,
    runtime=DOUBLE,
    status=STRING,
    production_companies_count=LONG,
    is_adult=INT,
    is_adaptation=INT,
    collection_id=LONG,
    cast1_id=LONG,
    cast2_id=LONG,
    director_id=LONG,
    producer_id=LONG,
    tmdb_popularity=DOUBLE,
    tmdb_vote_average=DOUBLE,
    tmdb_vote_count=LONG,
    video_key_id=STRINGS,
    insertion_datetime=TIME,
)
COLLECTION = record(
    collection_id=LONG,
    name=STRING,
    number_movies_before_2020=LONG,
    avg_popularity_before_2020=DOUBLE,
    insertion_datetime=TIME,
)
PEOPLE = record(
    people_id=LONG,
    name=STRING,
    birthday=DATE,
    gender=LONG,
    tmdb_popularity=DOUBLE,
    known_for=STRING,
    total_number_cast_credits=LONG,
    total_number_crew_credits=LONG,
    insertion_datetime=TIME,
)
VIDEO_STATS = record(
    movie_id=LONG,
    video_key_id=STRING,
    video_site=STRING,
    video_type=STRING,
    published_at=STRING,
    view_count=LONG,
    like_count=LONG,
    comment_count=LONG,
    insertion_datetime=TIME,
)
WEEKLY_DOMESTIC_PERFORMANCE = record(
    week_end_date=DATE,
    movie_id=LONG,
    rank=LONG,
    domestic_gross=LONG,
    domestic_theaters_count=LONG,
    insertion_datetime=TIME,
)

#: table name -> (schema, key columns)
WAREHOUSE_TABLES = {
    "movie": (MOVIE, ["movie_id"]),
    "collection": (COLLECTION, ["collection_id"]),
    "people": (PEOPLE, ["people_id"]),
    "video_stats": (VIDEO_STATS, ["movie_id", "video_key_id"]),
    "weekly_domestic_performance": (WEEKLY_DOMESTIC_PERFORMANCE, ["title_cleaned"]),
}
#: columns that a table keeps with its rows and does not show
WAREHOUSE_HIDDEN = {"weekly_domestic_performance": record(title_cleaned=STRING)}

#: what the weekly update keeps beside the tables, so that it need not read old files again
STATE_TABLES = {
    # the last row of every (year, week, title as printed)
    "chart_rows": (
        record(title_cleaned=STRING, year=INT, week=INT, Release=STRING, Rank=LONG, Gross=STRING, Theaters=STRING, Weeks=STRING, insertion_datetime=TIME),
        ["title_cleaned"],
    ),
    # the films of a title
    "film_titles": (record(title_cleaned=STRING, movie_id=LONG, release_date=DATE, insertion_datetime=TIME), ["title_cleaned"]),
    # the last value of every field that a change has named, by person
    "people_changes": (record(people_id=LONG, key=STRING, value=STRING, insertion_datetime=TIME), ["people_id"]),
    # the videos of a film, and the films of a video
    "film_videos": (record(movie_id=LONG, video_keys=STRINGS, insertion_datetime=TIME), ["movie_id"]),
    "video_films": (
        record(video_key_id=STRING, movie_id=LONG, video_site=STRING, video_type=STRING, published_at=STRING, insertion_datetime=TIME),
        ["video_key_id"],
    ),
    # the last counts of a video, whether a film lists it or not
    "video_counts": (record(video_key_id=STRING, view_count=DOUBLE, like_count=DOUBLE, comment_count=DOUBLE, insertion_datetime=TIME), ["video_key_id"]),
}
