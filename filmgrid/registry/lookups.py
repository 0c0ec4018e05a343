"""Work lists, lookups, profiles and plain scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrid.operators import lookup, profile
from filmgrid.plans import worklists
from filmgrid.registry import Query
from filmgrid.registry.views import (
    COLLECTIONS,
    MOVIES,
    PEOPLE,
    collections,
    cte,
    languages,
    movies,
    people,
    table,
    video_stats,
    VIDEO_STATS,
)
from filmgrid.sources import readers


def people_ids_union(spark, folder):
    return worklists.people_ids(movies(spark, folder))


IDS = """
ids AS (SELECT cast1_id AS people_id FROM v_movie UNION SELECT cast2_id FROM v_movie
        UNION SELECT director_id FROM v_movie UNION SELECT producer_id FROM v_movie)"""


def people_ids_new(spark, folder):
    return worklists.new_people_ids(movies(spark, folder), people(spark, folder))


def people_ids_known(spark, folder):
    return worklists.known_people_ids(people(spark, folder))


def collection_ids_new(spark, folder):
    some = collections(spark, folder).where("avg_popularity_before_2020 > 2")
    return worklists.new_collection_ids(movies(spark, folder), some)


def last_month_ids(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return lookup.released_in_last_month(orders, "o_orderkey", "day")


def film_ids_to_refresh(spark, folder):
    found = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("movie_id"))
    return worklists.film_ids_to_refresh(found, movies(spark, folder))


def language_lookup(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("original_language"))
    named = languages(spark, folder).where("iso_639_1 <> 'es'")
    return lookup.replace_code(documents, "original_language", named, "iso_639_1", "english_name")


def value_by_name(spark, folder):
    """Account balance of the first customer of each segment, looked up by name from the orders' customers."""
    customers = table(spark, folder, "customer")
    wanted = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, "Others").otherwise(F.col("c_mktsegment")).alias("segment")
    )
    return lookup.find_values(wanted, "segment", customers, "c_mktsegment", "c_custkey", "c_acctbal", "balance")


def site_counts(spark, folder):
    return profile.value_counts(table(spark, folder, "events"), "event_type")


def null_profile(spark, folder):
    return profile.null_profile(movies(spark, folder).drop("genres"))


NULL_COLUMNS = [
    "movie_id", "title", "budget", "release_date", "runtime", "is_adult", "is_adaptation", "collection_id",
    "director_id", "producer_id", "tmdb_popularity", "tmdb_vote_average", "revenue", "cast1_id", "cast2_id",
    "tmdb_vote_count",
]


def duplicate_keys(spark, folder):
    return profile.duplicate_keys(table(spark, folder, "events"), ["user_id", "event_type"])


def row_counts(spark, folder):
    counts = [
        table(spark, folder, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in ("part", "lineitem", "orders", "events", "documents")
    ]
    first = counts[0]
    for other in counts[1:]:
        first = first.unionByName(other)
    return first


def first_hundred_films(spark, folder):
    return readers.head(movies(spark, folder).select("movie_id", "title", "revenue"), 100, ["movie_id"])


def query_with_parameters(spark, folder):
    text = "SELECT movie_id, title, budget FROM {films} WHERE budget >= :low AND release_date < :before"
    return readers.run_query(
        spark, text, {"low": 20000.0, "before": "1998-01-01"}, films=movies(spark, folder)
    )


def films_without_trailers(spark, folder):
    stats = video_stats(spark, folder).select("movie_id").distinct()
    return lookup.ids_missing_from(movies(spark, folder).select("movie_id"), stats, "movie_id")


def wanted_films(spark, folder):
    return movies(spark, folder).where(F.col("director_id").isin(1, 2, 3)).dropna(subset=["producer_id"]).select("movie_id")


QUERIES = {
    "people_ids_union": Query(
        people_ids_union, cte(MOVIES, IDS) + "SELECT people_id FROM ids WHERE people_id IS NOT NULL"
    ),
    "people_ids_new": Query(
        people_ids_new,
        cte(MOVIES, PEOPLE, IDS)
        + """SELECT people_id FROM ids
WHERE people_id IS NOT NULL AND people_id NOT IN (SELECT people_id FROM v_people)""",
    ),
    "people_ids_known": Query(people_ids_known, "SELECT DISTINCT s_suppkey AS people_id FROM supplier"),
    "collection_ids_new": Query(
        collection_ids_new,
        cte(MOVIES, COLLECTIONS)
        + """SELECT DISTINCT collection_id FROM v_movie WHERE collection_id IS NOT NULL AND collection_id NOT IN
(SELECT collection_id FROM v_collection WHERE avg_popularity_before_2020 > 2)""",
    ),
    "last_month_ids": Query(
        last_month_ids,
        """SELECT DISTINCT o_orderkey FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN (SELECT max(CAST(o_orderdate AS DATE)) - INTERVAL 1 MONTH FROM orders)
                                    AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    ),
    "film_ids_to_refresh": Query(
        film_ids_to_refresh,
        cte(MOVIES)
        + """SELECT s_suppkey AS movie_id FROM supplier UNION
SELECT movie_id FROM v_movie WHERE release_date >= (SELECT max(release_date) - INTERVAL 1 MONTH FROM v_movie)""",
    ),
    "language_lookup": Query(
        language_lookup,
        "SELECT doc_id, CASE WHEN lang <> 'es' THEN upper(lang) END AS original_language FROM documents",
    ),
    "value_by_name": Query(
        value_by_name,
        """WITH f AS (SELECT c_mktsegment, arg_min(c_acctbal, c_custkey) AS balance FROM customer GROUP BY 1),
w AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'Others' ELSE c_mktsegment END AS segment
      FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, segment, balance FROM w LEFT JOIN f ON c_mktsegment = segment""",
    ),
    "site_counts": Query(site_counts, "SELECT event_type, count(*) AS n FROM events GROUP BY 1"),
    "null_profile": Query(
        null_profile,
        cte(MOVIES)
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM v_movie" for c in NULL_COLUMNS
        ),
    ),
    "duplicate_keys": Query(
        duplicate_keys,
        "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "row_counts": Query(
        row_counts,
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
            for t in ("part", "lineitem", "orders", "events", "documents")
        ),
    ),
    "first_hundred_films": Query(
        first_hundred_films, cte(MOVIES) + "SELECT movie_id, title, revenue FROM v_movie ORDER BY movie_id LIMIT 100"
    ),
    "query_with_parameters": Query(
        query_with_parameters,
        cte(MOVIES) + "SELECT movie_id, title, budget FROM v_movie WHERE budget >= 20000 AND release_date < DATE '1998-01-01'",
    ),
    "films_without_trailers": Query(
        films_without_trailers,
        cte(MOVIES, VIDEO_STATS) + "SELECT movie_id FROM v_movie WHERE movie_id NOT IN (SELECT movie_id FROM v_video)",
    ),
    "wanted_films": Query(
        wanted_films,
        cte(MOVIES) + "SELECT movie_id FROM v_movie WHERE director_id IN (1, 2, 3) AND producer_id IS NOT NULL",
    ),
}
