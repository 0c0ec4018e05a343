"""Which ids have to be fetched next. Id lists stay DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrid.operators import lookup
from filmgrid.plans import cleaning

PERSON_COLUMNS = ["cast1_id", "cast2_id", "director_id", "producer_id"]


def people_ids(movies: DataFrame) -> DataFrame:
    """Everybody named by a film, from one scan of the films."""
    return lookup.distinct_ids(movies, PERSON_COLUMNS, "people_id")


def new_people_ids(movies: DataFrame, people: DataFrame) -> DataFrame:
    return lookup.ids_missing_from(people_ids(movies), people, "people_id")


def known_people_ids(people: DataFrame) -> DataFrame:
    return lookup.distinct_ids(people, ["people_id"], "people_id", ordered=True)


def collection_ids(raw_films: DataFrame) -> DataFrame:
    """Collections named by raw film details."""
    ids = raw_films.select(F.col("belongs_to_collection.id").alias("collection_id"))
    return ids.where("collection_id IS NOT NULL").distinct()


def new_collection_ids(movies: DataFrame, collections: DataFrame) -> DataFrame:
    """Collections that films name and the collection table lacks."""
    named = lookup.distinct_ids(movies, ["collection_id"], "collection_id")
    return lookup.ids_missing_from(named, collections, "collection_id")


def film_ids_to_refresh(new_ids: DataFrame, movies: DataFrame) -> DataFrame:
    """Newly found films and those released in the last month of the table."""
    return new_ids.select("movie_id").unionByName(lookup.released_in_last_month(movies)).distinct()


def video_keys(raw_films: DataFrame, site: str) -> DataFrame:
    """Keys of the videos on one site."""
    return cleaning.video_details(raw_films).where(F.col("site") == site).select("key")
