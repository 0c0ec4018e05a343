"""Expressions over the nested raw records. All work inside one row: no explode, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filmgrid.functions import dates, text

# Fixed values of the source records.
THEATRICAL = 3
TRAILER_TYPES = ("Trailer", "site", "Youtube")
DISCARDED_ACTIONS = ("deleted", "created", "destroyed")


def shown_in_cinemas(release_dates: Column) -> Column:
    """True if any country lists any theatrical release; missing lists count as none."""
    in_country = lambda country: F.exists(country["release_dates"], lambda entry: entry["type"] == THEATRICAL)
    return F.coalesce(F.exists(release_dates["results"], in_country), F.lit(False))


def size_or_zero(items: Column) -> Column:
    return F.when(items.isNotNull(), F.size(items)).otherwise(0).cast("bigint")


def field_of_each(items: Column, name: str) -> Column:
    """Array of structs as an array of one field; null where the array is null or empty."""
    return F.when(F.size(items) > 0, F.transform(items, lambda item: item[name]))


def id_at(items: Column, position: int) -> Column:
    """Id of the element at a 1-based position, null if the array is shorter."""
    return F.try_element_at(items, F.lit(position))["id"]


def last_with_job(crew: Column, job: str) -> Column:
    """Id of the last crew member with this job."""
    return F.try_element_at(F.filter(crew, lambda member: member["job"] == job), F.lit(-1))["id"]


def any_keyword_contains(keywords: Column, part: str) -> Column:
    """1 if any keyword holds ``part`` in any case, 0 otherwise or without keywords."""
    hit = F.exists(keywords, lambda keyword: text.contains_ignoring_case(keyword["name"], part))
    return F.coalesce(hit, F.lit(False)).cast("int")


def trailer_keys(videos: Column) -> Column:
    """Keys of the trailers: null without videos, an empty array with videos but no trailer."""
    trailers = F.filter(videos, lambda video: video["type"].isin(*TRAILER_TYPES))
    return F.when(F.size(videos) > 0, F.transform(trailers, lambda video: video["key"]))


def films_before(parts: Column, year: int) -> Column:
    """The parts of a collection that are dated films released before ``year``."""
    return F.filter(
        parts,
        lambda part: (part["media_type"] == "movie")
        & (part["release_date"] != "")
        & (F.year(dates.parse_date(part["release_date"])) < year),
    )


def mean_of(items: Column, name: str) -> Column:
    """Mean of one field over an array, null for an empty array."""
    total = F.aggregate(items, F.lit(0.0), lambda acc, item: acc + item[name])
    return total / F.nullif(F.size(items), F.lit(0))


def kept_changes(changes: Column) -> Column:
    """Changes whose last item is a real edit, as ``(key, value)`` in source order."""
    last = lambda change: F.try_element_at(change["items"], F.lit(-1))
    edits = F.filter(changes, lambda change: ~last(change)["action"].isin(*DISCARDED_ACTIONS))
    return F.transform(
        edits, lambda change: F.struct(change["key"].alias("key"), last(change)["value"].alias("value"))
    )


def last_value_for(pairs: Column, key: str) -> Column:
    """Value of the last ``(key, value)`` pair with this key, null if there is none."""
    return F.try_element_at(F.filter(pairs, lambda pair: pair["key"] == key), F.lit(-1))["value"]


def overlaps(items: Column, wanted: list[str]) -> Column:
    """True if any wanted value is in the array; an empty wish list filters nothing."""
    if not wanted:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(items, F.array(*[F.lit(value) for value in wanted])), F.lit(False))
