"""What the weekly update keeps up to date by the rows that a batch touches, instead of computing it anew.

Three results depend on everything that has ever landed: which film a chart row means, the last value of every field of a
person, and the counts of every film's videos. Each has state tables beside the warehouse, bucketed by the key that ties
its inputs together (title, person, video). A batch goes into the state, last writer wins; the keys it touches are worked
out again from the state and replace what the result had for them. Every step reads and writes the buckets of its keys
alone, and gives the same again if a run is repeated: what says how things were before is changed last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.functions import text
from filmgrid.operators import dedup, merge, resolve
from filmgrid.plans import cleaning
from filmgrid.session import written
from filmgrid.sources.ordering import order_text
from filmgrid.sources.warehouse import ORDER, Warehouse

STATE = "_state"


def state_of(warehouse: Warehouse) -> Warehouse:
    """The state tables, below the warehouse and with as many buckets."""
    return Warehouse(warehouse.spark, f"{warehouse.root}/{STATE}", schemas.STATE_TABLES, warehouse.buckets)


# chart rows and films


def chart_state(raw: DataFrame) -> DataFrame:
    """Raw chart rows ``(..., _source, _landed, _file)`` as the last one of every (year, week, title as printed).

    Rows without a year, a week or a title are no part of the result, and would match nothing when they come again.
    """
    named = raw.dropna(subset=["year", "week", "Release"])
    order = ["_source", "_landed", "_file", "Rank", "Gross", "Theaters", "Weeks"]
    latest = dedup.keep_last(named, ["year", "week", "Release"], order)
    kept = latest.withColumn(ORDER, order_text(latest, order)).drop("_source", "_landed", "_file")
    return kept.withColumn("title_cleaned", text.normalise_title(F.col("Release")))


def add_chart_rows(state: Warehouse, raw: DataFrame, run_time) -> DataFrame:
    """Take chart rows in; gives the titles concerned."""
    rows = written(chart_state(raw), "chart-rows")
    state.upsert("chart_rows", rows, run_time, ["title_cleaned", "year", "week", "Release"])
    return rows.select("title_cleaned").distinct()


def changed_titles(warehouse: Warehouse, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(title_cleaned, movie_id, release_date)`` of the films in a batch for the movie table: as they are, as they will be.

    The batch is not merged here, so that a run that breaks off still finds the old titles when it is repeated.
    """
    columns = [c for c in warehouse.tables["movie"][0].names if c != "insertion_datetime"]
    old = written(warehouse.rows_of("movie", batch.select("movie_id")).select(*columns, ORDER), "films-before")
    new = merge.upsert(old, batch.select(*columns, ORDER), ["movie_id"], [ORDER])
    titled = lambda films: cleaning.titled_films(films).where("title_cleaned IS NOT NULL")
    return titled(old), titled(new)


def move_titles(state: Warehouse, old: DataFrame, new: DataFrame, run_time) -> DataFrame:
    """Films go from their old titles to their new ones; gives the titles concerned."""
    old, new = written(old, "titles-before"), written(new, "titles-after")
    pairs = old.select("title_cleaned", "movie_id").union(new.select("title_cleaned", "movie_id"))
    state.replace("film_titles", pairs, new, run_time)
    same = old.intersect(new).select("title_cleaned", "movie_id")
    return pairs.join(same, ["title_cleaned", "movie_id"], "left_anti").select("title_cleaned").distinct()


def match_titles(warehouse: Warehouse, state: Warehouse, titles: DataFrame, run_time, **chart_options) -> None:
    """Work out the chart rows of some titles again; what they meant before is taken back."""
    titles = written(titles.distinct(), "titles")
    raw = state.rows_of("chart_rows", titles).drop(ORDER, "insertion_datetime", "title_cleaned")
    films = state.rows_of("film_titles", titles).select("title_cleaned", "release_date", "movie_id")
    matched = resolve.resolve_chart(cleaning.clean_weekly_chart(raw, **chart_options), films).drop("days_diff")
    warehouse.replace("weekly_domestic_performance", titles, matched, run_time)


# fields of people


def change_registers(changes: DataFrame) -> DataFrame:
    """Change records as the last edit of every (person, field), with its place among all edits as ``ORDER``."""
    log = cleaning.kept_changes(cleaning.change_log(changes)).where("people_id IS NOT NULL AND key IS NOT NULL")
    flat = log.withColumns({"_start": F.col("_position.start"), "_row": F.col("_position.row")}).drop("_position", "action")
    order = ["_order", "_start", "_row", "change"]
    latest = dedup.keep_last(flat, ["people_id", "key"], order)
    return latest.withColumn(ORDER, order_text(latest, order)).select("people_id", "key", "value", ORDER)


def apply_changes(warehouse: Warehouse, state: Warehouse, people: DataFrame, run_time) -> None:
    """Lay the last value of every changed field over the records of some people ``(people_id)``."""
    registers = state.rows_of("people_changes", people).withColumn("action", F.lit("updated"))
    warehouse.update("people", cleaning.fold_people_changes(registers, [ORDER]), run_time)


# videos of films


def _listed(films: DataFrame) -> DataFrame:
    """The films of each video, once for every (video, film): a film may list a video under several types."""
    named = cleaning.named_videos(cleaning.video_details(films)).dropna(subset=["video_key_id", "movie_id"])
    return dedup.keep_last(named, ["movie_id", "video_key_id"], ["published_at", "video_type", "video_site"])


def video_lists(films: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Film records ``(..., _order)``, one a film, as ``film_videos`` with their order and ``video_films``."""
    keys = F.array_distinct(F.filter(F.transform("videos.results", lambda v: v["key"]), lambda k: k.isNotNull()))
    empty = F.array().cast("array<string>")
    lists = films.where("id IS NOT NULL").select(F.col("id").alias("movie_id"), F.coalesce(keys, empty).alias("video_keys"), F.col("_order").alias(ORDER))
    return lists, _listed(films)


def move_videos(warehouse: Warehouse, state: Warehouse, films: DataFrame, refreshed: DataFrame | None, run_time) -> None:
    """Put film records and refreshed videos ``(video_key_id)`` into the statistics.

    Films give up the videos that they no longer list. A record older than the one known of its film is passed over.
    """
    lists, listed = video_lists(films)
    known = state.rows_of("film_videos", lists.select("movie_id")).select("movie_id", F.col("video_keys").alias("old_keys"), F.col(ORDER).alias("old_order"))
    taken = lists.join(known, "movie_id", "left").where(F.col("old_order").isNull() | (F.col(ORDER) >= F.col("old_order")))
    taken = written(taken, "film-videos")
    pairs = taken.select("movie_id", F.explode(F.array_union(F.coalesce("old_keys", F.array().cast("array<string>")), "video_keys")).alias("video_key_id"))
    pairs = written(pairs, "video-pairs")
    state.replace("video_films", pairs, listed.join(taken.select("movie_id"), "movie_id", "left_semi"), run_time)
    videos = pairs.select("video_key_id")
    videos = written((videos if refreshed is None else videos.union(refreshed.select("video_key_id"))).distinct(), "videos")
    count_videos(warehouse, state, videos, pairs, run_time)
    state.upsert("film_videos", taken.select("movie_id", "video_keys", ORDER), run_time)


def count_videos(warehouse: Warehouse, state: Warehouse, videos: DataFrame, gone: DataFrame, run_time) -> None:
    """Work out the statistics of some videos again, and take those of ``gone`` pairs of film and video back."""
    films = state.rows_of("video_films", videos).drop(ORDER, "insertion_datetime")
    counts = state.rows_of("video_counts", videos).drop(ORDER, "insertion_datetime")
    rows = written(cleaning.counted_videos(films, counts), "video-stats")
    concerned = gone.select("movie_id", "video_key_id").union(rows.select("movie_id", "video_key_id"))
    warehouse.replace("video_stats", concerned, rows, run_time)
