"""The initial load and the weekly update of the warehouse, as plain functions for any scheduler.

File names below ``landing`` follow the sources. Initial load: ``raw_movie_details*.ndjson``, ``raw_people*.ndjson``,
``raw_collection_data*.json``, ``raw_youtube_video_stats*.csv``, ``raw_vimeo_video_stats*.csv``, ``weekly_chart*.csv``.
Updates: ``update_raw_movie_details*``, ``append_raw_people*`` (people that are new), ``update_raw_people*`` (changes to
known people), ``update_raw_collection_data*``, ``update_weekly_chart*``, and counts named like those of the initial load
with a date window ``_20240101_20240108`` at the end.

An update takes every file that no finished update has taken, early or late; the list of taken files is a table of the
warehouse, and a run adds to it last. What counts as later is decided by the files: the window in the name, the name, and
the place in the file. Tables keep that order with the rows, so a late file does not undo a newer one, and a run that is
repeated changes nothing. Old files are not read again: what depends on them is in state tables (``plans.maintained``).
"""

from __future__ import annotations

import functools
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.functions import dates
from filmgrid.operators import dedup, resolve
from filmgrid.plans import cleaning, maintained
from filmgrid.session import written
from filmgrid.sources import readers
from filmgrid.sources.warehouse import ORDER, Warehouse

TAKEN = "taken_files"
TAKEN_SCHEMA = schemas.record(file=schemas.STRING, insertion_datetime=schemas.TIME)


def _statistics(spark: SparkSession, youtube: list[str], vimeo: list[str]) -> DataFrame:
    """Counts of both sites with the order of their files."""

    def read(paths: list[str], schema) -> DataFrame:
        rows = readers.read_ordered(spark, paths, "csv", schema)
        return rows.drop("_position").withColumn(ORDER, F.col("_order")).drop("_order")

    return cleaning.video_statistics(read(youtube, schemas.YOUTUBE_STATS), read(vimeo, schemas.VIMEO_STATS))


def _last(df: DataFrame, keys: list[str]) -> DataFrame:
    return dedup.keep_last(df, keys, [ORDER])


def initialise(spark: SparkSession, landing: str, warehouse: Warehouse, languages: DataFrame, run_time, **chart_options) -> None:
    """Create the tables and load all of them; the chart comes last because it looks up the loaded films.

    Of several records of one film, person or video the last one counts, by file and place in the file.
    """
    paths = lambda prefix, extension: readers.file_paths(spark, landing, prefix, extension)
    warehouse.create_all()
    films = readers.read_ordered(spark, paths("raw_movie_details", "ndjson"), "ndjson", schemas.FILM_DETAILS)
    films = written(dedup.keep_last(films, ["id"], ["_order", "_position"]), "films")
    people = readers.read_ordered(spark, paths("raw_people", "ndjson"), "ndjson", schemas.PEOPLE_DETAILS)
    people = dedup.keep_last(people, ["id"], ["_order", "_position"])
    collections = readers.read_keyed_json(spark, readers.prefix_glob(landing, "raw_collection_data", "json"), schemas.COLLECTION_DETAILS)
    charts = readers.read_csv(spark, readers.prefix_glob(landing, "weekly_chart", "csv"), schemas.WEEKLY_CHART)

    warehouse.load("movie", cleaning.clean_movies(films, languages), run_time, "truncate")
    warehouse.load("people", cleaning.clean_people(people), run_time, "truncate")
    warehouse.load("collection", cleaning.clean_collections(collections), run_time, "truncate")
    # counts with a window in their name belong to the updates
    initial = lambda prefix: [p for p in paths(prefix, "csv") if not readers.has_window(p)]
    counts = cleaning.latest_statistics(_statistics(spark, initial("raw_youtube_video_stats"), initial("raw_vimeo_video_stats")), [ORDER])
    state = maintained.state_of(warehouse)
    state.create_all()
    lists, listed = maintained.video_lists(films)
    state.load("film_videos", lists, run_time, "truncate")
    state.load("video_films", listed, run_time, "truncate")
    state.load("video_counts", counts.where("video_key_id IS NOT NULL"), run_time, "truncate")
    state.truncate("people_changes")
    warehouse.load("video_stats", cleaning.counted_videos(listed, counts.drop(ORDER)), run_time, "truncate")

    state.load("chart_rows", maintained.chart_state(_with_source(charts, 0)), run_time, "truncate")
    titles = cleaning.titled_films(warehouse.read("movie")).where("title_cleaned IS NOT NULL")
    state.load("film_titles", titles, run_time, "truncate")
    rows = state.read("chart_rows").drop("title_cleaned", "insertion_datetime")
    weekly = resolve.resolve_chart(cleaning.clean_weekly_chart(rows, **chart_options), state.read("film_titles")).drop("days_diff")
    warehouse.load("weekly_domestic_performance", weekly, run_time, "truncate")


def _with_source(charts: DataFrame, source: int) -> DataFrame:
    """Chart rows with what tells which is later: rows of updates before initial ones, then when and in which file they landed."""
    return readers.with_file_order(charts).withColumn("_source", F.lit(source))


def update_windows(spark: SparkSession, run_date: date) -> dict[str, object]:
    """Date windows and chart week of a run: films and trailers look three months back, people at the last week."""
    day = F.lit(run_date)
    before = run_date - timedelta(weeks=1)
    row = spark.range(1).select(
        dates.update_window(day, 3).alias("films"),
        dates.update_window(day).alias("people"),
        dates.iso_week(F.lit(before)).alias("chart_week"),
        F.year(F.lit(before)).alias("chart_year"),
    )
    return row.first().asDict(recursive=True)


def _taken(warehouse: Warehouse) -> Warehouse:
    """The list of taken files, kept beside the tables."""
    return Warehouse(warehouse.spark, warehouse.root, {TAKEN: (TAKEN_SCHEMA, ["file"])}, buckets=1)


def weekly_update(spark: SparkSession, landing: str, warehouse: Warehouse, languages: DataFrame, run_time, **chart_options) -> None:
    """Bring all tables up to date with what has landed since the last finished update."""
    taken = _taken(warehouse)
    taken.create_if_absent(TAKEN)
    done = {r["file"] for r in taken.read(TAKEN).select("file").collect()}  # names only, one for each landed file

    def fresh(prefix: str, extension: str, windowed: bool = False) -> list[str]:
        found = readers.file_paths(spark, landing, prefix, extension)
        return [p for p in found if readers.file_name(p) not in done and (not windowed or readers.has_window(p))]

    film_files = fresh("update_raw_movie_details", "ndjson")
    people_files = fresh("append_raw_people", "ndjson")
    change_files = fresh("update_raw_people", "ndjson")
    youtube, vimeo = fresh("raw_youtube_video_stats", "csv", True), fresh("raw_vimeo_video_stats", "csv", True)
    collection_files, chart_files = fresh("update_raw_collection_data", "json"), fresh("update_weekly_chart", "csv")

    films = readers.read_ordered(spark, film_files, "ndjson", schemas.FILM_DETAILS)
    latest = dedup.keep_last(films, ["id"], ["_order", "_position"])
    state = maintained.state_of(warehouse)
    titles = []
    if film_files:
        latest = written(latest, "films")
        order = latest.select(F.col("id").alias("movie_id"), F.col("_order").alias(ORDER))
        batch = written(cleaning.clean_movies(latest, languages).join(order, "movie_id"), "movies")
        before, after = maintained.changed_titles(warehouse, batch)
        titles.append(maintained.move_titles(state, before, after, run_time))
    if chart_files:
        charts = readers.read_csv(spark, chart_files, schemas.WEEKLY_CHART)
        titles.append(maintained.add_chart_rows(state, _with_source(charts, 1), run_time))
    if titles:
        maintained.match_titles(warehouse, state, functools.reduce(DataFrame.union, titles), run_time, **chart_options)
    refreshed = None
    if youtube or vimeo:
        counts = cleaning.latest_statistics(_statistics(spark, youtube, vimeo), [ORDER]).where("video_key_id IS NOT NULL")
        refreshed = written(counts, "video-counts")
        state.upsert("video_counts", refreshed, run_time)
    if film_files:
        maintained.move_videos(warehouse, state, latest, refreshed, run_time)
        # the films' old titles and videos were needed up to here
        warehouse.upsert("movie", batch, run_time)
    elif refreshed is not None:
        maintained.count_videos(warehouse, state, refreshed.select("video_key_id"), warehouse.read("video_stats").limit(0), run_time)
    touched = []
    if people_files:
        people = readers.read_ordered(spark, people_files, "ndjson", schemas.PEOPLE_DETAILS)
        people = dedup.keep_last(people, ["id"], ["_order", "_position"])
        order = people.select(F.col("id").alias("people_id"), F.col("_order").alias(ORDER))
        warehouse.upsert("people", cleaning.clean_people(people).join(order, "people_id"), run_time)
        touched.append(order.select("people_id"))
    if change_files:
        changes = readers.read_ordered(spark, change_files, "ndjson", schemas.PEOPLE_CHANGES)
        registers = written(maintained.change_registers(changes), "people-changes")
        state.upsert("people_changes", registers, run_time, ["people_id", "key"])
        touched.append(registers.select("people_id"))
    if touched:
        maintained.apply_changes(warehouse, state, functools.reduce(DataFrame.union, touched), run_time)
    if collection_files:
        raw = readers.read_keyed_json(spark, collection_files, schemas.COLLECTION_DETAILS)
        new = written(cleaning.clean_collections(raw), "collections")
        known = warehouse.rows_of("collection", new.select("collection_id")).select("collection_id")
        # known collections stay as they are
        warehouse.upsert("collection", new.join(known, "collection_id", "left_anti"), run_time)

    for tables in (warehouse, state):
        for name in tables.tables:
            tables.fit(name)
    files = [film_files, people_files, change_files, youtube, vimeo, collection_files, chart_files]
    names = [(readers.file_name(p),) for group in files for p in group]
    if names:
        taken.upsert(TAKEN, spark.createDataFrame(names, "file string"), run_time)
