"""Landed files and warehouse jobs, with files derived from the test tables."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.operators import dedup
from filmgrid.plans import warehouse_jobs, worklists
from filmgrid.registry import Query
from filmgrid.registry.cleaning import RAW_CHART, RESOLVED, film_details, people_details
from filmgrid.registry.views import CHART, chart, cte, film_columns, languages, table
from filmgrid.session import fresh_path, written
from filmgrid.sources import readers, writers
from filmgrid.sources.warehouse import Warehouse
from filmgrid.streaming.ingest import ingest_files

RUN_TIME = datetime(2024, 4, 1, 12)
CUSTOMER = schemas.record(c_custkey=schemas.LONG, c_name=schemas.STRING, region=schemas.LONG)
CUSTOMERS = schemas.record(
    c_custkey=schemas.LONG, c_name=schemas.STRING, words=schemas.STRINGS, region=schemas.LONG, insertion_datetime=schemas.TIME
)
EVENTS = schemas.record(
    user_id=schemas.LONG, event_type=schemas.STRING, event_id=schemas.LONG, value=schemas.DOUBLE, insertion_datetime=schemas.TIME
)


#: rows of a table that one task makes records of
ROWS_A_TASK = 50_000


def dealt(spark, folder, keys):
    """A folder with some tables of another, as ``keys`` has them with their key, in as many files as their rows keep tasks busy.

    A small file is read by one task, however much its rows are made into. Rows of one key stay in one file and in order.
    """
    to = fresh_path(spark, "dealt")
    for name, key in keys.items():
        rows = table(spark, folder, name)
        parts = -(-rows.count() // ROWS_A_TASK) or 1
        placed = rows.withColumn("_place", F.monotonically_increasing_id()).repartition(parts, key)
        placed.sortWithinPartitions("_place").drop("_place").write.parquet(f"{to}/{name}.parquet")
    return to


def land(spark, df, folder, name):
    """Files of a given name, written in parallel, their format that of the name's ending. Several get a part number each."""
    made = f"{folder}/_made/{name}"
    if name.endswith(".csv"):
        writers.write_csv(df, made)
    elif name.endswith(".ndjson"):
        writers.write_ndjson(df, made)
    else:  # every row is a document
        df.write.option("maxRecordsPerFile", 1).text(made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().toString() for f in system.globStatus(path(f"{made}/part-*")))
    stem, ending = name.rsplit(".", 1)
    for number, part in enumerate(parts):
        system.rename(path(part), path(f"{folder}/{name}" if len(parts) == 1 else f"{folder}/{stem}-{number:05d}.{ending}"))


def _customers(spark, folder):
    customers = table(spark, folder, "customer")
    return customers.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", (F.col("c_nationkey") % 5).cast("bigint").alias("region"))


def _customer_files(spark, folder):
    """Customers in three files by region, each with a date window in its name; later files repeat some with new names."""
    landing = fresh_path(spark, "landing")
    customers = _customers(spark, folder)
    for region, window in ((0, "20240101_20240108"), (1, "20240108_20240115"), (2, "20231225_20240101")):
        named = F.concat("c_name", F.lit(f" {region}"))
        land(spark, customers.where(F.col("region") >= region).withColumn("c_name", named), landing, f"customers_{window}.ndjson")
    return landing


def latest_landed_file(spark, folder):
    latest = readers.latest_file(spark, _customer_files(spark, folder), "customers_", "ndjson")
    # a landing of several tasks has a file for each
    return readers.read_ndjson(spark, re.sub(r"(-[0-9]+)?[.]ndjson$", "*.ndjson", latest), CUSTOMER)


def files_of_a_window(spark, folder):
    landing = _customer_files(spark, folder)
    start, end = datetime(2023, 12, 25), datetime(2024, 1, 1)
    return readers.read_window(spark, landing, "customers", "ndjson", CUSTOMER, start, end)


def last_landed_row(spark, folder):
    """Of each customer the row of the file that landed last."""
    files = readers.prefix_glob(_customer_files(spark, folder), "customers", "ndjson")
    rows = readers.with_file_order(readers.read_ndjson(spark, files, CUSTOMER))
    return dedup.keep_last(rows, ["c_custkey"], ["_landed", "_file"]).drop("_landed", "_file")


def json_documents(spark, folder):
    """Arrays of up to a thousand records, each a document of its own, read in parts that several tasks hold."""
    path = fresh_path(spark, "documents")
    record = F.struct("c_custkey", "c_name", "region")
    arrays = _customers(spark, folder).groupBy(F.floor(F.col("c_custkey") / 1000)).agg(F.to_json(F.collect_list(record)).alias("value"))
    land(spark, arrays.select("value"), path, "customers.json")
    return readers.read_json_document(spark, readers.prefix_glob(path, "customers", "json"), CUSTOMER)


def _warehouse(spark):
    tables = {"customers": (CUSTOMERS, ["c_custkey"]), "latest_events": (EVENTS, ["user_id", "event_type"])}
    return Warehouse(spark, fresh_path(spark, "warehouse"), tables, buckets=4)


def warehouse_csv_load(spark, folder):
    """Arrays as JSON text, and line feeds in a quoted field."""
    path = fresh_path(spark, "csv")
    named = F.concat(F.lit('a "b"\n'), "c_name")
    writers.write_csv(_customers(spark, folder).withColumns({"words": F.split("c_name", "#"), "c_name": named}), path)
    warehouse = _warehouse(spark)
    warehouse.load_csv("customers", f"{path}/*.csv", RUN_TIME, "empty", multi_line=True)
    return warehouse.read("customers").select("c_custkey", F.replace("c_name", F.lit("\n"), F.lit("|")).alias("c_name"), F.array_join("words", "+").alias("words"))


def warehouse_append_partial_columns(spark, folder):
    """Appends of which one lacks a column, the second of them repeated under its load's name."""
    warehouse = _warehouse(spark)
    customers = _customers(spark, folder)
    warehouse.load("customers", customers.where("c_custkey % 2 = 0"), RUN_TIME, "append", load_id="even")
    for _ in range(2):
        warehouse.load("customers", customers.where("c_custkey % 2 = 1").drop("c_name"), RUN_TIME, "append", load_id="odd")
    return warehouse.read("customers").select("c_custkey", "c_name", "region")


def warehouse_steps(spark, folder):
    """Rows after a load, an empty upsert, a truncation, a second load, and whether the table is left after dropping all."""
    warehouse = _warehouse(spark)
    customers = _customers(spark, folder)
    counts = []
    warehouse.load("customers", customers, RUN_TIME, "truncate")
    counts.append(warehouse.read("customers").agg(F.count("*").alias("n")).first()["n"])
    warehouse.upsert("customers", customers.limit(0), RUN_TIME)
    counts.append(warehouse.read("customers").count())
    warehouse.truncate("customers")
    counts.append(warehouse.read("customers").count())
    warehouse.load("customers", customers.where("region = 1"), RUN_TIME, "empty")
    counts.append(warehouse.read("customers").count())
    warehouse.drop_all(confirm=True)
    counts.append(int(warehouse.exists("customers")))
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).cast("bigint").alias("n")) for i, n in enumerate(counts)])
    return customers.limit(1).select(F.inline(steps))


def _film_files(spark, folder):
    """All films in files of two date windows: those with even ids landed in the first week, the others in the second."""
    landing, films = fresh_path(spark, "landing"), film_details(spark, folder)
    for rest, window in ((0, "20240101_20240108"), (1, "20240108_20240115")):
        land(spark, films.where(F.col("id") % 2 == rest), landing, f"update_raw_movie_details_{window}.ndjson")
    return landing


def _video_keys(spark, landing, start=None, end=None):
    raw = readers.read_window(spark, landing, "update_raw_movie_details", "ndjson", schemas.FILM_DETAILS, start, end, required=True)
    return worklists.video_keys(raw, "YouTube")


def video_key_worklist(spark, folder):
    """Keys of the films whose files landed in one window."""
    return _video_keys(spark, _film_files(spark, folder), datetime(2024, 1, 1), datetime(2024, 1, 8))


def video_key_worklist_all_windows(spark, folder):
    """Keys of all films, from the files of all windows."""
    return _video_keys(spark, _film_files(spark, folder))


def incremental_upsert_out_of_order(spark, folder):
    """The event log landed in four files, the newest events first, and taken in one file at a time."""
    landing, warehouse = fresh_path(spark, "landing"), _warehouse(spark)
    events = table(spark, folder, "events")
    quarter = F.expr("ntile(4) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)")
    columns = ["user_id", "event_type", "event_id", "value", F.col("ts").cast("timestamp").alias("ts")]
    dealt = events.select(*columns).withColumn("quarter", quarter)
    schema = schemas.record(
        user_id=schemas.LONG, event_type=schemas.STRING, event_id=schemas.LONG, value=schemas.DOUBLE, ts=schemas.TIME
    )
    for number in range(1, 5):
        land(spark, dealt.where(F.col("quarter") == number).drop("quarter"), landing, f"events_{number}.ndjson")
        ingest_files(
            spark, warehouse, "latest_events", landing, "events_*.ndjson", "json", schema, ["ts", "event_id"],
            f"{warehouse.root}/_checkpoint", RUN_TIME, files_per_batch=1,
        )
    return warehouse.read("latest_events").drop("insertion_datetime")


def _keyed_collections(customers, name):
    """Objects of collections by key, of up to a thousand customers each."""
    key = F.col("c_custkey")
    film = F.struct(F.lit("movie").alias("media_type"), F.lit("1999-07-01").alias("release_date"), F.lit(2.0).alias("popularity"))
    parts = F.when(key % 3 == 0, F.array(film)).otherwise(F.array().cast("array<struct<media_type:string,release_date:string,popularity:double>>"))
    entry = F.struct(key.cast("string"), F.struct(key.alias("id"), name.alias("name"), parts.alias("parts")))
    return customers.groupBy(F.floor(key / 1000)).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).select("value")


def _one_a_title(rows):
    """Of the chart rows of one year, week and title the first."""
    row = F.min(F.struct("Rank", "Gross", "Theaters", "Weeks", "l_orderkey")).alias("row")
    return rows.groupBy("year", "week", "Release").agg(row).select("year", "week", "Release", "row.*")


def weekly_update_two_weeks(spark, folder):
    """The initial load and two weekly updates, the second of them repeated: rows of all five tables.

    People change twice in one file, popularity, votes and views fall, a film file of the first week comes late, films
    get other titles, under which the chart does not know them, or drop their videos, and chart rows come again.
    """
    landing, tables = fresh_path(spark, "landing"), dealt(spark, folder, {"part": "p_partkey", "customer": "c_custkey"})
    part, customers, codes = table(spark, tables, "part"), table(spark, tables, "customer"), languages(spark, folder)
    released = film_columns()["release_date"]
    dates = part.select(F.col("p_partkey").alias("id"), released.cast("string").alias("release_date"))
    # made once, landed several times
    films = written(film_details(spark, tables).drop("release_date").join(dates, "id"), "films")
    people, charts = written(people_details(spark, tables), "people"), written(_one_a_title(chart(spark, folder)), "charts")
    put = lambda df, name: land(spark, df, landing, name)

    def counts(where, views):
        rows = part.where(where).select(F.concat(F.lit("t"), "p_partkey").alias("id"), views.cast("double").alias("viewCount"))
        return rows.withColumns({"likeCount": F.lit(1.0), "commentCount": F.lit(None).cast("double")})

    def changes(where, *names):
        item = lambda value: F.array(F.struct(F.lit("updated").alias("action"), F.lit(value).alias("value")))
        edit = lambda value: F.array(F.struct(F.lit("name").alias("key"), item(value).alias("items")))
        return people.where(where).select(F.col("id").alias("people_id"), F.explode(F.array(*[edit(n) for n in names])).alias("changes"))

    renamed = lambda where, word, votes: films.where(where).withColumns(
        {"title": F.concat(F.lit(f"{word} "), "title"), "vote_count": F.lit(votes).cast("bigint")}
    )
    put(films, "raw_movie_details_0.ndjson")
    put(people, "raw_people_0.ndjson")
    put(_keyed_collections(customers.where("c_custkey % 2 = 0"), F.col("c_name")), "raw_collection_data_0.json")
    put(counts("true", F.col("p_size") * 1000), "raw_youtube_video_stats_0.csv")
    put(charts.drop("l_orderkey"), "weekly_chart_0.csv")
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"), buckets=4)
    warehouse_jobs.initialise(spark, landing, warehouse, codes, RUN_TIME)

    put(renamed("id % 5 = 0", "new", 1), "update_raw_movie_details_20240101_20240108.ndjson")
    put(changes("id % 3 = 0", "first"), "update_raw_people_20240101_20240108.ndjson")
    put(counts("p_partkey % 4 = 0", F.lit(5)), "raw_youtube_video_stats_20240101_20240108.csv")
    put(_keyed_collections(customers, F.concat(F.lit("new "), "c_name")), "update_raw_collection_data_0.json")
    warehouse_jobs.weekly_update(spark, landing, warehouse, codes, RUN_TIME)

    without = F.when(F.col("id") % 14 != 0, F.col("videos"))
    put(renamed("id % 5 = 0 OR id % 7 = 0", "late", 2).withColumn("videos", without), "update_raw_movie_details_20240101_20240107.ndjson")
    put(changes("id % 6 = 0", "second", "third"), "update_raw_people_20240108_20240115.ndjson")
    put(people.where("id % 10 = 0").withColumn("popularity", F.lit(0.5)), "append_raw_people_20240108_20240115.ndjson")
    put(counts("p_partkey % 8 = 0", F.lit(3)), "raw_youtube_video_stats_20240108_20240115.csv")
    put(charts.where("l_orderkey % 2 = 1").withColumn("Rank", F.col("Rank") + 10).drop("l_orderkey"), "update_weekly_chart_0.csv")
    for _ in range(2):
        warehouse_jobs.weekly_update(spark, landing, warehouse, codes, RUN_TIME)

    def rows(name, key, text, number):
        columns = [F.lit(name).alias("table"), F.col(key).alias("id"), text.alias("name"), F.col(number).cast("double").alias("number")]
        return warehouse.read(name).select(*columns)

    chart_text = F.concat_ws(" ", F.col("week_end_date").cast("string"), "domestic_gross", "domestic_theaters_count")
    return (
        rows("movie", "movie_id", F.col("title"), "tmdb_vote_count")
        .union(rows("people", "people_id", F.col("name"), "tmdb_popularity"))
        .union(rows("video_stats", "movie_id", F.col("video_key_id"), "view_count"))
        .union(rows("collection", "collection_id", F.col("name"), "number_movies_before_2020"))
        .union(rows("weekly_domestic_performance", "movie_id", chart_text, "rank"))
    )


TWO_WEEKS_SQL = cte(
    CHART,
    RAW_CHART,
    """v_once AS (SELECT * REPLACE (CASE WHEN l_orderkey % 2 = 1 THEN rank + 10 ELSE rank END AS rank) FROM (
  SELECT * FROM v_raw QUALIFY row_number() OVER (PARTITION BY year, week, release
    ORDER BY rank, gross_text, theaters_text, weeks_text NULLS FIRST, l_orderkey) = 1))""",
    """v_week AS (SELECT c.*, CAST(first_friday + 6 + 7 * (week - 1) AS DATE) AS week_end_date,
         CAST(first_friday + 6 + 7 * (week - 1) - (weeks + 1) * 7 AS DATE) AS likely_release_date
  FROM v_once c JOIN v_first f ON f.year = c.year)""",
    """v_film AS (SELECT *, p_partkey AS movie_id, DATE '1995-01-02' + CAST(p_partkey * 37 % 2400 AS INTEGER) AS release_date FROM part
WHERE p_partkey % 11 <> 0 AND (p_size % 4 = 1 OR (p_size % 4 > 1 AND p_size % 3 = 1)) AND p_partkey % 9 <> 0 AND p_partkey % 10 <> 0)""",
    "v_movie AS (SELECT movie_id, release_date, p_name AS title FROM v_film WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0)",
    RESOLVED.format(source="v_week"),
) + """
SELECT 'movie' AS "table", p_partkey AS id,
       CASE WHEN p_partkey % 5 = 0 THEN 'new ' WHEN p_partkey % 7 = 0 THEN 'late ' ELSE '' END || p_name AS name,
       CAST(CASE WHEN p_partkey % 5 = 0 THEN 1 WHEN p_partkey % 7 = 0 THEN 2 ELSE p_size * 7 END AS DOUBLE) AS number
FROM v_film
UNION ALL
SELECT 'people', c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'third' WHEN c_custkey % 3 = 0 THEN 'first' ELSE c_name END,
       CASE WHEN c_custkey % 10 = 0 THEN 0.5 ELSE c_acctbal END
FROM customer
UNION ALL
SELECT 'video_stats', p_partkey, 't' || p_partkey,
       CAST(CASE WHEN p_partkey % 8 = 0 THEN 3 WHEN p_partkey % 4 = 0 THEN 5 ELSE p_size * 1000 END AS DOUBLE)
FROM part WHERE p_size % 5 >= 2 AND NOT (p_partkey % 14 = 0 AND p_partkey % 5 <> 0)
UNION ALL
SELECT 'collection', c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'new ' END || c_name, CASE WHEN c_custkey % 3 = 0 THEN 1.0 ELSE 0.0 END
FROM customer
UNION ALL
SELECT 'weekly_domestic_performance', movie_id, concat_ws(' ', CAST(week_end_date AS VARCHAR), gross, theaters), CAST(rank AS DOUBLE)
FROM w WHERE rn = 1 AND diff <= 50"""

C = "(SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey % 5 AS BIGINT) AS region FROM customer)"

QUERIES = {
    "latest_landed_file": Query(latest_landed_file, f"SELECT c_custkey, c_name || ' 1' AS c_name, region FROM {C} WHERE region >= 1"),
    "files_of_a_window": Query(files_of_a_window, f"SELECT c_custkey, c_name || ' 2' AS c_name, region FROM {C} WHERE region >= 2"),
    "last_landed_row": Query(last_landed_row, f"SELECT c_custkey, c_name || ' ' || least(2, region) AS c_name, region FROM {C}"),
    "json_documents": Query(json_documents, f"SELECT * FROM {C}"),
    "warehouse_csv_load": Query(
        warehouse_csv_load, f"""SELECT c_custkey, 'a "b"|' || c_name AS c_name, replace(c_name, '#', '+') AS words FROM {C}"""
    ),
    "warehouse_append_partial_columns": Query(
        warehouse_append_partial_columns, f"SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name, region FROM {C}"
    ),
    "warehouse_steps": Query(
        warehouse_steps,
        f"""WITH c AS (SELECT count(*) AS n, count(*) FILTER (region = 1) AS m FROM {C})
SELECT 0 AS step, n FROM c UNION ALL SELECT 1, n FROM c UNION ALL SELECT 2, 0 UNION ALL SELECT 3, m FROM c UNION ALL SELECT 4, 0""",
    ),
    "video_key_worklist": Query(
        video_key_worklist,
        """SELECT unnest((['f' || p_partkey, 't' || p_partkey, 'c' || p_partkey, 's' || p_partkey])[1:p_size % 5]) AS key
FROM part WHERE p_partkey % 2 = 0""",
    ),
    "video_key_worklist_all_windows": Query(
        video_key_worklist_all_windows,
        """SELECT unnest((['f' || p_partkey, 't' || p_partkey, 'c' || p_partkey, 's' || p_partkey])[1:p_size % 5]) AS key
FROM part""",
    ),
    "incremental_upsert_out_of_order": Query(
        incremental_upsert_out_of_order,
        """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "weekly_update_two_weeks": Query(weekly_update_two_weeks, TWO_WEEKS_SQL),
}
