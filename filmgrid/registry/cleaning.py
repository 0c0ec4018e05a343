"""Cleaning jobs over raw records derived from the test tables, as JSON text where the sources are JSON."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.operators import dedup, resolve
from filmgrid.plans import cleaning
from filmgrid.registry import Query
from filmgrid.registry.views import (
    CHART,
    MOVIES,
    chart,
    cte,
    WEEKLY,
    languages,
    movies,
    table,
)
from filmgrid.registry.views import weekly as weekly_view
from filmgrid.session import written
from filmgrid.sources import readers


def _first(items, n):
    return F.slice(F.array(*items), F.lit(1), n)


def _parse(df, value, schema):
    """Through JSON text and back, as landed records come.

    ``inline`` keeps Spark from pushing later filters, and with them the parsing, down to where the text is made.
    """
    return df.select(F.inline(F.array(F.from_json(F.to_json(value), schema, {"mode": "FAILFAST"}))))


def film_details(spark, folder):
    """Film details derived from ``part``, with the gaps real records have."""
    key, size = F.col("p_partkey"), F.col("p_size")
    release_type = lambda value: F.struct(value.cast("int").alias("type"))
    country = lambda *types: F.struct(F.array(*[release_type(t) for t in types]).alias("release_dates"))
    none = F.lit(None).cast("struct<release_dates:array<struct<type:int>>>")
    lost = F.struct(F.lit(None).cast("array<struct<type:int>>").alias("release_dates"))
    shown = (
        F.when(key % 11 == 0, F.lit(None))
        .when(size % 4 == 0, F.array(none, country(F.lit(1), F.lit(4))))
        .when(size % 4 == 1, F.array(lost, country(F.lit(3))))
        .otherwise(F.array(country(F.lit(1)), country(F.lit(2), size % 3 + 2)))
    )
    person = lambda number: F.struct((key * 10 + number).alias("id"))
    crew = lambda number, job: F.struct((key * 10 + number).alias("id"), F.lit(job).alias("job"))
    video = lambda mark, kind: F.struct(
        F.concat(F.lit(mark), key).alias("key"),
        F.lit("YouTube").alias("site"),
        F.lit(kind).alias("type"),
        F.lit("2020-01-01T00:00:00Z").alias("published_at"),
    )
    word = lambda value: F.struct(F.lit(value).alias("name"))
    languages_by_size = F.element_at(F.array(F.lit("en"), F.lit("fr"), F.lit("de"), F.lit("xx")), size % 4 + 1)
    value = F.struct(
        key.alias("id"),
        F.col("p_name").alias("title"),
        F.when(size % 3 == 0, True).when(size % 3 == 1, False).alias("adult"),
        (F.col("p_retailprice") / 10).alias("popularity"),
        (size / 5).alias("vote_average"),
        (size * 7).cast("bigint").alias("vote_count"),
        (size * 1000).cast("double").alias("budget"),
        F.concat(F.lit("tt"), key).alias("imdb_id"),
        languages_by_size.alias("original_language"),
        F.when(size % 6 == 0, "").otherwise(F.date_add(F.lit("2000-01-01").cast("date"), size).cast("string")).alias("release_date"),
        F.when(key % 9 == 0, 0.0).when(key % 10 != 0, F.col("p_retailprice") * 1000).alias("revenue"),
        (size + 60).cast("double").alias("runtime"),
        F.lit("Released").alias("status"),
        F.when(key % 4 == 0, F.struct((key % 100).alias("id"))).alias("belongs_to_collection"),
        _first([person(n) for n in (1, 2, 3)], size % 4).alias("production_companies"),
        F.transform(F.when(size % 8 == 0, F.array().cast("array<string>")).otherwise(F.split("p_name", " ")),
                    lambda name: F.struct(name.alias("name"))).alias("genres"),
        F.struct(
            _first([person(n) for n in (1, 2, 3)], size % 4).alias("cast"),
            _first([crew(1, "Director"), crew(2, "Producer"), crew(3, "Director"), crew(4, "Editor"), crew(5, "Producer")], size % 6).alias("crew"),
        ).alias("credits"),
        F.struct(_first([video("f", "Featurette"), video("t", "Trailer"), video("c", "Clip"), video("s", "site")], size % 5).alias("results")).alias("videos"),
        F.struct(_first([word("space"), word("Based On Novel"), word("sequel")], size % 4).alias("keywords")).alias("keywords"),
        F.when(shown.isNotNull(), F.struct(shown.alias("results"))).alias("release_dates"),
    )
    return _parse(table(spark, folder, "part"), value, schemas.FILM_DETAILS)


def clean_movies(spark, folder):
    films = cleaning.clean_movies(film_details(spark, folder), languages(spark, folder))
    return films.withColumns({c: F.array_join(c, "|") for c in ("genres", "video_key_id")})


CLEAN_MOVIES_SQL = """
SELECT p_partkey AS movie_id, p_retailprice * 1000 AS revenue, CAST(p_size * 1000 AS DOUBLE) AS budget,
       'tt' || p_partkey AS imdb_id, p_name AS title,
       CASE WHEN p_size % 4 < 3 THEN (['EN', 'FR', 'DE'])[p_size % 4 + 1] END AS original_language,
       CASE WHEN p_size % 6 <> 0 THEN DATE '2000-01-01' + p_size END AS release_date,
       CASE WHEN p_size % 8 = 0 THEN '' ELSE replace(p_name, ' ', '|') END AS genres,
       CAST(p_size + 60 AS DOUBLE) AS runtime, 'Released' AS status, CAST(p_size % 4 AS BIGINT) AS production_companies_count,
       CASE WHEN p_size % 3 = 1 THEN 0 ELSE 1 END AS is_adult, CASE WHEN p_size % 4 >= 2 THEN 1 ELSE 0 END AS is_adaptation,
       CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 100 END AS collection_id,
       CASE WHEN p_size % 4 >= 1 THEN p_partkey * 10 + 1 END AS cast1_id,
       CASE WHEN p_size % 4 >= 2 THEN p_partkey * 10 + 2 END AS cast2_id,
       CASE WHEN p_size % 6 >= 3 THEN p_partkey * 10 + 3 WHEN p_size % 6 >= 1 THEN p_partkey * 10 + 1 END AS director_id,
       CASE WHEN p_size % 6 = 5 THEN p_partkey * 10 + 5 WHEN p_size % 6 >= 2 THEN p_partkey * 10 + 2 END AS producer_id,
       p_retailprice / 10 AS tmdb_popularity, p_size / 5 AS tmdb_vote_average, CAST(p_size * 7 AS BIGINT) AS tmdb_vote_count,
       CASE WHEN p_size % 5 < 2 THEN '' WHEN p_size % 5 < 4 THEN 't' || p_partkey
            ELSE 't' || p_partkey || '|s' || p_partkey END AS video_key_id
FROM part
WHERE p_partkey % 11 <> 0 AND (p_size % 4 = 1 OR (p_size % 4 > 1 AND p_size % 3 = 1))
  AND p_partkey % 9 <> 0 AND p_partkey % 10 <> 0"""


def people_details(spark, folder):
    """People derived from ``customer``."""
    key = F.col("c_custkey")
    credit = lambda n: F.struct((key + n).alias("id"))
    value = F.struct(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.when(key % 5 == 0, "").when(key % 7 != 0, F.date_add(F.lit("1960-01-01").cast("date"), key.cast("int")).cast("string")).alias("birthday"),
        F.when(key % 3 != 0, key % 3).alias("gender"),
        F.col("c_acctbal").alias("popularity"),
        F.col("c_mktsegment").alias("known_for_department"),
        F.when(
            key % 6 != 0,
            F.struct(
                _first([credit(1), credit(2), credit(3)], (key % 4).cast("int")).alias("cast"),
                F.when(key % 8 != 0, _first([credit(4), credit(5)], (key % 3).cast("int"))).alias("crew"),
            ),
        ).alias("movie_credits"),
    )
    return _parse(table(spark, folder, "customer"), value, schemas.PEOPLE_DETAILS)


def clean_people(spark, folder):
    return cleaning.clean_people(people_details(spark, folder))


def clean_people_changes(spark, folder):
    """One change record per customer; later changes to a field win."""
    key = F.col("c_custkey")
    item = lambda action, value: F.struct(F.lit(action).alias("action"), value.alias("value"))
    change = lambda field, *items: F.struct(F.lit(field).alias("key"), F.array(*items).alias("items"))
    value = F.struct(
        key.alias("people_id"),
        F.slice(
            F.array(
                change("biography", item("updated", F.lit("text"))),
                change("name", item("added", F.lit("old")), item("updated", F.col("c_name"))),
                change("gender", item("updated", F.lit("2")), item("deleted", F.lit("3"))),
                change("birthday", item("updated", F.when(key % 4 == 0, "").otherwise(F.lit("1970-05-17")))),
                change("name", item("updated", F.upper("c_name"))),
                change("popularity", item("created", F.lit("1.0"))),
                change("popularity", item("created", F.lit("1.0")), item("updated", F.col("c_acctbal").cast("string"))),
                change("gender", item("updated", F.lit("1"))),
            ),
            F.lit(1),
            (key % 9).cast("int"),
        ).alias("changes"),
    )
    return cleaning.clean_people_changes(_parse(table(spark, folder, "customer"), value, schemas.PEOPLE_CHANGES))


KEYS = {"view": "name", "signup": "birthday", "purchase": "popularity", "click": "gender", "error": "biography"}


def changes_to_columns(spark, folder):
    """The event log read as single edits of people's fields."""
    kind, event = F.col("event_type"), F.col("event_id")
    field = F.lit(None).cast("string")
    for event_type, name in KEYS.items():
        field = F.when(kind == event_type, name).otherwise(field)
    value = (
        F.when(kind == "signup", F.date_add(F.lit("1970-01-01").cast("date"), (event % 9000).cast("int")).cast("string"))
        .when(kind == "purchase", F.col("value").cast("string"))
        .when(kind == "click", (event % 3).cast("string"))
        .otherwise(F.concat(F.lit("name "), event))
    )
    log = table(spark, folder, "events").select(
        F.col("user_id").alias("people_id"),
        field.alias("key"),
        F.when(event % 4 == 0, "deleted").otherwise("updated").alias("action"),
        value.alias("value"),
        "ts",
        "event_id",
    )
    return cleaning.fold_people_changes(log, ["ts", "event_id"])


def clean_collections(spark, folder):
    """Two keyed JSON files; a key in both counts as the second file has it."""
    key = F.col("c_custkey")
    part = lambda kind, day, popularity: F.struct(
        F.lit(kind).alias("media_type"), F.lit(day).alias("release_date"), (key + popularity).cast("double").alias("popularity")
    )
    parts = _first(
        [part("movie", "2021-01-01", 1), part("movie", "2019-12-31", 2), part("tv", "2001-01-01", 3), part("movie", "", 4), part("movie", "1999-07-01", 5)],
        (key % 6).cast("int"),
    )

    def file(name, title):
        record = F.struct(key.alias("id"), title.alias("name"), parts.alias("parts"))
        text = F.to_json(F.map_from_arrays(F.array(key.cast("string")), F.array(record)))
        return table(spark, folder, "customer").select(F.lit(name).alias("_file"), text.alias("value"), "c_nationkey")

    first = file("raw_collection_data_1.json", F.col("c_name"))
    second = file("raw_collection_data_2.json", F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))).where("c_nationkey % 2 = 0")
    raw = readers.entries(first.unionByName(second), "value", schemas.COLLECTION_DETAILS, "_file")
    return cleaning.clean_collections(raw)


def clean_video_stats(spark, folder):
    key, size = F.col("p_partkey"), F.col("p_size")
    video = lambda name, site, kind: F.struct(
        name.alias("key"), F.lit(site).alias("site"), F.lit(kind).alias("type"), F.lit("2020-01-01").alias("published_at")
    )
    mine, shared = key.cast("string"), F.concat(F.lit("k"), key % 500)
    part = table(spark, folder, "part")
    raw = part.select(
        key.alias("id"),
        F.struct(F.array(video(mine, "YouTube", "Trailer"), video(shared, "Vimeo", "Clip"), video(mine, "YouTube", "Trailer")).alias("results")).alias("videos"),
    )
    youtube = part.where("p_size % 3 <> 0").select(
        mine.alias("id"),
        (size * 1000).cast("double").alias("viewCount"),
        F.when(size % 2 == 0, size.cast("double")).alias("likeCount"),
        F.lit(None).cast("double").alias("commentCount"),
    )
    vimeo = part.select(
        shared.alias("video_key_id"),
        (key % 500 * 10).cast("double").alias("view_count"),
        F.lit(1.0).alias("like_count"),
        F.lit(None).cast("double").alias("comment_count"),
    )
    return cleaning.clean_video_stats(cleaning.video_details(raw), cleaning.video_statistics(youtube, vimeo))


def weekly_chart_parsed(spark, folder):
    return cleaning.clean_weekly_chart(chart(spark, folder).drop("l_orderkey"))


def weekly_chart_legacy_calendar(spark, folder):
    return cleaning.clean_weekly_chart(chart(spark, folder).drop("l_orderkey"), legacy_year=True).select(
        "year", "week", "title_cleaned", "rank", "week_end_date"
    )


def weekly_chart_all_years(spark, folder):
    """Weeks 0 to 53 of the years 2020 to 2031: kept rows with the week's end, and rejects with their reason."""
    key = F.col("o_orderkey")
    raw = table(spark, folder, "orders").select(
        F.when(key % 97 != 0, 2020 + F.col("o_custkey") % 12).cast("int").alias("year"),
        (key % 54).cast("int").alias("week"),
        key.cast("string").alias("Release"),
        key.alias("Rank"),
        F.lit("$1").alias("Gross"),
        F.lit("1").alias("Theaters"),
        F.lit("1").alias("Weeks"),
    )
    kept = cleaning.clean_weekly_chart(raw).select("year", "week", "rank", "week_end_date", F.lit(None).cast("string").alias("reason"))
    rejects = cleaning.chart_rejects(raw).select("year", "week", F.col("Rank").alias("rank"), F.lit(None).cast("date").alias("week_end_date"), "reason")
    return kept.unionByName(rejects)


def lower_case_columns(spark, folder):
    raw = chart(spark, folder).select("Release", "Rank", F.col("Gross").alias("GROSS"), "l_orderkey")
    return cleaning.lower_case_names(raw)


def chart_in_order(spark, folder):
    """All rows, sorted as performance is stored."""
    weekly = weekly_view(spark, folder).select("week_end_date", "rank", "movie_id")
    return cleaning.in_chart_order(weekly)


def chart_in_order_positions(spark, folder):
    """All rows with the place that the sort gives them: rows of earlier tasks, then the place in the task."""
    weekly = weekly_view(spark, folder).select("week_end_date", "rank", "movie_id")
    ordered = cleaning.in_chart_order(weekly).select("*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("row"))
    rows = written(ordered, "chart-in-order").withColumn("row", F.col("row").bitwiseAND(F.lit((1 << 33) - 1)))
    # one number for each task of the sort
    counts = sorted(tuple(r) for r in rows.groupBy("task").count().collect())
    before = itertools.accumulate([0, *[n for _, n in counts]])
    offsets = spark.createDataFrame([(task, start) for (task, _), start in zip(counts, before)], "task int, offset long")
    return rows.join(offsets, "task").select("week_end_date", "rank", "movie_id", (F.col("offset") + F.col("row")).alias("position"))


def weekly_performance(spark, folder):
    return cleaning.weekly_performance(chart(spark, folder), movies(spark, folder))


def nearest_title_match(spark, folder):
    """Chart titles and dates with the film they mean, without the cut-off."""
    rows = cleaning.clean_weekly_chart(chart(spark, folder))
    wanted = rows.select("title_cleaned", F.col("likely_release_date").alias("day"))
    return resolve.nearest_films(wanted, cleaning.titled_films(movies(spark, folder)))


RESOLVED = """
f AS (SELECT movie_id, release_date, lower(title) AS title_cleaned FROM v_movie),
p AS (SELECT d.*, movie_id, abs(date_diff('day', release_date, likely_release_date)) AS diff
      FROM {source} d JOIN f USING (title_cleaned)),
w AS (SELECT *, row_number() OVER (PARTITION BY title_cleaned, week_end_date
                                   ORDER BY diff, movie_id, rank, gross, theaters) AS rn FROM p)"""
RESOLVED_ROWS = """
SELECT week_end_date, movie_id, rank, gross AS domestic_gross, theaters AS domestic_theaters_count
FROM w WHERE rn = 1 AND diff <= 50"""


def _chart_files(spark, folder):
    """Chart rows of even orders as the initial load, all of them again, with new numbers, as an update."""
    day = F.lit("2024-01-01").cast("timestamp")
    rows = chart(spark, folder)
    initial = rows.withColumns({"_file": F.lit("weekly_chart_1.csv"), "_landed": day}).drop("l_orderkey")
    updated = rows.where("l_orderkey % 2 = 1").withColumns(
        {"_file": F.concat(F.lit("update_weekly_chart_"), F.col("l_orderkey") % 3), "_landed": day, "Rank": F.col("Rank") + 10}
    )
    return initial, updated.drop("l_orderkey")


def weekly_performance_after_updates(spark, folder):
    latest = cleaning.latest_chart(*_chart_files(spark, folder))
    return cleaning.weekly_performance(latest, movies(spark, folder))


def latest_by_key(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    kept = dedup.keep_last(events, ["user_id", "event_type"], ["ts", "event_id"])
    return kept.select("user_id", "event_type", "event_id", "value", "day")


def film_keyed_stats(spark, folder):
    """Trailer counts re-keyed from videos to films."""
    part = table(spark, folder, "part")
    films = part.select(
        F.col("p_partkey").alias("movie_id"),
        _first([F.concat("p_partkey", F.lit("__a")), F.concat(F.lit("k"), F.col("p_partkey") % 500)], F.col("p_size") % 3).alias("video_key_id"),
    )
    stats = clean_video_stats(spark, folder).drop("movie_id", "published_at").distinct().withColumn("movie_id", F.lit(0))
    return cleaning.film_keyed_stats(films, stats)


def latest_statistics(spark, folder):
    """Every event read as a refresh of a user's counts: the last counts per user, be they larger or smaller."""
    clicks = F.from_json("props", "k BIGINT")["k"]
    refreshed = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("video_key_id"),
        F.when(F.col("event_id") % 5 != 0, F.floor(F.col("value") / 10).cast("double")).alias("view_count"),
        clicks.cast("double").alias("like_count"),
        F.col("event_id").cast("double").alias("comment_count"),
        "ts",
    )
    return cleaning.latest_statistics(refreshed, ["ts"]).drop("ts")


# the chart as rows with the raw title, to follow the keep-last step
RAW_CHART = """
v_raw AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(least(52, (dayofyear(CAST(l_shipdate AS DATE)) - 1) // 7 + 1) AS INTEGER) AS week,
         CASE l_orderkey % 7 WHEN 1 THEN 'u' WHEN 4 THEN 'i' ELSE 'p' END || lower(p_name) AS release,
         CASE l_orderkey % 7 WHEN 1 THEN lower(p_name) || ' ' ELSE lower(p_name) END AS title_cleaned,
         CAST(l_linenumber AS BIGINT) AS rank,
         CAST(floor(l_extendedprice) AS BIGINT) AS gross, '$' || format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) AS gross_text,
         CASE WHEN l_quantity < 5 THEN 0 ELSE CAST(l_quantity * 100 AS BIGINT) END AS theaters,
         CASE WHEN l_quantity < 5 THEN '-' ELSE format('{:,}', CAST(l_quantity * 100 AS BIGINT)) END AS theaters_text,
         CASE WHEN CAST(round(l_tax * 100) AS INTEGER) IN (0, 8) THEN 0 ELSE CAST(round(l_tax * 100) AS INTEGER) END AS weeks,
         CASE CAST(round(l_tax * 100) AS INTEGER) WHEN 0 THEN '-' WHEN 8 THEN NULL
              ELSE CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) END AS weeks_text, l_orderkey
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_orderkey % 7 NOT IN (0, 2, 3)),
v_all AS (
  SELECT *, 0 AS src, '' AS file FROM v_raw
  UNION ALL SELECT * REPLACE (rank + 10 AS rank), 1, CAST(l_orderkey % 3 AS VARCHAR) FROM v_raw WHERE l_orderkey % 2 = 1),
v_kept AS (
  SELECT * FROM v_all QUALIFY row_number() OVER (PARTITION BY year, week, release
    ORDER BY src DESC, file DESC, rank DESC, gross_text DESC, theaters_text DESC, weeks_text DESC NULLS LAST) = 1),
v_late AS (
  SELECT c.*, CAST(first_friday + 6 + 7 * (week - 1) AS DATE) AS week_end_date,
         CAST(first_friday + 6 + 7 * (week - 1) - (weeks + 1) * 7 AS DATE) AS likely_release_date
  FROM v_kept c JOIN v_first f ON f.year = c.year)
"""


RAW_RELEASES = """
v_release AS (
  SELECT CASE l_orderkey % 7 WHEN 0 THEN p_name || ' 20th Anniversary' WHEN 1 THEN '  ' || upper(p_name) || '? '
            WHEN 2 THEN p_name || ' (2021 Re-release)' WHEN 3 THEN p_name || ' 4K Restoration'
            WHEN 4 THEN ' ' || array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(p_name, ' ')], ' - ') || '  '
            ELSE p_name END AS release, CAST(l_linenumber AS BIGINT) AS rank,
         '$' || format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) AS gross, l_orderkey
  FROM lineitem JOIN part ON p_partkey = l_partkey)
"""

QUERIES = {
    "weekly_chart_all_years": Query(
        weekly_chart_all_years,
        """WITH r AS (SELECT CASE WHEN o_orderkey % 97 <> 0 THEN CAST(2020 + o_custkey % 12 AS INTEGER) END AS year,
                  CAST(o_orderkey % 54 AS INTEGER) AS week, o_orderkey AS rank FROM orders),
f AS (SELECT *, DATE '1970-01-02' + CAST(7 * ceil(date_diff('day', DATE '1970-01-02', make_date(year, 1, 1)) / 7.0) AS INTEGER) AS friday FROM r),
p AS (SELECT *, CASE WHEN year IS NULL THEN 'no year or week'
                     WHEN week < 1 OR week > date_diff('day', friday, make_date(year, 12, 31)) // 7 + 1 THEN 'no such week in the year' END AS reason FROM f)
SELECT year, week, rank, CASE WHEN reason IS NULL THEN CAST(friday + 6 + 7 * (week - 1) AS DATE) END AS week_end_date, reason FROM p""",
    ),
    "lower_case_columns": Query(
        lower_case_columns,
        cte(RAW_RELEASES) + "SELECT release, rank, gross, l_orderkey FROM v_release",
    ),
    "chart_in_order": Query(
        chart_in_order, cte(WEEKLY) + "SELECT week_end_date, rank, movie_id FROM v_weekly ORDER BY week_end_date, rank, movie_id"
    ),
    "chart_in_order_positions": Query(
        chart_in_order_positions,
        cte(WEEKLY) + """SELECT week_end_date, rank, movie_id,
  row_number() OVER (ORDER BY week_end_date, rank, movie_id) - 1 AS position FROM v_weekly""",
    ),
    "clean_movies": Query(clean_movies, CLEAN_MOVIES_SQL),
    "clean_people": Query(
        clean_people,
        """SELECT c_custkey AS people_id, c_name AS name,
       CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN DATE '1960-01-01' + CAST(c_custkey AS INTEGER) END AS birthday,
       CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 3 END AS gender, c_acctbal AS tmdb_popularity, c_mktsegment AS known_for,
       CASE WHEN c_custkey % 6 <> 0 THEN c_custkey % 4 ELSE 0 END AS total_number_cast_credits,
       CASE WHEN c_custkey % 6 <> 0 AND c_custkey % 8 <> 0 THEN c_custkey % 3 ELSE 0 END AS total_number_crew_credits
FROM customer""",
    ),
    "clean_people_changes": Query(
        clean_people_changes,
        """WITH c AS (SELECT *, c_custkey % 9 AS n FROM customer)
SELECT c_custkey AS people_id, CASE WHEN n >= 5 THEN upper(c_name) ELSE c_name END AS name,
       CASE WHEN n >= 4 AND c_custkey % 4 <> 0 THEN DATE '1970-05-17' END AS birthday,
       CASE WHEN n >= 8 THEN CAST(1 AS BIGINT) END AS gender, CASE WHEN n >= 7 THEN c_acctbal END AS tmdb_popularity,
       CAST(NULL AS VARCHAR) AS known_for
FROM c WHERE n >= 2""",
    ),
    "changes_to_columns": Query(
        changes_to_columns,
        """WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
           FROM events WHERE event_id % 4 <> 0 AND event_type IN ('view', 'signup', 'purchase', 'click'))
SELECT user_id AS people_id, max(CASE WHEN event_type = 'view' THEN 'name ' || event_id END) AS name,
       max(CASE WHEN event_type = 'signup' THEN DATE '1970-01-01' + CAST(event_id % 9000 AS INTEGER) END) AS birthday,
       max(CASE WHEN event_type = 'click' THEN event_id % 3 END) AS gender,
       max(CASE WHEN event_type = 'purchase' THEN value END) AS tmdb_popularity, CAST(NULL AS VARCHAR) AS known_for
FROM e WHERE rn = 1 GROUP BY 1""",
    ),
    "clean_collections": Query(
        clean_collections,
        """SELECT c_custkey AS collection_id, CASE WHEN c_nationkey % 2 = 0 THEN lower(c_name) ELSE c_name END AS name,
       CAST(CASE c_custkey % 6 WHEN 5 THEN 2 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE 1 END AS BIGINT) AS number_movies_before_2020,
       CASE c_custkey % 6 WHEN 5 THEN (c_custkey * 2.0 + 7) / 2 WHEN 0 THEN NULL WHEN 1 THEN NULL
            ELSE CAST(c_custkey + 2 AS DOUBLE) END AS avg_popularity_before_2020
FROM customer""",
    ),
    "clean_video_stats": Query(
        clean_video_stats,
        """SELECT p_partkey AS movie_id, CAST(p_partkey AS VARCHAR) AS video_key_id, 'YouTube' AS video_site, 'Trailer' AS video_type,
       '2020-01-01' AS published_at, CAST(p_size * 1000 AS BIGINT) AS view_count,
       CAST(CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END AS BIGINT) AS like_count, CAST(0 AS BIGINT) AS comment_count
FROM part WHERE p_size % 3 <> 0
UNION ALL SELECT p_partkey, 'k' || p_partkey % 500, 'Vimeo', 'Clip', '2020-01-01', p_partkey % 500 * 10, 1, 0 FROM part""",
    ),
    "weekly_chart_parsed": Query(
        weekly_chart_parsed,
        cte(CHART)
        + """SELECT year, week, title_cleaned, rank, gross, theaters, weeks, week_end_date, likely_release_date
FROM v_dated""",
    ),
    "weekly_chart_legacy_calendar": Query(
        weekly_chart_legacy_calendar,
        cte(CHART, """
cal AS (SELECT year(first_friday + 6 + 7 * (k - 1)) AS y, k, CAST(first_friday + 6 + 7 * (k - 1) AS DATE) AS week_end_date
        FROM (SELECT first_friday, CAST(unnest(range(1, 53)) AS INTEGER) AS k FROM v_first))""")
        + "SELECT year, week, title_cleaned, rank, cal.week_end_date FROM v_chart JOIN cal ON y = year AND k = week",
    ),
    "weekly_performance": Query(
        weekly_performance, cte(MOVIES, CHART, RESOLVED.format(source="v_dated")) + RESOLVED_ROWS
    ),
    "nearest_title_match": Query(
        nearest_title_match,
        cte(MOVIES, CHART, """
f AS (SELECT movie_id, release_date, lower(title) AS title_cleaned FROM v_movie),
d AS (SELECT DISTINCT title_cleaned, likely_release_date AS day FROM v_dated),
p AS (SELECT d.*, movie_id, CAST(abs(date_diff('day', release_date, day)) AS INTEGER) AS days_diff FROM d JOIN f USING (title_cleaned))""")
        + """SELECT title_cleaned, day, days_diff, movie_id FROM p
QUALIFY row_number() OVER (PARTITION BY title_cleaned, day ORDER BY days_diff, movie_id) = 1""",
    ),
    "weekly_performance_after_updates": Query(
        weekly_performance_after_updates,
        cte(MOVIES, CHART, RAW_CHART, RESOLVED.format(source="v_late")) + RESOLVED_ROWS,
    ),
    "latest_by_key": Query(
        latest_by_key,
        """SELECT user_id, event_type, event_id, value, CAST(ts AS DATE) AS day FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "latest_statistics": Query(
        latest_statistics,
        """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS video_key_id,
  CASE WHEN event_id % 5 <> 0 THEN floor(value / 10) ELSE 0.0 END AS view_count,
  coalesce(CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS DOUBLE), 0) AS like_count,
  CAST(event_id AS DOUBLE) AS comment_count, ts FROM events)
SELECT * EXCLUDE (ts) FROM e QUALIFY row_number() OVER (PARTITION BY video_key_id
  ORDER BY ts DESC, view_count DESC, like_count DESC, comment_count DESC) = 1""",
    ),
    "film_keyed_stats": Query(
        film_keyed_stats,
        """SELECT p_partkey AS movie_id, 'YouTube' AS video_site, 'Trailer' AS video_type, CAST(p_size * 1000 AS BIGINT) AS view_count,
       CAST(CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END AS BIGINT) AS like_count, CAST(0 AS BIGINT) AS comment_count
FROM part WHERE p_size % 3 > 0
UNION ALL SELECT p_partkey, 'Vimeo', 'Clip', p_partkey % 500 * 10, 1, 0 FROM part WHERE p_size % 3 > 1""",
    ),
}
