"""Film-shaped views over the test tables, as DataFrames and as SQL common table expressions.

Money is summed exactly on both sides, as whole cents here and as decimals in SQL, so that the order of summation cannot
show in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrid.functions import dates, text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def ship_day() -> Column:
    return F.col("l_shipdate").cast("date")


def film_columns() -> dict[str, Column]:
    """Columns of a film that come from its own row of ``part``."""
    key, size = F.col("p_partkey"), F.col("p_size")
    budget = F.when(size % 5 == 0, F.lit(0.0)).otherwise(cents("p_retailprice") * size / 100)
    return {
        "movie_id": key,
        "title": F.col("p_name"),
        "genres": F.split("p_name", " "),
        "budget": budget,
        "release_date": F.date_add(F.lit("1995-01-02").cast("date"), (key * 37 % 2400).cast("int")),
        "runtime": (size + 60).cast("double"),
        "is_adult": F.when(size % 2 == 0, 1).otherwise(0),
        "is_adaptation": F.when(size % 3 == 0, 1).otherwise(0),
        "collection_id": F.nullif(key % 26, F.lit(25)),
        "director_id": key % 100,
        "producer_id": F.when(key % 7 != 0, key % 90),
        "tmdb_popularity": F.col("p_retailprice") / 10,
        "tmdb_vote_average": (size % 10) + F.lit(0.5),
    }


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` with each part's sales as revenue and its suppliers as cast."""
    sales = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(
            (F.sum(cents("l_extendedprice") * (100 - cents("l_discount"))) / 10000).alias("revenue"),
            F.min("l_suppkey").alias("cast1_id"),
            F.max("l_suppkey").alias("cast2_id"),
            F.count("*").alias("tmdb_vote_count"),
        )
    )
    films = table(spark, folder, "part").select(*[column.alias(name) for name, column in film_columns().items()])
    return films.join(sales.withColumnRenamed("l_partkey", "movie_id"), "movie_id", "left")


MOVIES = """
v_sales AS (
  SELECT l_partkey,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
         min(l_suppkey) AS cast1_id, max(l_suppkey) AS cast2_id, count(*) AS tmdb_vote_count
  FROM lineitem GROUP BY l_partkey),
v_movie AS (
  SELECT p_partkey AS movie_id, p_name AS title, string_split(p_name, ' ') AS genres,
         CASE WHEN p_size % 5 = 0 THEN 0.0
              ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) * p_size AS DOUBLE) END AS budget,
         DATE '1995-01-02' + CAST(p_partkey * 37 % 2400 AS INTEGER) AS release_date,
         CAST(p_size + 60 AS DOUBLE) AS runtime,
         CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS is_adult,
         CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS is_adaptation,
         nullif(p_partkey % 26, 25) AS collection_id,
         p_partkey % 100 AS director_id,
         CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 90 END AS producer_id,
         p_retailprice / 10 AS tmdb_popularity,
         CAST(p_size % 10 AS DOUBLE) + 0.5 AS tmdb_vote_average,
         revenue, cast1_id, cast2_id, tmdb_vote_count
  FROM part LEFT JOIN v_sales ON l_partkey = p_partkey)
"""


def weekly(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per part and chart week (closed by a Thursday)."""
    lines = table(spark, folder, "lineitem").withColumn("cents", cents("l_extendedprice"))
    return (
        lines.groupBy(F.col("l_partkey").alias("movie_id"), dates.week_ending_on(ship_day(), 5).alias("week_end_date"))
        .agg(
            F.min("l_linenumber").cast("bigint").alias("rank"),
            F.expr("sum(cents) div 100").alias("domestic_gross"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("domestic_theaters_count"),
        )
    )


WEEKLY = """
v_weekly AS (
  SELECT l_partkey AS movie_id,
         CAST(l_shipdate AS DATE) + CAST((11 - dayofweek(CAST(l_shipdate AS DATE))) % 7 AS INTEGER) AS week_end_date,
         CAST(min(l_linenumber) AS BIGINT) AS rank,
         CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(12,2)))) AS BIGINT) AS domestic_gross,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS domestic_theaters_count
  FROM lineitem GROUP BY 1, 2)
"""

SUNDAY = "CAST(week_end_date + CAST((7 - dayofweek(week_end_date)) % 7 AS INTEGER) AS DATE)"


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as people with a department."""
    department = (
        F.when(F.col("s_nationkey") % 3 == 0, "Acting").when(F.col("s_nationkey") % 3 == 1, "Directing").otherwise("Production")
    )
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("people_id"),
        F.col("s_name").alias("name"),
        department.alias("known_for"),
        F.col("s_acctbal").alias("tmdb_popularity"),
    )


PEOPLE = """
v_people AS (
  SELECT s_suppkey AS people_id, s_name AS name,
         CASE s_nationkey % 3 WHEN 0 THEN 'Acting' WHEN 1 THEN 'Directing' ELSE 'Production' END AS known_for,
         s_acctbal AS tmdb_popularity
  FROM supplier)
"""


def collections(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("collection_id"),
        F.col("n_name").alias("name"),
        (F.col("n_regionkey") * 1.5).alias("avg_popularity_before_2020"),
    )


COLLECTIONS = """
v_collection AS (
  SELECT CAST(n_nationkey AS BIGINT) AS collection_id, n_name AS name, CAST(n_regionkey * 1.5 AS DOUBLE) AS avg_popularity_before_2020
  FROM nation)
"""


def video_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Events per user and type as trailer counts."""
    clicks = F.from_json("props", "k BIGINT")["k"]
    return (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("movie_id"), F.col("event_type").alias("video_key_id"))
        .agg(
            F.count("*").alias("view_count"),
            F.coalesce(F.sum(clicks), F.lit(0)).cast("bigint").alias("like_count"),
            F.coalesce(F.floor(F.sum(F.col("value").cast("decimal(18,2)"))), F.lit(0)).cast("bigint").alias("comment_count"),
        )
    )


VIDEO_STATS = """
v_video AS (
  SELECT user_id AS movie_id, event_type AS video_key_id, count(*) AS view_count,
         CAST(coalesce(sum(CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS BIGINT)), 0) AS BIGINT) AS like_count,
         CAST(coalesce(floor(sum(CAST(value AS DECIMAL(18,2)))), 0) AS BIGINT) AS comment_count
  FROM events GROUP BY 1, 2)
"""


def chart(spark: SparkSession, folder: str) -> DataFrame:
    """One raw chart row per line item, with the text forms charts use."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, folder, "lineitem").join(parts, "l_partkey")
    name, kind = F.col("p_name"), F.col("l_orderkey") % 7
    release = (
        F.when(kind == 0, F.concat(name, F.lit(" 20th Anniversary")))
        .when(kind == 1, F.concat(F.lit("  "), F.upper(text.remove(name, "#")), F.lit("? ")))
        .when(kind == 2, F.concat(name, F.lit(" (2021 Re-release)")))
        .when(kind == 3, F.concat(name, F.lit(" 4K Restoration")))
        .when(kind == 4, F.concat(F.lit(" "), F.replace(F.initcap(name), F.lit(" "), F.lit(" - ")), F.lit("  ")))
        .otherwise(name)
    )
    theaters = F.when(F.col("l_quantity") < 5, "-").otherwise(F.format_number(F.col("l_quantity") * 100, 0))
    taxed = F.round(F.col("l_tax") * 100).cast("int")
    weeks = F.when(taxed == 0, "-").when(taxed != 8, taxed.cast("string"))
    row = F.struct(
        F.year(ship_day()).alias("year"),
        F.least(F.lit(52), F.floor((F.dayofyear(ship_day()) - 1) / 7).cast("int") + 1).alias("week"),
        release.alias("Release"),
        F.col("l_linenumber").cast("bigint").alias("Rank"),
        F.concat(F.lit("$"), F.format_number(F.floor("l_extendedprice"), 0)).alias("Gross"),
        theaters.alias("Theaters"),
        weeks.alias("Weeks"),
        "l_orderkey",
    )
    # ``inline`` keeps Spark from making the texts anew for every later filter, as reading a file would
    return lines.select(F.inline(F.array(row)))


# The parsed chart, computed from the numbers rather than from the text forms.
CHART = """
v_chart AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(least(52, (dayofyear(CAST(l_shipdate AS DATE)) - 1) // 7 + 1) AS INTEGER) AS week,
         CASE l_orderkey % 7 WHEN 1 THEN lower(p_name) || ' ' ELSE lower(p_name) END AS title_cleaned,
         CAST(l_linenumber AS BIGINT) AS rank,
         CAST(floor(l_extendedprice) AS BIGINT) AS gross,
         CASE WHEN l_quantity < 5 THEN 0 ELSE CAST(l_quantity * 100 AS BIGINT) END AS theaters,
         CASE WHEN CAST(round(l_tax * 100) AS INTEGER) IN (0, 8) THEN 0
              ELSE CAST(round(l_tax * 100) AS INTEGER) END AS weeks,
         l_orderkey
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE l_orderkey % 7 NOT IN (0, 2, 3)),
v_first AS (
  SELECT y AS year,
         DATE '1970-01-02' + CAST(7 * ceil(date_diff('day', DATE '1970-01-02', make_date(y, 1, 1)) / 7.0) AS INTEGER) AS first_friday
  FROM (SELECT CAST(unnest(range(1900, 2101)) AS INTEGER) AS y)),
v_dated AS (
  SELECT c.*, CAST(first_friday + 6 + 7 * (week - 1) AS DATE) AS week_end_date,
         CAST(first_friday + 6 + 7 * (week - 1) - (weeks + 1) * 7 AS DATE) AS likely_release_date
  FROM v_chart c JOIN v_first f ON f.year = c.year)
"""


def languages(spark: SparkSession, folder: str) -> DataFrame:
    """The languages of the documents, as a code table."""
    codes = table(spark, folder, "documents").select(F.col("lang").alias("iso_639_1")).distinct()
    return codes.select("iso_639_1", F.upper("iso_639_1").alias("english_name"))


def cte(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"
