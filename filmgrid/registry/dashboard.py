"""Panels of the dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrid.operators import distribution, profile, reshape
from filmgrid.plans import dashboard
from filmgrid.registry import Query
from filmgrid.registry.views import (
    COLLECTIONS,
    MOVIES,
    PEOPLE,
    SUNDAY,
    VIDEO_STATS,
    WEEKLY,
    collections,
    cte,
    movies,
    people,
    table,
    video_stats,
    weekly,
)


def _genre_money(measure):
    def run(spark, folder):
        return dashboard.genre_money(movies(spark, folder), weekly(spark, folder), measure)

    return run


def _genre_money_sql(measure, value):
    return cte(MOVIES, WEEKLY) + f"""
SELECT g AS genres, {SUNDAY} AS week_end_date,
       CAST(coalesce(sum(CAST({value} AS DECIMAL(24,4))), 0) AS DOUBLE) AS {measure}
FROM v_weekly JOIN (SELECT *, unnest(genres) AS g FROM v_movie WHERE budget > 0) USING (movie_id)
GROUP BY 1, 2"""


def _genre_metric(metric):
    def run(spark, folder):
        return dashboard.genre_popularity(movies(spark, folder), weekly(spark, folder), metric)

    return run


def _genre_metric_sql(metric, value):
    return cte(MOVIES, WEEKLY) + f"""
SELECT g AS genres, {SUNDAY} AS week_end_date, CAST({value} AS BIGINT) AS {metric}
FROM v_weekly JOIN (SELECT *, unnest(genres) AS g FROM v_movie) USING (movie_id)
GROUP BY 1, 2"""


GRID = _genre_money_sql("revenue", "revenue")


def genre_week_grid(spark, folder):
    return dashboard.genre_grid(_genre_money("revenue")(spark, folder), "revenue")


CHOSEN = ["red", "blue", "widget"]


def genre_series_chosen(spark, folder):
    series = _genre_money("profit")(spark, folder)
    return dashboard.genre_series(series, "profit", CHOSEN, (100000.0, 50000000.0))


def genre_series_state(spark, folder):
    return profile.series_state(_genre_metric("tmdb_vote_count")(spark, folder), "tmdb_vote_count")


def genre_value_bounds(spark, folder):
    return distribution.bounds(_genre_money("revenue")(spark, folder), ["revenue"])


def extreme_films(spark, folder):
    return dashboard.top_metrics(movies(spark, folder), video_stats(spark, folder))


def _extreme_sql():
    parts = []
    for metric in ("revenue", "tmdb_vote_average", "view_count"):
        for extreme, order in (("highest", "DESC"), ("lowest", "ASC")):
            parts.append(
                f"(SELECT '{metric}' AS metric, '{extreme}' AS extreme, CAST({metric} AS DOUBLE) AS value, title "
                f"FROM j WHERE {metric} IS NOT NULL ORDER BY {metric} {order}, movie_id, video_key_id LIMIT 1)"
            )
    return cte(MOVIES, VIDEO_STATS, "j AS (SELECT * FROM v_movie JOIN v_video USING (movie_id))") + f"""
SELECT metric, extreme, value, title,
       CASE metric WHEN 'revenue' THEN '$' || format('{{:,.2f}}', value)
                   WHEN 'tmdb_vote_average' THEN format('{{:.1f}}', value)
                   ELSE format('{{:,.0f}}', value) END AS shown
FROM ({" UNION ALL ".join(parts)})"""


def budget_points(spark, folder):
    return dashboard.budget_points(movies(spark, folder), "profit")


def _trend(measure):
    def run(spark, folder):
        line = dashboard.budget_trend(movies(spark, folder), measure)
        return line.select(*[F.round(c, 4).alias(c) for c in ("slope", "intercept", "r2")], "n")

    return run


def _trend_sql(value):
    return cte(MOVIES) + f"""
SELECT round(regr_slope({value}, budget), 4) AS slope, round(regr_intercept({value}, budget), 4) AS intercept,
       round(regr_r2({value}, budget), 4) AS r2, CAST(regr_count({value}, budget) AS BIGINT) AS n
FROM v_movie WHERE budget > 0"""


def _margins(role, per_film=False):
    def run(spark, folder):
        margins = dashboard.profit_margins(movies(spark, folder), people(spark, folder), role, per_film)
        return margins.withColumn("profit_margin", F.round("profit_margin", 6))

    return run


def _margins_sql(role_id, department, per_film=False):
    group = "" if per_film else "DISTINCT"
    return cte(MOVIES, PEOPLE, f"""
m AS (SELECT v.{role_id}, p.name, (revenue - budget) / budget AS margin
      FROM v_movie v JOIN v_people p ON p.people_id = v.{role_id} AND p.known_for = '{department}' WHERE budget > 0),
a AS (SELECT {role_id}, round(avg(margin), 6) AS profit_margin FROM m GROUP BY 1)""") + f"""
SELECT {group} {role_id}, profit_margin, name FROM a JOIN m USING ({role_id})"""


def _collection_revenue(per_film=False, value_range=None):
    def run(spark, folder):
        return dashboard.collection_revenue(movies(spark, folder), collections(spark, folder), value_range, per_film)

    return run


def _collection_sql(per_film=False):
    group = "" if per_film else "DISTINCT"
    return cte(MOVIES, COLLECTIONS, """
m AS (SELECT v.collection_id, c.name, revenue FROM v_movie v JOIN v_collection c USING (collection_id)),
a AS (SELECT collection_id, CAST(coalesce(sum(CAST(revenue AS DECIMAL(24,4))), 0) AS DOUBLE) AS revenue FROM m GROUP BY 1)""") + f"""
SELECT {group} collection_id, a.revenue, name FROM a JOIN m USING (collection_id)"""


RANGES = {"domestic_gross": (1000.0, 90000.0), "international_revenue": (0.0, 3000000.0)}


def domestic_vs_international(spark, folder):
    return dashboard.domestic_and_international(movies(spark, folder), weekly(spark, folder), RANGES)


def domestic_total_vs_international(spark, folder):
    return dashboard.domestic_and_international(movies(spark, folder), weekly(spark, folder), cumulative=True)


def films_with_cast_names(spark, folder):
    films = dashboard.films_with_cast_names(movies(spark, folder), people(spark, folder))
    return films.select("movie_id", "cast1_id", "cast1_name", "cast2_id", "cast2_name")


def actor_avg_revenue(spark, folder):
    actors = dashboard.actor_revenue(movies(spark, folder), people(spark, folder))
    return actors.withColumn("revenue", F.round("revenue", 4))


ROI = "(SELECT *, (revenue - budget) / nullif(budget, 0) AS \"ROI\" FROM v_movie)"
TRIMMED = f"""
r AS {ROI},
q AS (SELECT quantile_cont("ROI", 0.01) AS lo, quantile_cont("ROI", 0.99) AS hi FROM r),
t AS (SELECT movie_id, "ROI" FROM r, q WHERE "ROI" >= lo AND "ROI" <= hi)"""


def film_roi(spark, folder):
    return dashboard.film_roi(movies(spark, folder)).select("movie_id", F.round("ROI", 6).alias("ROI"))


def roi_trimmed(spark, folder):
    return dashboard.roi_trimmed(movies(spark, folder)).select("movie_id", F.round("ROI", 6).alias("ROI"))


def roi_histogram(spark, folder):
    bins = dashboard.roi_histogram(movies(spark, folder))
    return bins.select(F.round("bin_start", 4).alias("bin_start"), F.round("bin_end", 4).alias("bin_end"), "n")


HISTOGRAM_SQL = cte(MOVIES, TRIMMED, """
s AS (SELECT max("ROI") - min("ROI") AS span, pow(10.0, floor(log10((max("ROI") - min("ROI")) / 50))) AS unit FROM t),
p AS (SELECT CASE WHEN span / unit <= 50 THEN unit WHEN span / (unit * 2) <= 50 THEN unit * 2
                  WHEN span / (unit * 5) <= 50 THEN unit * 5 ELSE unit * 10 END AS step FROM s)""") + """
SELECT round(floor("ROI" / step) * step, 4) AS bin_start, round((floor("ROI" / step) + 1) * step, 4) AS bin_end,
       count(*) AS n
FROM t, p GROUP BY 1, 2"""


def roi_density(spark, folder):
    curve = dashboard.roi_density(movies(spark, folder))
    return curve.select(F.round("x", 4).alias("x"), F.round("density", 6).alias("density"))


DENSITY_SQL = cte(MOVIES, TRIMMED, """
d AS (SELECT min("ROI") AS lo, max("ROI") AS hi, count(*) AS n, stddev_samp("ROI") AS sd,
             (quantile_cont("ROI", 0.75) - quantile_cont("ROI", 0.25)) / 1.34 AS h FROM t),
b AS (SELECT *, 1.06 * least(sd, h) * pow(n, -0.2) AS bw FROM d),
g AS (SELECT lo + (hi - lo) * i / 100 AS x, n, bw FROM b, (SELECT unnest(range(0, 101)) AS i))""") + """
SELECT round(x, 4) AS x,
       round(sum(exp(-0.5 * ((x - "ROI") / bw) * ((x - "ROI") / bw)) / (n * bw * sqrt(2 * pi()))), 6) AS density
FROM g, t GROUP BY x"""


def engagement_long(spark, folder):
    return dashboard.engagement(
        movies(spark, folder), video_stats(spark, folder), {"view_count": (5, 1000000), "like_count": (1, 10000000)}
    )


def top5_films(spark, folder):
    return dashboard.top_films(movies(spark, folder))


def planned_films(spark, folder):
    """One planned film per nation: a date and up to two genres taken from the nation's row."""
    nation = table(spark, folder, "nation")
    words = F.when(F.col("n_nationkey") % 5 == 0, F.array().cast("array<string>")).when(
        F.col("n_nationkey") % 2 == 0, F.array(F.lit("red"), F.lit("bolt"))
    ).otherwise(F.array(F.lit("gear"), F.lit("old"), F.lit("gear")))
    return nation.select(
        F.col("n_name").alias("plan_id"),
        F.date_add(F.lit("1995-03-01").cast("date"), (F.col("n_nationkey") * 83).cast("int")).alias("plan_date"),
        words.alias("plan_genres"),
    )


def competitors_window(spark, folder):
    found = dashboard.competitors(movies(spark, folder), planned_films(spark, folder))
    return found.select("plan_id", "movie_id", "title", "revenue", "budget", "release_date")


COMPETITORS_SQL = cte(MOVIES, """
p AS (SELECT n_name AS plan_id, DATE '1995-03-01' + CAST(n_nationkey * 83 AS INTEGER) AS plan_date,
             CASE WHEN n_nationkey % 5 = 0 THEN CAST([] AS VARCHAR[]) WHEN n_nationkey % 2 = 0 THEN ['red', 'bolt']
                  ELSE ['gear', 'old'] END AS wanted FROM nation)""") + """
SELECT plan_id, movie_id, title, revenue, budget, CAST(release_date AS DATE) AS release_date
FROM p JOIN v_movie ON release_date > plan_date - 45 AND release_date < plan_date + 45
WHERE budget > 0 AND (len(wanted) = 0 OR list_has_any(genres, wanted))"""


def competitors_of_one_film(spark, folder):
    found = dashboard.competitors_of_one(movies(spark, folder), "1996-06-15", ["red", "ring"])
    return found.select("movie_id", "title", "revenue", "release_date")


def distinct_genres(spark, folder):
    return dashboard.all_genres(movies(spark, folder))


def name_choices(spark, folder):
    return dashboard.name_choices(collections(spark, folder), ["Others", "None"])


def totals_by_status_wide(spark, folder):
    """Order totals by priority, one column per status."""
    orders = table(spark, folder, "orders")
    sums = orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )
    return reshape.to_wide(sums, "o_orderpriority", "o_orderstatus", "total", ["F", "O", "P"])


QUERIES = {
    "genre_revenue_weekly": Query(_genre_money("revenue"), GRID),
    "genre_profit_weekly": Query(_genre_money("profit"), _genre_money_sql("profit", "(revenue - budget)")),
    "genre_popularity_weekly": Query(
        _genre_metric("tmdb_popularity"),
        _genre_metric_sql("tmdb_popularity", "round_even(avg(CAST(tmdb_popularity AS DECIMAL(24,6))), 0)"),
    ),
    "genre_vote_average_weekly": Query(
        _genre_metric("tmdb_vote_average"),
        _genre_metric_sql("tmdb_vote_average", "round_even(avg(tmdb_vote_average), 0)"),
    ),
    "genre_votes_weekly": Query(
        _genre_metric("tmdb_vote_count"), _genre_metric_sql("tmdb_vote_count", "coalesce(sum(tmdb_vote_count), 0)")
    ),
    "genre_week_grid": Query(
        genre_week_grid,
        f"""WITH s AS ({GRID})
SELECT w.week_end_date, g.genres AS "Genre", s.revenue
FROM (SELECT DISTINCT week_end_date FROM s) w CROSS JOIN (SELECT DISTINCT genres FROM s) g
LEFT JOIN s ON s.week_end_date = w.week_end_date AND s.genres = g.genres""",
    ),
    "genre_series_chosen": Query(
        genre_series_chosen,
        f"""SELECT * FROM ({_genre_money_sql("profit", "(revenue - budget)")})
WHERE genres IN ('red', 'blue', 'widget') AND profit BETWEEN 100000 AND 50000000""",
    ),
    "genre_series_state": Query(
        genre_series_state,
        f"""SELECT coalesce(bool_or(tmdb_vote_count <> 0), false) AS any_nonzero,
       count(DISTINCT tmdb_vote_count) AS distinct_values,
       CAST(min(tmdb_vote_count) AS BIGINT) AS smallest, CAST(max(tmdb_vote_count) AS BIGINT) AS largest
FROM ({_genre_metric_sql("tmdb_vote_count", "coalesce(sum(tmdb_vote_count), 0)")})""",
    ),
    "genre_value_bounds": Query(
        genre_value_bounds,
        f"""SELECT CAST(trunc(min(revenue)) AS BIGINT) AS revenue_min, CAST(trunc(max(revenue)) AS BIGINT) AS revenue_max
FROM ({GRID})""",
    ),
    "extreme_films": Query(extreme_films, _extreme_sql()),
    "budget_points": Query(
        budget_points, cte(MOVIES) + "SELECT budget, revenue - budget AS profit FROM v_movie WHERE budget > 0"
    ),
    "budget_revenue_trend": Query(_trend("revenue"), _trend_sql("revenue")),
    "budget_profit_trend": Query(_trend("profit"), _trend_sql("(revenue - budget)")),
    "margin_by_director": Query(_margins("Director"), _margins_sql("director_id", "Directing")),
    "margin_by_producer": Query(_margins("Producer"), _margins_sql("producer_id", "Production")),
    "margin_by_director_per_film": Query(_margins("Director", True), _margins_sql("director_id", "Directing", True)),
    "collection_revenue": Query(_collection_revenue(), _collection_sql()),
    "collection_revenue_per_film": Query(_collection_revenue(True), _collection_sql(True)),
    "collection_revenue_in_range": Query(
        _collection_revenue(value_range=(1.0, 1e9)),
        f"SELECT * FROM ({_collection_sql()}) WHERE revenue BETWEEN 1.0 AND 1e9",
    ),
    "domestic_vs_international": Query(
        domestic_vs_international,
        cte(MOVIES, WEEKLY, """
j AS (SELECT title, CAST(domestic_gross AS DOUBLE) AS d, revenue - domestic_gross AS i
      FROM v_weekly JOIN v_movie USING (movie_id)),
k AS (SELECT * FROM j WHERE d BETWEEN 1000 AND 90000 AND i BETWEEN 0 AND 3000000)""")
        + """SELECT title, 'domestic_gross' AS "Revenue Type", d AS "Revenue" FROM k
UNION ALL SELECT title, 'international_revenue', i FROM k""",
    ),
    "domestic_total_vs_international": Query(
        domestic_total_vs_international,
        cte(MOVIES, WEEKLY, """
j AS (SELECT title, CAST(d AS DOUBLE) AS d, revenue - d AS i
      FROM (SELECT movie_id, sum(domestic_gross) AS d FROM v_weekly GROUP BY 1) JOIN v_movie USING (movie_id))""")
        + """SELECT title, 'domestic_gross' AS "Revenue Type", d AS "Revenue" FROM j
UNION ALL SELECT title, 'international_revenue', i FROM j""",
    ),
    "films_with_cast_names": Query(
        films_with_cast_names,
        cte(MOVIES, PEOPLE, "a AS (SELECT * FROM v_people WHERE known_for = 'Acting')")
        + """SELECT movie_id, cast1_id, a1.name AS cast1_name, cast2_id, a2.name AS cast2_name
FROM v_movie LEFT JOIN a a1 ON a1.people_id = cast1_id LEFT JOIN a a2 ON a2.people_id = cast2_id""",
    ),
    "actor_avg_revenue": Query(
        actor_avg_revenue,
        cte(MOVIES, PEOPLE, """
u AS (SELECT revenue, cast1_id AS id FROM v_movie UNION ALL SELECT revenue, cast2_id FROM v_movie)""")
        + """SELECT name AS actor, round(CAST(sum(CAST(revenue AS DECIMAL(24,4))) AS DOUBLE) / count(revenue), 4) AS revenue
FROM u JOIN v_people ON people_id = id AND known_for = 'Acting' GROUP BY name""",
    ),
    "film_roi": Query(film_roi, cte(MOVIES) + f'SELECT movie_id, round("ROI", 6) AS "ROI" FROM {ROI}'),
    "roi_trimmed": Query(
        roi_trimmed, cte(MOVIES, TRIMMED) + 'SELECT movie_id, round("ROI", 6) AS "ROI" FROM t'
    ),
    "roi_histogram": Query(roi_histogram, HISTOGRAM_SQL),
    "roi_density": Query(roi_density, DENSITY_SQL),
    "engagement_long": Query(
        engagement_long,
        cte(MOVIES, VIDEO_STATS, """
k AS (SELECT title, view_count, like_count, comment_count FROM v_movie JOIN v_video USING (movie_id)
      WHERE view_count BETWEEN 5 AND 1000000 AND like_count BETWEEN 1 AND 10000000)""")
        + """SELECT title, 'view_count' AS "Metric", view_count AS "Count" FROM k
UNION ALL SELECT title, 'like_count', like_count FROM k UNION ALL SELECT title, 'comment_count', comment_count FROM k""",
    ),
    "top5_films": Query(
        top5_films,
        cte(MOVIES, "t AS (SELECT * FROM v_movie ORDER BY revenue DESC NULLS LAST, movie_id LIMIT 5)")
        + """SELECT title AS "Movie Title", revenue AS "Revenue", tmdb_popularity AS "TMDB Popularity",
       tmdb_vote_average AS "TMDB Vote Average", array_to_string(genres, ', ') AS "Genres",
       revenue = max(revenue) OVER () AS "Revenue is best",
       tmdb_popularity = max(tmdb_popularity) OVER () AS "TMDB Popularity is best",
       tmdb_vote_average = max(tmdb_vote_average) OVER () AS "TMDB Vote Average is best",
       revenue = min(revenue) OVER () AS "Revenue is worst",
       tmdb_popularity = min(tmdb_popularity) OVER () AS "TMDB Popularity is worst",
       tmdb_vote_average = min(tmdb_vote_average) OVER () AS "TMDB Vote Average is worst"
FROM t""",
    ),
    "competitors_window": Query(competitors_window, COMPETITORS_SQL),
    "competitors_of_one_film": Query(
        competitors_of_one_film,
        cte(MOVIES) + """SELECT movie_id, title, revenue, CAST(release_date AS DATE) AS release_date FROM v_movie
WHERE budget > 0 AND release_date > DATE '1996-06-15' - 45 AND release_date < DATE '1996-06-15' + 45
  AND list_has_any(genres, ['red', 'ring'])""",
    ),
    "distinct_genres": Query(
        distinct_genres, "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS genre FROM part"
    ),
    "name_choices": Query(
        name_choices, "SELECT n_name AS name FROM nation UNION ALL SELECT unnest(['Others', 'None'])"
    ),
    "totals_by_status_wide": Query(
        totals_by_status_wide,
        """SELECT o_orderpriority,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS "F",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS "O",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS DOUBLE) AS "P"
FROM orders GROUP BY 1""",
    ),
}
