import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.operators import lookup
from filmgrid.plans import cleaning, dashboard, prediction, worklists
from filmgrid.sources import readers


def film(number, **changes):
    record = {
        "id": number,
        "title": f"Film {number}",
        "adult": False,
        "popularity": 1.5,
        "vote_average": 7.0,
        "vote_count": 10,
        "budget": 100.0,
        "imdb_id": f"tt{number}",
        "original_language": "en",
        "release_date": "2022-01-07",
        "revenue": 1000.0,
        "runtime": 90.0,
        "status": "Released",
        "belongs_to_collection": {"id": 9, "name": "ignored"},
        "production_companies": [{"id": 1}, {"id": 2}],
        "genres": [{"id": 1, "name": "Action"}, {"id": 2, "name": "Drama"}],
        "credits": {"cast": [{"id": 11}, {"id": 12}, {"id": 13}], "crew": [{"id": 21, "job": "Director"}, {"id": 22, "job": "Producer"}]},
        "videos": {"results": [{"key": "v1", "site": "YouTube", "type": "Trailer", "published_at": "2021"}]},
        "keywords": {"keywords": [{"name": "space"}]},
        "release_dates": {"results": [{"release_dates": [{"type": 3}]}]},
    }
    record.update(changes)
    return record


def landed(spark, folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))
    return str(folder / name)


@pytest.fixture
def languages(spark):
    return spark.createDataFrame([("en", "English"), ("fr", "French")], schemas.LANGUAGES)


def test_clean_movies(spark, tmp_path, languages):
    theatrical_abroad = {"results": [{"release_dates": [{"type": 1}]}, {"release_dates": [{"type": 3}]}]}
    path = landed(
        spark,
        tmp_path / "raw",
        "raw_movie_details_1.ndjson",
        [
            film(1, release_dates=theatrical_abroad),
            film(2, release_dates={"results": [{"release_dates": [{"type": 4}]}]}),
            film(3, release_dates=None),
            film(4, release_dates={"results": [{"release_dates": None}, {"release_dates": [{"type": 3}]}]}),
            film(5, credits={"cast": [], "crew": [{"id": 1, "job": "Director"}, {"id": 2, "job": "Director"}]}, adult=None),
            film(6, credits={"cast": [{"id": 7}], "crew": []}, videos={"results": []}, genres=[]),
            film(7, videos={"results": [{"key": "x", "type": "Clip"}]}, keywords={"keywords": [{"name": "Based On Novel"}]}),
            film(8, revenue=0.0),
            film(9, release_date="", original_language="xx", belongs_to_collection=None, keywords={"keywords": []}),
        ],
    )
    raw = readers.read_ndjson(spark, path, schemas.FILM_DETAILS)
    found = {r.movie_id: r for r in cleaning.clean_movies(raw, languages).collect()}
    assert sorted(found) == [1, 4, 5, 6, 7, 9]
    first = found[1]
    assert (first.original_language, first.release_date, first.genres) == ("English", date(2022, 1, 7), ["Action", "Drama"])
    assert (first.cast1_id, first.cast2_id, first.director_id, first.producer_id) == (11, 12, 21, 22)
    assert (first.production_companies_count, first.is_adult, first.is_adaptation, first.collection_id) == (2, 0, 0, 9)
    assert first.video_key_id == ["v1"]
    assert (found[5].cast1_id, found[5].director_id, found[5].producer_id, found[5].is_adult) == (None, 2, None, 1)
    assert (found[6].cast1_id, found[6].cast2_id, found[6].video_key_id, found[6].genres) == (7, None, [], [])
    assert (found[7].video_key_id, found[7].is_adaptation) == ([], 1)
    assert (found[9].release_date, found[9].original_language, found[9].collection_id, found[9].is_adaptation) == (None, None, None, 0)


def test_movie_columns_match_the_table(spark, tmp_path, languages):
    raw = readers.read_ndjson(spark, landed(spark, tmp_path / "raw", "a.ndjson", [film(1)]), schemas.FILM_DETAILS)
    cleaned = cleaning.clean_movies(raw, languages)
    assert {f.name: f.dataType for f in cleaned.schema} == {
        f.name: f.dataType for f in schemas.MOVIE if f.name != "insertion_datetime"
    }


def test_clean_people(spark, tmp_path):
    path = landed(
        spark,
        tmp_path / "raw",
        "raw_people.ndjson",
        [
            {"id": 1, "name": "A", "birthday": "1970-01-02", "gender": 2, "popularity": 1.0, "known_for_department": "Acting", "movie_credits": {"cast": [{"id": 1}], "crew": []}},
            {"id": 2, "birthday": None},
            {"id": 3, "birthday": "", "movie_credits": {"crew": [{"id": 1}, {"id": 2}]}},
        ],
    )
    found = cleaning.clean_people(readers.read_ndjson(spark, path, schemas.PEOPLE_DETAILS)).orderBy("people_id").collect()
    assert tuple(found[0]) == (1, "A", date(1970, 1, 2), 2, 1.0, "Acting", 1, 0)
    assert tuple(found[1]) == (2, None, None, None, None, None, 0, 0)
    assert tuple(found[2])[-2:] == (0, 2) and found[2].birthday is None


def test_clean_people_changes(spark, tmp_path):
    change = lambda key, *items: {"key": key, "items": [{"action": a, "value": v} for a, v in items]}
    path = landed(
        spark,
        tmp_path / "raw",
        "changes.ndjson",
        [
            {"people_id": 1, "changes": [change("name", ("updated", "A")), change("name", ("added", "B")), change("gender", ("updated", "1"))]},
            {"people_id": 2, "changes": [change("biography", ("updated", "x"))]},
            {"people_id": 3, "changes": [change("name", ("updated", "C"), ("deleted", "C"))]},
            {"people_id": 4, "changes": []},
            {"people_id": 5, "changes": [change("birthday", ("updated", "1980-02-03"))]},
        ],
    )
    found = cleaning.clean_people_changes(readers.read_ndjson(spark, path, schemas.PEOPLE_CHANGES))
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, "B", None, 1, None, None),
        (5, None, date(1980, 2, 3), None, None, None),
    ]
    empty = spark.createDataFrame([], schemas.PEOPLE_CHANGES)
    assert cleaning.clean_people_changes(empty).count() == 0


def test_clean_collections(spark, tmp_path):
    part = lambda kind, day, p: {"media_type": kind, "release_date": day, "popularity": p}
    (tmp_path / "raw_collection_data_1.json").write_text(
        json.dumps(
            {
                "10": {"id": 10, "name": " Padded ", "parts": [part("movie", "2019-12-31", 4.0), part("movie", "2010-01-01", 2.0), part("tv", "2001-01-01", 9.0), part("movie", "", 1.0)]},
                "11": {"id": 11, "name": "Late", "parts": [part("movie", "2020-01-01", 1.0)]},
            }
        )
    )
    (tmp_path / "raw_collection_data_2.json").write_text(json.dumps({"11": {"id": 11, "name": "Later", "parts": []}}))
    raw = readers.read_keyed_json(spark, readers.prefix_glob(str(tmp_path), "raw_collection_data", "json"), schemas.COLLECTION_DETAILS)
    found = sorted(tuple(r) for r in cleaning.clean_collections(raw).collect())
    assert found == [(10, "Padded", 2, 3.0), (11, "Later", 0, None)]


def test_clean_video_stats(spark, tmp_path):
    (tmp_path / "raw_vimeo_video_stats_1.csv").write_text("video_key_id,view_count,like_count,comment_count\n402676757,10123.0,44.0,2.0\n5,,,\n402676757,10123.0,44.0,2.0\n")
    (tmp_path / "raw_youtube_video_stats_1.csv").write_text("id,viewCount,likeCount,favoriteCount,commentCount\nabc,100,5,0,\n")
    youtube = readers.read_csv(spark, str(tmp_path / "raw_youtube*.csv"), schemas.YOUTUBE_STATS)
    vimeo = readers.read_csv(spark, str(tmp_path / "raw_vimeo*.csv"), schemas.VIMEO_STATS)
    video = lambda key, site: {"key": key, "site": site, "type": "Trailer", "published_at": "t"}
    raw = readers.read_ndjson(
        spark,
        landed(spark, tmp_path / "raw", "f.ndjson", [
            film(1, videos={"results": [video("402676757", "Vimeo"), video("abc", "YouTube"), video("none", "YouTube")]}),
            film(2, videos={"results": [video("abc", "YouTube"), video("5", "Vimeo")]}),
            film(3, videos=None),
        ]),
        schemas.FILM_DETAILS,
    )
    found = cleaning.clean_video_stats(cleaning.video_details(raw), cleaning.video_statistics(youtube, vimeo))
    assert sorted((r.movie_id, r.video_key_id, r.view_count, r.like_count, r.comment_count) for r in found.collect()) == [
        (1, "402676757", 10123, 44, 2),
        (1, "abc", 100, 5, 0),
        (2, "5", 0, 0, 0),
        (2, "abc", 100, 5, 0),
    ]
    assert worklists.video_keys(raw, "Vimeo").count() == 2


CHART_HEADER = "year,week,Rank,LW,Release,Gross,Theaters,Weeks\n"


def test_weekly_performance(spark, tmp_path):
    (tmp_path / "weekly_chart_1.csv").write_text(
        CHART_HEADER
        + '2022,3,1,-,Film: One,"$1,234","3,210",2\n'
        + "2022,3,2,-,Jaws 20th Anniversary,$9,-,1\n"
        + "2022,3,3,-,Unknown,$9,-,1\n"
        + '2022,3,4,-,Far?,"$5",-,-\n'
        + "2040,53,5,-,Film: One,$7,5,1\n"
    )
    raw = readers.read_csv(spark, str(tmp_path / "weekly_chart_1.csv"), schemas.WEEKLY_CHART)
    movies = spark.createDataFrame(
        [(1, "film one", date(2022, 1, 7)), (2, "Film One", date(2010, 1, 1)), (3, "far!", date(2021, 1, 1))],
        "movie_id long, title string, release_date date",
    )
    assert [(r.year, r.week, r.reason) for r in cleaning.chart_rejects(raw).collect()] == [(2040, 53, "no such week in the year")]
    found = [tuple(r) for r in cleaning.weekly_performance(raw, movies).collect()]
    assert found == [(date(2022, 1, 27), 1, 1, 1234, 3210)]


def test_latest_chart(spark, tmp_path):
    (tmp_path / "weekly_chart_1.csv").write_text(CHART_HEADER + "2022,3,1,-,A,$1,1,1\n2022,3,2,-,B,$2,1,1\n")
    (tmp_path / "update_weekly_chart_1.csv").write_text(CHART_HEADER + "2022,3,7,-,A,$10,1,1\n")
    (tmp_path / "update_weekly_chart_2.csv").write_text(CHART_HEADER + "2022,3,8,-,A,$11,1,1\n")
    import os

    os.utime(tmp_path / "update_weekly_chart_2.csv", (1, 1))  # landed earlier despite its name
    read = lambda name: readers.with_file_order(readers.read_csv(spark, str(tmp_path / name), schemas.WEEKLY_CHART))
    found = cleaning.latest_chart(read("weekly_chart*.csv"), read("update_weekly_chart*.csv"))
    assert sorted((r.Release, r.Gross) for r in found.collect()) == [("A", "$10"), ("B", "$2")]


PAGE = """<html><table class="x"><tr><th>No</th></tr></table>
<table class="a-bordered mojo-body-table scrolling-data-table">
<tr><th>Rank
</th><th class="a-hidden">x</th><th>Release</th><th>Gross</th><th>Theaters</th><th>Weeks</th><th>Distributor</th></tr>
<tr><td>1</td><td class="hidden">no</td><td><a href="/r">Tom &amp; Jerry
</a></td><td>$1,000</td><td>-</td><td>3</td></tr>
<tr><td>only</td><td>two</td></tr>
<TR><TD>2</TD><td>Caf&eacute;</td><td>$5</td><td>7</td><td>-</td><td>Studio</td><td>extra</td></TR>
</table></html>"""


def test_chart_page(spark):
    pages = spark.createDataFrame([("https://x.example/weekly/2022W03/?ref=1", PAGE), ("https://x.example/weekly/2022W04/", "<p>none</p>")], schemas.CHART_PAGES)
    found = [tuple(r) for r in readers.weekly_chart(pages).collect()]
    assert found == [
        (2022, 3, "Tom & Jerry", 1, "$1,000", "-", "3"),
        (2022, 3, "Café", 2, "$5", "7", "-"),
    ]
    cells = readers.chart_rows(pages).orderBy("position").collect()
    assert cells[0].cells["Distributor"] is None and cells[1].cells["Distributor"] == "Studio"


def test_work_lists(spark):
    movies = spark.createDataFrame([(1, 5, 6, None, 7, 3), (2, 5, None, 8, None, None)], "movie_id long, cast1_id long, cast2_id long, director_id long, producer_id long, collection_id long")
    people = spark.createDataFrame([(5,), (9,)], "people_id long")
    assert sorted(r[0] for r in worklists.people_ids(movies).collect()) == [5, 6, 7, 8]
    assert sorted(r[0] for r in worklists.new_people_ids(movies, people).collect()) == [6, 7, 8]
    assert [r[0] for r in worklists.new_collection_ids(movies, spark.createDataFrame([(4,)], "collection_id long")).collect()] == [3]
    raw = spark.createDataFrame([(1, (3,)), (2, None), (3, (3,))], "id long, belongs_to_collection struct<id:long>")
    assert [r[0] for r in worklists.collection_ids(raw).collect()] == [3]


def test_rekey_video_stats(spark):
    movies = spark.createDataFrame([(1, ["a__1", "b"]), (2, []), (3, ["a"])], "movie_id long, video_key_id array<string>")
    stats = spark.createDataFrame([(0, "a", "YouTube", 5), (0, "z", "Vimeo", 1)], "movie_id long, video_key_id string, video_site string, view_count long")
    assert sorted(tuple(r) for r in cleaning.film_keyed_stats(movies, stats).collect()) == [(1, "YouTube", 5), (3, "YouTube", 5)]


def test_genre_series(spark):
    movies = spark.createDataFrame(
        [(1, ["A", "B"], 100.0, 10.0, 4.0), (2, ["A"], 50.0, 0.0, 5.0), (3, None, 70.0, 5.0, 1.0), (4, ["A"], None, 5.0, None)],
        "movie_id long, genres array<string>, revenue double, budget double, tmdb_popularity double",
    )
    weekly = spark.createDataFrame([(1, date(2024, 3, 7)), (1, date(2024, 3, 14)), (2, date(2024, 3, 7)), (3, date(2024, 3, 7)), (4, date(2024, 3, 21))], "movie_id long, week_end_date date")
    money = sorted(tuple(r) for r in dashboard.genre_money(movies, weekly).collect())
    assert money == [("A", date(2024, 3, 10), 100.0), ("A", date(2024, 3, 17), 100.0), ("A", date(2024, 3, 24), 0.0), ("B", date(2024, 3, 10), 100.0), ("B", date(2024, 3, 17), 100.0)]
    profit = dashboard.genre_money(movies, weekly, "profit").where("genres = 'B'").first()
    assert profit.profit == 90.0
    popularity = {(r.genres, r.week_end_date.day): r.tmdb_popularity for r in dashboard.genre_popularity(movies, weekly).collect()}
    assert popularity == {("A", 10): 4, ("A", 17): 4, ("A", 24): None, ("B", 10): 4, ("B", 17): 4}
    series = dashboard.genre_money(movies, weekly)
    assert dashboard.genre_series(series, "revenue", []).count() == 0
    assert dashboard.genre_series(series, "revenue", ["B"], (0, 100)).count() == 2
    assert dashboard.genre_grid(series, "revenue").count() == 6


def test_panels(spark):
    movies = spark.createDataFrame(
        [(1, "x", 30.0, 10.0, 1, 2, 5, 1), (2, "y", 10.0, 10.0, 1, None, 5, 1), (3, "z", 5.0, 0.0, 4, 2, 5, None)],
        "movie_id long, title string, revenue double, budget double, cast1_id long, cast2_id long, director_id long, collection_id long",
    )
    people = spark.createDataFrame([(1, "Ann", "Acting"), (2, "Ann", "Acting"), (4, "Cy", "Directing"), (5, "Di", "Directing")], "people_id long, name string, known_for string")
    assert [tuple(r) for r in dashboard.actor_revenue(movies, people).collect()] == [("Ann", 18.75)]
    margins = [tuple(r) for r in dashboard.profit_margins(movies, people).collect()]
    assert margins == [(5, 1.0, "Di")]
    assert dashboard.profit_margins(movies, people, per_film=True).count() == 2
    collections = spark.createDataFrame([(1, "C")], "collection_id long, name string")
    assert [tuple(r) for r in dashboard.collection_revenue(movies, collections).collect()] == [(1, 40.0, "C")]
    names = dashboard.films_with_cast_names(movies, people).orderBy("movie_id").collect()
    assert [(r.cast1_name, r.cast2_name) for r in names] == [("Ann", "Ann"), ("Ann", None), (None, "Ann")]
    weekly = spark.createDataFrame([(1, 4), (1, 6)], "movie_id long, domestic_gross long")
    each = sorted(tuple(r) for r in dashboard.domestic_and_international(movies, weekly).collect())
    assert each == [("x", "domestic_gross", 4.0), ("x", "domestic_gross", 6.0), ("x", "international_revenue", 24.0), ("x", "international_revenue", 26.0)]
    total = sorted(tuple(r) for r in dashboard.domestic_and_international(movies, weekly, cumulative=True).collect())
    assert total == [("x", "domestic_gross", 10.0), ("x", "international_revenue", 20.0)]


def test_find_unknown_name(spark):
    names = spark.createDataFrame([("Others",)], "who string")
    people = spark.createDataFrame([(1, "Ann", 2.0)], "people_id long, name string, tmdb_popularity double")
    assert lookup.find_values(names, "who", people, "name", "people_id", "tmdb_popularity", "p").first().p is None


def test_prediction(spark):
    rows = [(i, float(1000 + 10 * i), float(i), date(2020, 1, 1 + i % 28), 90.0 + i % 7, i % 5 * 10, i % 3, i % 4, None, 2) for i in range(120)]
    movies = spark.createDataFrame(rows, "movie_id long, revenue double, budget double, release_date date, runtime double, tmdb_vote_count int, cast1_id int, cast2_id int, director_id long, producer_id int")
    features = prediction.identity_features(movies)
    model = prediction.train_linear(features)
    scored = prediction.predict(model, features)
    error = scored.agg(F.avg(F.abs(F.col("label") - F.col("predicted_revenue")))).first()[0]
    assert error < 20
    row = prediction.parameter_row(spark, {"movie_id": 1, "budget": 50.0}, features.schema)
    value = prediction.with_interval(prediction.predict(model, row)).first()
    assert value.predicted_revenue is not None and value.lower_bound == 1.0 and value.upper_bound > 10847621
    assert prediction.residual_margin(scored) > 0


def test_genre_sums_add_up(spark):
    """Summed over genres, a film counts once per genre and chart week."""
    films = [(i, [f"g{j}" for j in range(i % 4)], float(i * 10), float(i % 3)) for i in range(40)]
    weeks = [(i, date(2024, 1, 4 + 7 * w)) for i in range(40) for w in range(i % 3)]
    movies = spark.createDataFrame(films, "movie_id long, genres array<string>, revenue double, budget double")
    weekly = spark.createDataFrame(weeks, "movie_id long, week_end_date date")
    total = dashboard.genre_money(movies, weekly).agg(F.sum("revenue")).first()[0]
    assert total == sum(r * len(g) * (i % 3) for i, g, r, b in films if b > 0)


def test_weeks_without_votes_count_as_zero(spark):
    movies = spark.createDataFrame([(1, ["A"], None), (2, ["B"], 3)], "movie_id long, genres array<string>, tmdb_vote_count long")
    weekly = spark.createDataFrame([(1, date(2024, 3, 7)), (2, date(2024, 3, 7))], "movie_id long, week_end_date date")
    found = dashboard.genre_popularity(movies, weekly, "tmdb_vote_count")
    assert {r.genres: r.tmdb_vote_count for r in found.collect()} == {"A": 0, "B": 3}


def test_missing_numbers_in_models(spark):
    rows = [(i, float(10 * i), float("nan") if i % 5 == 0 else float(i), date(2020, 1, 1 + i % 28), None if i % 7 == 0 else 90.0, None, i % 3, i % 4, None, 2) for i in range(80)]
    movies = spark.createDataFrame(rows, "movie_id long, revenue double, budget double, release_date date, runtime double, tmdb_vote_count int, cast1_id int, cast2_id int, director_id long, producer_id int")
    features = prediction.identity_features(movies)
    for model in (prediction.train_linear(features), prediction.train_forest(features, trees=3)):
        assert prediction.predict(model, features).where("predicted_revenue IS NULL OR isnan(predicted_revenue)").count() == 0


def test_person_means_leave_the_own_film_out(spark):
    features = spark.createDataFrame(
        [(1, 10.0, "a", None, None, "x"), (2, 30.0, "a", None, None, None), (3, None, "a", "b", None, None)],
        "movie_id long, label double, cast1_id string, cast2_id string, director_id string, producer_id string",
    )
    totals = prediction.person_totals(features)
    own = {r.movie_id: r for r in prediction.with_person_means(features, totals, 20.0, own=True).collect()}
    prior = prediction.PRIOR_FILMS
    assert own[1].cast1_mean == (30.0 + prior * 20.0) / (1 + prior) and own[2].cast1_mean == (10.0 + prior * 20.0) / (1 + prior)
    assert own[3].cast1_mean == (40.0 + prior * 20.0) / (2 + prior) and own[3].cast2_mean == 20.0 and own[1].director_mean == 20.0


def test_latest_statistics(spark):
    stats = spark.createDataFrame(
        [("a", None, 5.0, 1.0), ("a", 0.0, 3.0, 9.0), ("b", 7.0, 1.0, None), ("b", 8.0, None, None)], schemas.VIMEO_STATS
    )
    found = sorted(tuple(r) for r in cleaning.latest_statistics(stats).collect())
    assert found == [("a", 0.0, 5.0, 1.0), ("b", 8.0, 0.0, 0.0)]


def test_competitors_of_one(spark):
    movies = spark.createDataFrame(
        [(1, ["A"], 5.0, 1.0, date(2024, 5, 1)), (2, ["B"], 9.0, 1.0, date(2024, 5, 1)), (3, ["A", "B"], 7.0, 0.0, date(2024, 5, 1)), (4, ["A"], 8.0, 1.0, date(2024, 6, 15))],
        "movie_id long, genres array<string>, revenue double, budget double, release_date date",
    )
    ids = lambda genres: [r.movie_id for r in dashboard.competitors_of_one(movies, "2024-05-01", genres).collect()]
    assert ids(["A"]) == [1] and ids([]) == [2, 1] and ids(["A", "B"]) == [2, 1]
    names = dashboard.name_choices(spark.createDataFrame([("C",)], "name string"), ["Others", "None"])
    assert sorted(r.name for r in names.collect()) == ["C", "None", "Others"]


def test_the_whole_chart_is_sorted(spark):
    """Every row comes back with its place, from a sort by ranges that no limit cuts."""
    from filmgrid.registry.cleaning import chart_in_order_positions
    from filmgrid.registry.views import weekly

    folder = "/root/testdata/sf0.001"
    found = sorted(chart_in_order_positions(spark, folder).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(weekly(spark, folder).count()))
    order = [(r.week_end_date, r.rank, r.movie_id) for r in found]
    assert order == sorted(order)
