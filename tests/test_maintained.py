"""Results kept up to date by touched keys equal those computed anew."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.operators import resolve
from filmgrid.plans import cleaning, maintained
from filmgrid.sources.warehouse import ORDER, Warehouse

NOW = datetime(2024, 4, 1, 8)
SIMPLE = {"t": (schemas.record(id=schemas.LONG, v=schemas.STRING, insertion_datetime=schemas.TIME), ["id"])}


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "w"), buckets=4)
    made.create_all()
    maintained.state_of(made).create_all()
    return made


def files(folder):
    return {str(p) for p in folder.rglob("*.parquet")}


def test_replace_touches_its_buckets_alone(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE, buckets=8)
    rows = spark.createDataFrame([(i, "a") for i in range(100)], "id long, v string")
    warehouse.load("t", rows, NOW, "append", load_id="one")
    before = files(tmp_path / "w" / "t")
    gone, new = rows.where("id in (3, 5)").select("id"), spark.createDataFrame([(3, "b"), (3, "c")], "id long, v string")
    for _ in range(2):
        warehouse.replace("t", gone, new, NOW)
    assert warehouse.read("t").count() == 100 and values(warehouse.read("t").where("id in (3, 5)"), "id", "v") == [(3, "b"), (3, "c")]
    touched = {p.split("bucket=")[1].split("/")[0] for p in before ^ files(tmp_path / "w" / "t")}
    assert len(touched) <= 2
    plan = warehouse.rows_of("t", gone)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    with pytest.raises(ValueError, match="buckets"):
        warehouse.rows_of("t", new.select("v"))


def test_replace_can_empty_a_bucket(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE, buckets=50)
    rows = spark.createDataFrame([(i, "a") for i in range(20)], "id long, v string")
    warehouse.load("t", rows, NOW, "append")
    warehouse.replace("t", rows.where("id < 10").select("id"), rows.limit(0), NOW)
    assert values(warehouse.read("t"), "id") == [(i,) for i in sorted(range(10, 20), key=lambda i: str((i,)))]
    warehouse.replace("t", rows.select("id"), rows.limit(0), NOW)
    assert warehouse.read("t").isEmpty()
    warehouse.replace("t", rows.limit(0).select("id"), rows.limit(0), NOW)
    warehouse.replace("t", spark.createDataFrame([(None,)], "id long"), rows.limit(3), NOW)
    assert warehouse.read("t").count() == 3


def test_chart_matches_follow_films_and_rows(spark, warehouse):
    """After each of three updates, the second of them twice, the matches are those of the whole chart and all films."""
    state, dice = maintained.state_of(warehouse), random.Random(3)
    titles = ["Alpha", "Beta", "Gamma", "The Alpha", "Delta"]
    all_rows, films = [], {}
    for update in range(3):
        batch = [
            (2022, dice.randint(1, 12), dice.choice(titles), dice.randint(1, 9), f"${dice.randint(1, 99)}", "-", str(dice.randint(1, 3)), update, datetime(2024, 1, 1 + update), f"f{i}")
            for i in range(25)
        ] + [(None, 1, "Alpha", 1, "$1", "-", "1", update, datetime(2024, 1, 1 + update), "f")]
        all_rows += batch
        schema = "year int, week int, Release string, Rank long, Gross string, Theaters string, Weeks string, _source int, _landed timestamp, _file string"
        moved = [(i, dice.choice(titles), date(2021, 12, 20) + timedelta(days=dice.randint(0, 90)), f"{update}") for i in dice.sample(range(12), 6)]
        if update == 2:  # an older record of a film that has a newer one
            moved.append((moved[0][0] + 100, "Alpha", None, "0"))
        for row in moved:
            films[row[0]] = row
        records = spark.createDataFrame(moved, "movie_id long, title string, release_date date, source_order string")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.MOVIE.fields if f.name not in (*records.columns, "insertion_datetime")]
        records = records.select("*", *empty)
        for _ in range(1 + update % 2):
            concerned = maintained.move_titles(state, *maintained.changed_titles(warehouse, records), NOW)
            concerned = concerned.union(maintained.add_chart_rows(state, spark.createDataFrame(batch, schema), NOW))
            maintained.match_titles(warehouse, state, concerned, NOW)
            warehouse.upsert("movie", records, NOW)
        latest = maintained.chart_state(spark.createDataFrame(all_rows, schema)).drop("title_cleaned", ORDER)
        every = spark.createDataFrame([f[:3] for f in films.values()], "movie_id long, title string, release_date date")
        expected = resolve.resolve_chart(cleaning.clean_weekly_chart(latest), cleaning.titled_films(every))
        columns = ["week_end_date", "movie_id", "rank", "domestic_gross", "domestic_theaters_count"]
        found = warehouse.read("weekly_domestic_performance")
        assert values(found, *columns) == values(expected, *columns) and found.count() > 5
        assert values(warehouse.read("movie"), "movie_id", "title") == values(every, "movie_id", "title")


def test_a_title_change_takes_matches_back(spark, warehouse):
    state = maintained.state_of(warehouse)
    rows = [(2022, 2, "One", 1, "$5", "-", "1", 0, NOW, "a"), (2022, 3, "Two", 1, "$7", "-", "2", 0, NOW, "a")]
    schema = "year int, week int, Release string, Rank long, Gross string, Theaters string, Weeks string, _source int, _landed timestamp, _file string"

    def film(title, order):
        frame = spark.createDataFrame([(1, title, date(2022, 1, 1), order)], "movie_id long, title string, release_date date, source_order string")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.MOVIE.fields if f.name not in (*frame.columns, "insertion_datetime")]
        return frame.select("*", *empty)

    def update(batch, charts):
        titles = maintained.move_titles(state, *maintained.changed_titles(warehouse, batch), NOW)
        if charts:
            titles = titles.union(maintained.add_chart_rows(state, spark.createDataFrame(charts, schema), NOW))
        maintained.match_titles(warehouse, state, titles, NOW)
        warehouse.upsert("movie", batch, NOW)
        return values(warehouse.read("weekly_domestic_performance"), "domestic_gross", "movie_id")

    assert update(film("One", "2"), rows) == [(5, 1)]
    assert update(film("Two", "3"), []) == [(7, 1)]
    assert update(film("One", "1"), []) == [(7, 1)]  # landed late
    assert update(film("Nothing", "4"), []) == []


CHANGES = "people_id long, changes array<struct<key:string,items:array<struct<action:string,value:string>>>>, _order string, _position struct<start:long,row:long>"


def test_changes_of_people_in_any_order_of_arrival(spark, tmp_path):
    edit = lambda key, *values: {"key": key, "items": [{"action": "updated", "value": v} for v in values]}
    batches = [
        [(1, [edit("name", "a", "b")], "1", (0, 1)), (2, [edit("name", "x")], "1", (0, 2)), (None, [edit("name", "n")], "1", (0, 3))],
        [(1, [edit("gender", "2")], "2", (0, 1)), (1, [edit("name", "c")], "2", (0, 2))],
        [(1, [edit("name", "old")], "0", (0, 9)), (2, [edit("name", "y"), edit("birthday", "1990-01-01")], "3", (0, 1))],
    ]
    found = set()
    for number, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 2, 0)]):
        warehouse = Warehouse(spark, str(tmp_path / f"w{number}"), buckets=2)
        warehouse.create_all()
        state = maintained.state_of(warehouse)
        state.create_all()
        people = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "people_id long, name string")
        warehouse.load("people", people, NOW)
        for i in (*order, order[0]):
            registers = maintained.change_registers(spark.createDataFrame(batches[i], CHANGES))
            state.upsert("people_changes", registers, NOW, ["people_id", "key"])
            maintained.apply_changes(warehouse, state, registers.select("people_id"), NOW)
        found.add(str(values(warehouse.read("people"), "people_id", "name", "gender", "birthday")))
        assert state.read("people_changes").count() == 4
    assert found == {str([(1, "c", 2, None), (2, "y", None, date(1990, 1, 1)), (3, "three", None, None)])}


FILM = "id long, videos struct<results:array<struct<key:string,site:string,type:string,published_at:string>>>, _order string"


def test_films_take_and_drop_videos(spark, warehouse):
    state = maintained.state_of(warehouse)
    video = lambda key, kind="Trailer": (key, "YouTube", kind, "2020")

    def film(number, order, *keys):
        return (number, ([video(k) for k in keys],), order)

    def update(films, counts=()):
        refreshed = None
        if counts:
            refreshed = spark.createDataFrame([(k, float(n), None, None, o) for k, n, o in counts], "video_key_id string, view_count double, like_count double, comment_count double, source_order string")
            state.upsert("video_counts", refreshed, NOW)
        if films:
            maintained.move_videos(warehouse, state, spark.createDataFrame(films, FILM), refreshed, NOW)
        else:
            maintained.count_videos(warehouse, state, refreshed.select("video_key_id"), warehouse.read("video_stats").limit(0), NOW)
        return values(warehouse.read("video_stats"), "movie_id", "video_key_id", "view_count")

    assert update([film(1, "1", "a", "b"), film(2, "1", "b")], [("a", 10, "1"), ("b", 20, "1"), ("z", 5, "1")]) == [(1, "a", 10), (1, "b", 20), (2, "b", 20)]
    for _ in range(2):
        assert update([film(1, "3", "b", "z")]) == [(1, "b", 20), (1, "z", 5), (2, "b", 20)]  # z was counted before a film had it
    assert update([film(1, "2", "a")]) == [(1, "b", 20), (1, "z", 5), (2, "b", 20)]  # landed late
    assert update([], [("b", 7, "2"), ("a", 1, "2")]) == [(1, "b", 7), (1, "z", 5), (2, "b", 7)]
    assert update([(2, None, "4"), (None, None, "4")], [("z", 6, "0")]) == [(1, "b", 7), (1, "z", 5)]
