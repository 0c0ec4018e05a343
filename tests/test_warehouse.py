import json
from datetime import date, datetime

import pytest

from filmgrid import schemas
from filmgrid.plans import warehouse_jobs
from filmgrid.registry import files as landings
from filmgrid.session import fresh_path
from filmgrid.sources import readers, writers
from filmgrid.sources.warehouse import Warehouse
from filmgrid.sources.ordering import order_text
from filmgrid.streaming.ingest import ingest_files, read_rejects
from pyspark.sql import functions as F
from test_cleaning import CHART_HEADER, film

NOW = datetime(2024, 4, 1, 8)
LATER = datetime(2024, 4, 8, 8)
SIMPLE = {"t": (schemas.record(id=schemas.LONG, v=schemas.STRING, words=schemas.STRINGS, insertion_datetime=schemas.TIME), ["id"])}


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_tables(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE)
    with pytest.raises(ValueError, match="no table"):
        warehouse.read("t")
    warehouse.create_all()
    warehouse.create_all()
    assert warehouse.read("t").count() == 0
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    warehouse.load("t", rows, NOW, "empty")
    with pytest.raises(ValueError, match="not empty"):
        warehouse.load("t", rows, NOW, "empty")
    warehouse.load("t", rows.where("id = 1"), LATER, "append")
    assert values(warehouse.read("t"), "id", "insertion_datetime") == [(1, NOW), (1, LATER), (2, NOW)]
    warehouse.load("t", rows, NOW, "truncate")
    assert warehouse.read("t").count() == 2
    warehouse.truncate("t")
    assert warehouse.read("t").isEmpty() and "v" in warehouse.read("t").columns
    with pytest.raises(ValueError, match="confirm"):
        warehouse.drop_all()
    warehouse.drop_all(confirm=True)
    assert not warehouse.exists("t")


def test_upsert_and_update(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE)
    warehouse.create_all()
    warehouse.load("t", spark.createDataFrame([(1, "a", ["x"]), (2, "b", [])], "id int, v string, words array<string>"), NOW)
    batch = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    warehouse.upsert("t", batch, LATER)
    warehouse.upsert("t", batch, LATER)
    assert values(warehouse.read("t"), "id", "v", "words", "insertion_datetime") == [(1, "a", ["x"], NOW), (2, None, [], LATER), (3, "c", None, LATER)]
    warehouse.update("t", spark.createDataFrame([(1, None), (3, "d"), (9, "z")], "id int, v string"), NOW)
    assert values(warehouse.read("t"), "id", "v") == [(1, "a"), (2, None), (3, "d")]
    before = files(tmp_path)
    warehouse.upsert("t", batch.limit(0), NOW)
    assert files(tmp_path) == before
    assert not list((tmp_path / "w" / "_staging").iterdir())


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in (folder / "w" / "t").rglob("*.parquet")}


def test_merge_leaves_other_buckets_alone(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE, buckets=8)
    rows = spark.createDataFrame([(i, "a") for i in range(200)], "id long, v string")
    warehouse.load("t", rows, NOW, "truncate")
    before = files(tmp_path)
    assert len(before) >= 8
    warehouse.upsert("t", rows.where("id = 7").withColumn("v", F.lit("b")), LATER)
    after = files(tmp_path)
    gone = [p for p in before if p not in after]
    assert len({p.split("bucket=")[1].split("/")[0] for p in gone}) == 1
    assert all(after[p] == t for p, t in before.items() if p in after)
    assert warehouse.read("t").count() == 200 and warehouse.read("t").where("v = 'b'").count() == 1
    assert values(warehouse.read("t").where("id = 7"), "id", "v", "insertion_datetime") == [(7, "b", LATER)]


def test_appends_by_load(spark, tmp_path):
    """A repeated load replaces what it wrote, a batch without a column gives nulls, and merges keep the loads apart."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE, buckets=4)
    warehouse.create_all()
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string")
    warehouse.load("t", rows, NOW, "append", load_id="one")
    warehouse.load("t", rows.where("id < 3").select("id"), NOW, "append", load_id="two")
    for _ in range(2):
        warehouse.load("t", rows.where("id >= 18"), LATER, "append", load_id="one")
    assert values(warehouse.read("t"), "id", "v") == [(0, None), (1, None), (18, "v18"), (19, "v19"), (2, None)]
    warehouse.upsert("t", rows.where("id in (1, 19, 5)").withColumn("v", F.lit("new")), LATER)
    assert values(warehouse.read("t"), "id", "v") == [(0, None), (1, "new"), (18, "v18"), (19, "new"), (2, None), (5, "new")]
    with pytest.raises(ValueError, match="names no load"):
        warehouse.load("t", rows, NOW, "append", load_id="merged")


def test_older_rows_do_not_win(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE)
    warehouse.create_all()
    row = lambda v, order: spark.createDataFrame([(1, v, order)], "id long, v string, source_order string")
    for v, order in (("b", "2"), ("a", "1"), ("c", "2"), ("n", None)):
        warehouse.upsert("t", row(v, order), NOW)
    assert values(warehouse.read("t"), "id", "v") == [(1, "c")]
    warehouse.upsert("t", row("plain", None).drop("source_order"), NOW)
    assert values(warehouse.read("t"), "id", "v") == [(1, "plain")]


def test_csv_with_arrays(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'say "hi", you', ["a", "b"]), (2, None, [])], "id long, v string, words array<string>")
    path = fresh_path(spark, "csv")
    writers.write_csv(rows.coalesce(1), path)
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE)
    warehouse.load_csv("t", f"{path}/*.csv", NOW, "append")
    assert values(warehouse.read("t"), "id", "v", "words") == [(1, 'say "hi", you', ["a", "b"]), (2, None, [])]


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,id,v\n9,1,a\n")
    schema = schemas.record(v=schemas.STRING, id=schemas.LONG)
    assert values(readers.read_csv(spark, str(tmp_path / "a.csv"), schema), "id", "v") == [(1, "a")]
    with pytest.raises(ValueError, match="missing"):
        readers.read_csv(spark, str(tmp_path / "a.csv"), schemas.record(w=schemas.STRING))
    (tmp_path / "b.csv").write_text("id,x,v\n1,9,a\n")
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "*.csv"), schema).collect()


def test_files(spark, tmp_path):
    for name in ("u_20240101_20240108", "u_20240108_20240115", "u_20231201_20231208"):
        (tmp_path / f"{name}.ndjson").write_text(json.dumps({"id": int(name[-4:])}))
    schema = schemas.record(id=schemas.LONG)
    latest = readers.latest_file(spark, str(tmp_path), "u_", "ndjson")
    assert latest.endswith("u_20240108_20240115.ndjson")
    assert readers.latest_file(spark, str(tmp_path), "none", "ndjson") is None
    found = readers.read_window(spark, str(tmp_path), "u", "ndjson", schema, date(2024, 1, 1), date(2024, 1, 8))
    assert values(found, "id") == [(108,)]
    assert readers.read_window(spark, str(tmp_path), "u", "ndjson", schema, date(2020, 1, 1), date(2020, 1, 8)).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_window(spark, str(tmp_path), "u", "ndjson", schema, date(2020, 1, 1), date(2020, 1, 8), required=True)
    assert readers.read_window(spark, str(tmp_path), "u", "ndjson", schema).count() == 3
    (tmp_path / "bad.ndjson").write_text('{"id": 1}\nnot json\n{"id": 2}\n')
    good, bad = readers.read_ndjson_with_rejects(spark, str(tmp_path / "bad.ndjson"), schema)
    assert values(good, "id") == [(1,), (2,)] and values(bad, "file", "line") == [("bad.ndjson", "not json")]
    (tmp_path / "doc.json").write_text('[\n{"id": 1},\n{"id": 2}\n]')
    assert readers.read_json_document(spark, str(tmp_path / "doc.json"), schema).count() == 2


def _land(folder, name, records):
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def test_initial_load_and_weekly_update(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    languages = spark.createDataFrame([("en", "English")], schemas.LANGUAGES)
    _land(landing, "raw_movie_details_0.ndjson", [film(1, title="One"), film(2, title="Two", release_date="2021-12-30")])
    _land(landing, "raw_people_0.ndjson", [{"id": 11, "name": "A", "known_for_department": "Acting"}, {"id": 21, "name": "D"}])
    (landing / "raw_collection_data_0.json").write_text(json.dumps({"9": {"id": 9, "name": "C", "parts": []}}))
    (landing / "raw_youtube_video_stats_0.csv").write_text("id,viewCount,likeCount,commentCount\nv1,10,1,\n")
    (landing / "weekly_chart_0.csv").write_text(CHART_HEADER + "2022,2,1,-,One,$100,10,1\n2022,2,2,-,Two,$50,-,2\n")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse_jobs.initialise(spark, str(landing), warehouse, languages, NOW)
    assert values(warehouse.read("movie"), "movie_id", "title") == [(1, "One"), (2, "Two")]
    assert values(warehouse.read("video_stats"), "movie_id", "view_count") == [(1, 10), (2, 10)]
    assert values(warehouse.read("weekly_domestic_performance"), "movie_id", "domestic_gross") == [(1, 100), (2, 50)]

    run = date(2024, 4, 8)
    windows = warehouse_jobs.update_windows(spark, run)
    assert windows["films"] == {"start": date(2024, 1, 1), "end": date(2024, 1, 8)}
    assert (windows["chart_week"], windows["chart_year"]) == (14, 2024)
    _land(landing, "update_raw_movie_details_20231225_20240101.ndjson", [film(1, title="Old news")])
    fresh = film(3, title="Three", videos={"results": [{"key": "v3", "site": "YouTube", "type": "Trailer", "published_at": "p"}]})
    _land(landing, "update_raw_movie_details_20240101_20240108.ndjson", [film(1, title="One again"), fresh])
    _land(landing, "append_raw_people_20240101_20240108.ndjson", [{"id": 31, "name": "N", "popularity": 9.0}])
    _land(landing, "update_raw_people_20240101_20240108.ndjson", [
        {"people_id": 11, "changes": [{"key": "birthday", "items": [{"action": "added", "value": "1980-01-01"}]}]},
        {"people_id": 77, "changes": [{"key": "name", "items": [{"action": "updated", "value": "nobody"}]}]},
    ])
    (landing / "update_raw_collection_data_1.json").write_text(json.dumps({"9": {"id": 9, "name": "dup", "parts": []}, "10": {"id": 10, "name": "New", "parts": []}}))
    (landing / "raw_youtube_video_stats_20240101_20240108.csv").write_text("id,viewCount,likeCount,commentCount\nv3,7,1,1\nv3,8,1,1\n")
    (landing / "update_weekly_chart_1.csv").write_text(CHART_HEADER + "2022,2,1,-,Two,$60,-,2\n2022,3,1,-,Three,$5,1,2\n")
    for _ in range(2):  # running it again changes nothing
        warehouse_jobs.weekly_update(spark, str(landing), warehouse, languages, LATER)
    assert values(warehouse.read("movie"), "movie_id", "title") == [(1, "One again"), (2, "Two"), (3, "Three")]
    assert values(warehouse.read("people"), "people_id", "name", "birthday") == [(11, "A", date(1980, 1, 1)), (21, "D", None), (31, "N", None)]
    assert values(warehouse.read("collection"), "collection_id", "name") == [(10, "New"), (9, "C")]
    assert values(warehouse.read("video_stats"), "movie_id", "view_count") == [(1, 10), (2, 10), (3, 8)]
    chart = warehouse.read("weekly_domestic_performance")
    n_chart = chart.count()
    assert (2, 60) in values(chart, "movie_id", "domestic_gross") and chart.where("movie_id = 3").count() == 1

    # the next week: changes again, a person's record anew, falling counts, and a late file of the week before
    _land(landing, "update_raw_people_20240108_20240115.ndjson", [
        {"people_id": 11, "changes": [{"key": "name", "items": [{"action": "updated", "value": "Aa"}]}]},
        {"people_id": 11, "changes": [{"key": "name", "items": [{"action": "updated", "value": "Ab"}]}]},
    ])
    _land(landing, "append_raw_people_20240108_20240115.ndjson", [{"id": 31, "name": "N", "popularity": 2.0}])
    _land(landing, "update_raw_movie_details_20240101_20240107.ndjson", [film(3, title="Three too early"), film(4, title="Four")])
    (landing / "raw_youtube_video_stats_20240108_20240115.csv").write_text("id,viewCount,likeCount,commentCount\nv3,4,1,1\n")
    for _ in range(2):
        warehouse_jobs.weekly_update(spark, str(landing), warehouse, languages, LATER)
    assert values(warehouse.read("movie"), "movie_id", "title") == [(1, "One again"), (2, "Two"), (3, "Three"), (4, "Four")]
    assert values(warehouse.read("people"), "people_id", "name", "birthday", "tmdb_popularity") == [
        (11, "Ab", date(1980, 1, 1), None), (21, "D", None, None), (31, "N", None, 2.0),
    ]
    assert (3, 4) in values(warehouse.read("video_stats"), "movie_id", "view_count")
    assert warehouse.read("weekly_domestic_performance").count() == n_chart


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    schema = schemas.record(id=schemas.LONG, v=schemas.STRING, seq=schemas.LONG)
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE)

    def ingest():
        ingest_files(
            spark, warehouse, "t", str(landing), "in_*.ndjson", "json", schema, ["seq"], str(tmp_path / "c"), NOW, files_per_batch=1
        )

    _land(landing, "in_1.ndjson", [{"id": 1, "v": "a", "seq": 1}, {"id": 1, "v": "b", "seq": 2}])
    _land(landing, "in_2.ndjson", [{"id": 2, "v": "c", "seq": 3}, {"id": 1, "v": "d", "seq": 4}])
    ingest()
    _land(landing, "in_3.ndjson", [{"id": 3, "v": "e", "seq": 5}])
    ingest()
    before = files(tmp_path)
    ingest()
    assert files(tmp_path) == before
    assert values(warehouse.read("t"), "id", "v") == [(1, "d"), (2, "c"), (3, "e")]
    _land(landing, "in_4.ndjson", [{"id": 3, "v": "late", "seq": 4}, {"id": 2, "v": None, "seq": 6}])
    ingest()
    assert values(warehouse.read("t"), "id", "v") == [(1, "d"), (2, None), (3, "e")]
    assert [r[0] for r in spark.createDataFrame([(-5, "a"), (None, None), (40, "b"), (3, "a")], "n int, s string").withColumn(
        "o", order_text(spark.createDataFrame([], "n int, s string"), ["n", "s"])).orderBy("o").select("n").collect()] == [None, -5, 3, 40]


def test_landed_parts_keep_name_window_and_rows(spark, tmp_path):
    """A landing is written by as many tasks as its rows have, and every part counts as a file of the window."""
    from filmgrid.registry.files import land

    land(spark, spark.range(100).repartition(4), str(tmp_path), "x_20240101_20240108.ndjson")
    paths = readers.file_paths(spark, str(tmp_path), "x_20240101_20240108", "ndjson")
    assert len(paths) == 4 and all(readers.has_window(p) for p in paths)
    rows = readers.read_ordered(spark, paths, "ndjson", schemas.record(id=schemas.LONG))
    assert sorted(r.id for r in rows.collect()) == list(range(100))
    assert {r._order[:8] for r in rows.collect()} == {"20240108"}


def test_video_keys_come_from_the_files_of_the_window(spark):
    from filmgrid.registry.files import video_key_worklist, video_key_worklist_all_windows

    folder = "/root/testdata/sf0.001"
    week, whole = video_key_worklist(spark, folder), video_key_worklist_all_windows(spark, folder)
    assert week.inputFiles() and all("update_raw_movie_details_20240101_20240108" in f for f in week.inputFiles())
    assert {"20240108.", "20240115."} == {f.rsplit("_", 1)[-1].split("-")[0].split("ndjson")[0] for f in whole.inputFiles()}
    found = {r.key for r in whole.collect()}
    assert {r.key for r in week.collect()} < found and any(int(key[1:]) % 2 for key in found)


def test_buckets_follow_the_size(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"some words of row {i}") for i in range(3000)], "id long, v string")
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE, buckets=2, bucket_bytes=4000)
    warehouse.load("t", rows, NOW, "truncate")
    n = warehouse.buckets_of("t")
    assert n > 2 and len({r[0] for r in warehouse._stored("t").select("bucket").distinct().collect()}) == n
    # opened with another number it is read and merged with its own
    other = Warehouse(spark, str(tmp_path / "w"), SIMPLE, buckets=7)
    other.upsert("t", rows.where("id < 5").withColumn("v", F.lit("new")), LATER)
    assert other.buckets_of("t") == n and other.read("t").count() == 3000 and other.read("t").where("v = 'new'").count() == 5


def test_tables_that_outgrow_their_buckets(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE, buckets=2, bucket_bytes=4000)
    rows = spark.createDataFrame([(i, f"some words of row {i}") for i in range(3000)], "id long, v string")
    warehouse.load("t", rows.where("id < 10"), NOW, "append", load_id="one")
    assert not warehouse.fit("t")
    warehouse.load("t", rows.where("id >= 10"), NOW, "append", load_id="two")
    assert warehouse.fit("t") and warehouse.buckets_of("t") > 4 and not warehouse.fit("t")
    assert warehouse.read("t").count() == 3000
    warehouse.load("t", rows.where("id = 10"), LATER, "append", load_id="two")  # loads are still told apart
    assert warehouse.read("t").count() == 11
    warehouse.rebucket("t", 3)
    assert warehouse.buckets_of("t") == 3 and warehouse.read("t").count() == 11
    warehouse.truncate("t")
    warehouse.upsert("t", rows, NOW)
    assert warehouse.buckets_of("t") == 2 and warehouse.read("t").count() == 3000


def test_bad_lines_are_put_aside(spark, tmp_path):
    landing, rejects = tmp_path / "landing", str(tmp_path / "rejects")
    landing.mkdir()
    schema = schemas.record(id=schemas.LONG, v=schemas.STRING, seq=schemas.LONG)
    warehouse = Warehouse(spark, str(tmp_path / "w"), SIMPLE)

    def ingest(checkpoint="c", rejects=rejects):
        ingest_files(spark, warehouse, "t", str(landing), "in_*.ndjson", "json", schema, ["seq"], str(tmp_path / checkpoint), NOW, files_per_batch=1, rejects=rejects)

    good = '{"id": 1, "v": "a", "seq": 1}'
    (landing / "in_1.ndjson").write_text(good + '\n{"id": 2, "v": "b", "se\n\n{"v": "no key", "seq": 3}\n{"id": "text", "seq": 1}\n')
    with pytest.raises(Exception, match="not a record of the schema|a key is missing"):
        ingest(rejects=None)
    assert warehouse.read("t").isEmpty()
    ingest()
    expected = [("in_1.ndjson", '{"id": "text", "seq": 1}'), ("in_1.ndjson", '{"id": 2, "v": "b", "se'), (None, '{"v":"no key","seq":3}')]
    assert values(read_rejects(spark, rejects), "file", "line") == sorted(expected, key=str)
    assert values(warehouse.read("t"), "id", "v") == [(1, "a")]
    ingest("another")  # the same batch once more, as after a failure
    assert read_rejects(spark, rejects).count() == 3 and values(warehouse.read("t"), "id", "v") == [(1, "a")]
    (landing / "in_2.ndjson").write_text('{"id": 3, "v": "c", "seq": 1}\n[\n')
    ingest()
    assert read_rejects(spark, rejects).count() == 4 and warehouse.read("t").count() == 2
    assert read_rejects(spark, str(tmp_path / "none")).isEmpty()
    with pytest.raises(ValueError, match="has no id"):
        warehouse.upsert("t", spark.createDataFrame([(None, "x")], "id long, v string"), NOW)


def test_a_table_of_one_file_is_dealt_out(spark, tmp_path, monkeypatch):
    """Texts for landing files are made by as many tasks as a table's rows keep busy; rows of one key stay in order."""
    monkeypatch.setattr(landings, "ROWS_A_TASK", 10)
    rows = [(None if i % 17 == 0 else i % 40, f"row {i:03d}") for i in range(120)]
    spark.createDataFrame(rows, "k long, v string").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    spark.createDataFrame([], "k long").write.parquet(str(tmp_path / "empty.parquet"))
    folder = landings.dealt(spark, str(tmp_path), {"t": "k", "empty": "k"})
    assert spark.read.parquet(f"{folder}/empty.parquet").isEmpty()
    made = spark.read.parquet(f"{folder}/t.parquet").select("k", "v", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place"))
    found = made.orderBy("file", "place").collect()
    assert sorted((r.k or -1, r.v) for r in found) == sorted((k or -1, v) for k, v in rows)
    assert len({r.file for r in found}) > 4
    for key in {k for k, _ in rows}:
        own = [r for r in found if r.k == key]
        assert len({r.file for r in own}) == 1 and [r.v for r in own] == sorted(r.v for r in own)
