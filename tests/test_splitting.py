"""Documents and files that several tasks read, cut anywhere."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from filmgrid import schemas
from filmgrid.sources import readers

RECORD = schemas.record(id=schemas.LONG, s=schemas.STRING, words=schemas.STRINGS, inner=schemas.record(a=schemas.LONG, t=schemas.STRING))


def rows_of(df, *columns):
    return sorted((json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.select(*(columns or df.columns)).collect()))


def expected(records):
    full = lambda r: {"id": r.get("id"), "s": r.get("s"), "words": r.get("words"), "inner": r.get("inner") and {"a": r["inner"].get("a"), "t": r["inner"].get("t")}}
    return sorted(json.dumps(full(r), sort_keys=True) for r in records)


@pytest.fixture
def small_blocks(spark):
    """Tasks of a hundred bytes, so that they begin in strings, keys, numbers and between backslash and quote."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


TRICKY = ["", "}", "{", '"', "\\", '\\"}', "}{][", "a,b", "line\nfeed", "é日😀}", "\\\\", '{"k": "}"}', "]", " "]


def some_records(n, seed):
    dice = random.Random(seed)
    records = []
    for i in range(n):
        record = {"id": i, "s": "".join(dice.choices(TRICKY, k=dice.randint(0, 6)))}
        if dice.random() < 0.6:
            record["words"] = dice.choices(TRICKY, k=dice.randint(0, 4))
        if dice.random() < 0.6:
            record["inner"] = {"a": i, "t": dice.choice(TRICKY)}
        records.append(record)
    return records


@pytest.mark.parametrize("indent", [None, 1])
def test_keyed_document_cut_anywhere(spark, small_blocks, tmp_path, indent):
    keyed = {f"k{i}" + TRICKY[i % len(TRICKY)]: r for i, r in enumerate(some_records(60, 1))}
    (tmp_path / "a.json").write_text(json.dumps(keyed, indent=indent, ensure_ascii=False) + "\n \n", encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"x": {"id": 1}}))
    read = readers.read_keyed_json(spark, str(tmp_path / "*.json"), RECORD)
    assert read.rdd.getNumPartitions() >= 1
    found = {(r._file, r._key): r.id for r in read.collect()}
    assert found == {("a.json", k): r["id"] for k, r in keyed.items()} | {("b.json", "x"): 1}
    assert rows_of(read.where("_file = 'a.json'"), *RECORD.names) == expected(keyed.values())


@pytest.mark.parametrize("indent", [None, 2])
def test_array_document_cut_anywhere(spark, small_blocks, tmp_path, indent):
    records = some_records(60, 2)
    (tmp_path / "a.json").write_text(json.dumps(records, indent=indent) + "\n")
    (tmp_path / "b.json").write_text("\n [ ] ")
    (tmp_path / "c.json").write_text(json.dumps({"id": 7, "inner": {"a": 1, "t": "}"}, "s": "{"}) + "\n")
    whole = spark.read.schema(RECORD).options(multiLine=True, mode="FAILFAST").json(str(tmp_path / "*.json"))
    read = readers.read_json_document(spark, str(tmp_path / "*.json"), RECORD)
    assert rows_of(read) == expected([*records, {"id": 7, "inner": {"a": 1, "t": "}"}, "s": "{"}]) == rows_of(whole)


def test_entries_that_are_no_objects(spark, small_blocks, tmp_path):
    (tmp_path / "a.json").write_text('{"a": null, "b": {"id": 2}, "c": null, "d": {"id": 4}, "e": null}')
    (tmp_path / "b.json").write_text("{}")
    found = {r._key: r.id for r in readers.read_keyed_json(spark, str(tmp_path / "*.json"), RECORD).collect()}
    assert found == {"a": None, "b": 2, "c": None, "d": 4, "e": None}
    (tmp_path / "l.json").write_text('[null, {"id": 2}, null, {"id": 3}, null]')
    assert sorted(r.id for r in readers.read_json_document(spark, str(tmp_path / "l.json"), RECORD).collect()) == [2, 3]


@pytest.mark.parametrize("text", ['{"a": {"id": 1}, "b": {"id": 2}', '{"a": {"id": 1}, "b": {"id": "x', '[{"id": 1}, {"id": 2}', '{"a": {"id": 1}}}'])
def test_documents_that_do_not_end(spark, small_blocks, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="ends inside a record|MALFORMED|malformed|Malformed"):
        (readers.read_json_document if text[0] == "[" else readers.read_keyed_json)(spark, str(tmp_path / "a.json"), RECORD).collect()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text(max_size=8), st.fixed_dictionaries({"id": st.integers(-9, 9), "s": st.text(max_size=30)}), max_size=12))
def test_any_keyed_document(spark, small_blocks, tmp_path_factory, keyed):
    path = tmp_path_factory.mktemp("doc") / "a.json"
    path.write_text(json.dumps(keyed))
    found = {r._key: (r.id, r.s) for r in readers.read_keyed_json(spark, str(path), RECORD).collect()}
    assert found == {k: (r["id"], r["s"]) for k, r in keyed.items()}


def test_one_document_is_read_by_many_tasks(spark, small_blocks, tmp_path):
    from filmgrid.sources import json_split

    (tmp_path / "a.json").write_text(json.dumps({str(i): {"id": i} for i in range(300)}))
    pieces = json_split._pieces(spark, str(tmp_path / "a.json"))
    assert pieces.rdd.getNumPartitions() > 10 and pieces.select("block").distinct().count() > 10


CSV = schemas.record(id=schemas.LONG, s=schemas.STRING, t=schemas.STRING)
FIELDS = ["", "a", 'say "hi"', "line\nfeed", "\n", '"\n"', "a,b", "é日😀", "\n\n\"", " x ", "back\\slash", '""']


def write_rows(path, rows, header=("id", "s", "t"), end="\n"):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def csv_rows(df):
    return sorted((r.id, r.s, r.t) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_line_feeds_cut_anywhere(spark, small_blocks, tmp_path, end):
    dice = random.Random(5)
    rows = [(i, "x" + dice.choice(FIELDS), "y" + "".join(dice.choices(FIELDS, k=3))) for i in range(80)]
    write_rows(tmp_path / "a.csv", rows[:50], end=end)
    write_rows(tmp_path / "b.csv", rows[50:], end=end)
    found = readers.read_csv(spark, str(tmp_path / "*.csv"), CSV, multi_line=True)
    assert csv_rows(found) == rows
    whole = spark.read.schema(CSV).options(header=True, escape='"', multiLine=True, mode="FAILFAST").csv(str(tmp_path / "*.csv"))
    if end == "\n":
        assert csv_rows(whole) == rows


def test_csv_lines_stay_in_their_task(spark, small_blocks, tmp_path):
    """Only what reaches beyond a block is shuffled, by one exchange; the lines used to go through windows and joins."""
    write_rows(tmp_path / "a.csv", [(i, "line\nfeed" * 20, str(i)) for i in range(20)])
    read = readers.read_csv(spark, str(tmp_path / "a.csv"), CSV, multi_line=True)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert sorted(r.id for r in read.collect()) == list(range(20))


def test_csv_nulls_empty_lines_and_order_of_columns(spark, small_blocks, tmp_path):
    (tmp_path / "a.csv").write_text('t,extra,id,s\n"q\n",1,1,\n\n,2,2,"x"\n\n\n"",3,,z')
    found = readers.read_csv(spark, str(tmp_path / "a.csv"), CSV, multi_line=True)
    whole = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "a.csv")).selectExpr("cast(id as long) id", "s", "t")
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert sorted(found.collect(), key=key)[0].id == 1


def test_csv_that_is_refused(spark, small_blocks, tmp_path):
    write_rows(tmp_path / "a.csv", [(1, "a", "b")])
    write_rows(tmp_path / "b.csv", [(2, "a", "b")], header=("id", "t", "s"))
    with pytest.raises(Exception, match="another header"):
        readers.read_csv(spark, str(tmp_path / "*.csv"), CSV, multi_line=True).collect()
    (tmp_path / "c.csv").write_text('id,s,t\n1,"a,b\n2,c,d\n')
    with pytest.raises(Exception, match="ends inside of a quoted field"):
        readers.read_csv(spark, str(tmp_path / "c.csv"), CSV, multi_line=True).collect()
    (tmp_path / "d.csv").write_text("id,s,t\nx,c,d\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_csv(spark, str(tmp_path / "d.csv"), CSV, multi_line=True).collect()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 99), st.text(st.sampled_from('ab",\n'), min_size=1), st.text(st.sampled_from('"\nc'), min_size=1)), max_size=20))
def test_any_csv(spark, small_blocks, tmp_path_factory, rows):
    path = tmp_path_factory.mktemp("csv") / "a.csv"
    write_rows(path, rows)
    assert csv_rows(readers.read_csv(spark, str(path), CSV, multi_line=True)) == sorted(rows)
