from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmgrid import schemas
from filmgrid.functions import dates, html, nested, numbers, text
from filmgrid.operators import calendar
from filmgrid.registry.columns import chart_pages


@pytest.mark.parametrize(
    "title, cleaned",
    [
        ("  Spider-Man:  No Way Home ", "spider man no way home"),
        ("Who?", "who "),
        ("¡Ay!", " ay "),
        ("Amélie", "amélie"),
        ("千と千尋", "千と千尋"),
        ("M³GAN ½", "m³gan ½"),
        ("　Tenet ", "tenet"),
        ("a_b", "a_b"),
        ("", ""),
        (None, None),
    ],
)
def test_normalise_title(one, title, cleaned):
    assert one(text.normalise_title(F.col("t")), t=title) == cleaned


def test_normalised_title_is_stable(one):
    once = one(text.normalise_title(F.col("t")), t="A -- B!c")
    assert one(text.normalise_title(F.col("t")), t=once) == once


@pytest.mark.parametrize(
    "title, flag",
    [
        ("Avatar (2021 Re-release)", 1),
        ("Jaws 20th Anniversary", 1),
        ("Jaws 4K Restoration", 1),
        ("20th Anniversary", 0),
        ("Jaws", 0),
        ("The 4K Restoration", 1),
        (None, None),
    ],
)
def test_rerelease(one, title, flag):
    assert one(text.is_rerelease(F.col("t")), t=title) == flag


def test_numbers_in_text(one):
    assert one(text.parse_money(F.col("t")), t="$1,234,567") == 1234567
    assert one(text.parse_count(F.col("t")), t="-") == 0
    assert one(text.parse_count(F.col("t")), t="3,210") == 3210
    assert [one(text.parse_weeks(F.col("t")), t=t) for t in ("4", "-", None)] == [4, 0, 0]
    for bad in (text.parse_money(F.lit("n/a")), text.parse_weeks(F.lit("x"))):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            one(bad, t="")


def test_display(one):
    assert one(text.as_usd(F.col("v")), v=1234567.5) == "$1,234,567.50"
    assert [one(text.as_rating(F.col("v")), v=v) for v in (7.35, 7.85, 7.75, 8.0)] == ["7.3", "7.8", "7.8", "8.0"]
    assert one(text.as_count(F.col("v")), v=10123.0) == "10,123"
    assert one(text.week_label(F.col("v")), v=5) == "05"
    assert one(text.parse_string_list(F.col("v")), v="['Action', 'Drama']") == ["Action", "Drama"]
    assert one(text.first_token(F.col("v"), "__"), v="abc__def") == "abc"
    assert one(text.compact_date(F.col("v")), v="2024-03-01") == "20240301"


@pytest.mark.parametrize("day, sunday", [("2024-03-03", 3), ("2024-03-04", 10), ("2024-03-07", 10), ("2024-03-10", 10)])
def test_sunday_week(one, day, sunday):
    assert one(dates.sunday_week(F.col("d")), d=date.fromisoformat(day)) == date(2024, 3, sunday)


def test_dates(one):
    assert one(dates.parse_date(F.col("d")), d="") is None
    assert one(dates.parse_date(F.col("d")), d="2024-02-29") == date(2024, 2, 29)
    with pytest.raises(Exception, match="CANNOT_PARSE|DateTime|parse"):
        one(dates.parse_date(F.col("d")), d="no date")
    assert one(dates.likely_release(F.col("d"), F.lit(2)), d=date(2024, 3, 28)) == date(2024, 3, 7)
    assert one(dates.last_sunday(F.col("d")), d=date(2024, 3, 3)) == date(2024, 3, 3)
    assert one(dates.last_sunday(F.col("d")), d=date(2024, 3, 9)) == date(2024, 3, 3)
    assert one(dates.first_friday(F.col("y")), y=2021) == date(2021, 1, 1)
    assert one(dates.first_friday(F.col("y")), y=2022) == date(2022, 1, 7)
    window = one(dates.update_window(F.col("d"), 3), d=date(2024, 5, 31))
    assert tuple(window) == (date(2024, 2, 24), date(2024, 2, 29))


def test_strict_window(one):
    centre = date(2024, 6, 15)
    for offset, inside in ((-45, False), (-44, True), (0, True), (44, True), (45, False)):
        moved = date.fromordinal(centre.toordinal() + offset)
        assert one(dates.strictly_within(F.col("d"), F.col("c"), 45), d=moved, c=centre) is inside


def test_numbers(one):
    assert [one(numbers.round_half_even(F.col("v")), v=v) for v in (0.5, 1.5, 2.5)] == [0, 2, 2]
    assert one(numbers.return_on_budget(F.col("r"), F.col("b")), r=3.0, b=0.0) is None
    assert one(numbers.return_on_budget(F.col("r"), F.col("b")), r=3.0, b=2.0) == 0.5
    assert one(numbers.to_number(F.col("v")), v="n/a") is None
    assert one(numbers.interval_low(F.col("v")), v=5.0) == 1.0
    assert one(numbers.interval_high(F.col("v")), v=0.0) == 10847621.34
    for value, flag in ((False, 0), (True, 1)):
        assert one(numbers.flag_unless_false(F.col("v")), v=value) == flag
    assert one(numbers.flag_unless_false(F.lit(None).cast("boolean")), v=0) == 1


def _released(one, json):
    schema = schemas.FILM_DETAILS["release_dates"].dataType
    return one(nested.shown_in_cinemas(F.from_json(F.col("j"), schema)), j=json)


def test_shown_in_cinemas(one):
    assert _released(one, '{"results":[{"release_dates":[{"type":1}]},{"release_dates":[{"type":4},{"type":3}]}]}')
    assert not _released(one, '{"results":[{"release_dates":[{"type":1}]}]}')
    assert not _released(one, None)
    assert not _released(one, '{"results":null}')
    assert _released(one, '{"results":[{"release_dates":null},{"release_dates":[{"type":3}]}]}')


def test_cast_and_crew(one):
    crew = F.from_json(F.col("j"), "array<struct<id:bigint,job:string>>")
    people = '[{"id":1,"job":"Director"},{"id":2,"job":"Editor"},{"id":3,"job":"Director"}]'
    assert one(nested.last_with_job(crew, "Director"), j=people) == 3
    assert one(nested.last_with_job(crew, "Producer"), j=people) is None
    assert one(nested.id_at(crew, 2), j=people) == 2
    assert one(nested.id_at(crew, 2), j="[]") is None
    assert one(nested.size_or_zero(crew), j=None) == 0


def test_trailers(one):
    videos = F.from_json(F.col("j"), "array<struct<key:string,type:string>>")
    assert one(nested.trailer_keys(videos), j="[]") is None
    assert one(nested.trailer_keys(videos), j='[{"key":"a","type":"Clip"}]') == []
    assert one(nested.trailer_keys(videos), j='[{"key":"a","type":"Clip"},{"key":"b","type":"Trailer"}]') == ["b"]


def test_changes(one):
    changes = F.from_json(F.col("j"), schemas.PEOPLE_CHANGES["changes"].dataType)
    log = (
        '[{"key":"name","items":[{"action":"updated","value":"A"}]},'
        '{"key":"name","items":[{"action":"added","value":"B"},{"action":"updated","value":"C"}]},'
        '{"key":"gender","items":[{"action":"updated","value":"2"},{"action":"deleted","value":"2"}]}]'
    )
    kept = one(nested.kept_changes(changes), j=log)
    assert [tuple(c) for c in kept] == [("name", "A"), ("name", "C")]
    assert one(nested.last_value_for(nested.kept_changes(changes), "name"), j=log) == "C"


def test_overlap(spark):
    rows = spark.createDataFrame([(["a", "b"],), (["c"],), (None,)], "g array<string>")
    assert rows.where(nested.overlaps(F.col("g"), ["b", "x"])).count() == 1
    assert rows.where(nested.overlaps(F.col("g"), [])).count() == 3


def test_entities(one):
    decoded = html.decode_entities(F.array(F.col("t")))[0]
    cases = {
        "R&amp;D &lt;b&gt;": "R&D <b>",
        "caf&eacute; &#39;x&#39; &#x1F600;": "café 'x' 😀",
        "a &bogus; b & c": "a &bogus; b & c",
        "&amp;amp;": "&amp;",
        "plain": "plain",
    }
    broken = "\ufffd"
    cases |= {"&#9999999;|&#1114112;": f"{broken}|{broken}", "&#xD800;&#0;&#x110000;": broken * 3, "&#99999999999999999999;": broken}
    cases |= {"&#x000041;&#0000065;": "AA", "&#1114111;": "\U0010ffff"}
    for source, wanted in cases.items():
        assert one(decoded, t=source) == wanted


def test_calendar(spark):
    weeks = [tuple(r) for r in calendar.chart_calendar(spark, 2021, 2030).collect()]
    assert len(weeks) == 9 * 52
    assert all(end.weekday() == 3 for _, _, end in weeks)
    by_year = {(y, w): end for y, w, end in weeks}
    assert by_year[(2021, 1)] == date(2021, 1, 7)
    assert by_year[(2022, 52)] == date(2023, 1, 5)
    legacy = calendar.chart_calendar(spark, 2021, 2030, legacy_year=True)
    assert legacy.where("year = 2022 AND week = 52").count() == 0
    assert legacy.where("year = 2028 AND week = 52").count() == 0
    assert legacy.where("year = 2026 AND week = 52").count() == 2
    assert legacy.where("year = 2023 AND week = 52").first()[2] == date(2023, 1, 5)


@pytest.mark.parametrize(
    "week, wanted",
    [
        (1, [(2023, 48), (2023, 49), (2023, 50), (2023, 51)]),
        (3, [(2023, 50), (2023, 51), (2023, 52), (2024, 1)]),
        (5, [(2023, 52), (2024, 1), (2024, 2), (2024, 3)]),
        (6, [(2024, 1), (2024, 2), (2024, 3), (2024, 4)]),
        (52, [(2024, 47), (2024, 48), (2024, 49), (2024, 50)]),
        (53, [(2024, 48), (2024, 49), (2024, 50), (2024, 51)]),
    ],
)
def test_trailing_weeks(one, week, wanted):
    found = one(calendar.trailing_weeks(F.col("y"), F.col("w")), y=2024, w=week)
    assert [tuple(e) for e in found] == wanted


def test_load_ranges(one):
    run = F.lit(date(2024, 3, 13))  # ISO week 11
    weeks = lambda found: [e["week"] for e in found]
    assert weeks(one(calendar.weeks_to_reload(F.col("y"), run), y=2024)) == [6, 7, 8, 9]
    assert weeks(one(calendar.weeks_to_reload(F.col("y"), run), y=2023)) == [49, 50, 51, 52]
    assert weeks(one(calendar.weeks_to_load(F.col("y"), run), y=2024)) == list(range(1, 10))
    assert weeks(one(calendar.weeks_to_load(F.col("y"), run), y=2021)) == list(range(1, 53))
    assert weeks(one(calendar.weeks_to_load(F.col("y"), F.lit(date(2024, 1, 3))), y=2024)) == []
    assert weeks(one(calendar.weeks_to_load(F.col("y"), run), y=2025)) == []
    assert weeks(one(calendar.weeks_to_reload(F.col("y"), run), y=2025)) == []


def test_check_batch(one):
    run = F.lit(date(2024, 3, 13))  # tenth week counted from the first Sunday
    reason = lambda y, w: one(calendar.check_batch(F.col("y"), F.col("w"), run), y=y, w=w)
    assert reason(1981, 3) == "no charts before 1982"
    assert reason(2000, 53) == "week above 52"
    assert reason(2025, 3) == "year in the future"
    assert reason(2024, 10) == "week not closed yet"
    assert reason(2024, 9) is None
    assert reason(1982, 52) is None


def plain_elements(markup, tag):
    """Outermost elements by a parser that keeps a stack; only for markup whose tags are all closed."""
    import re

    found, depth, start = [], 0, 0
    for match in re.finditer(rf"<(/?){tag}\b[^>]*>", markup):
        depth += -1 if match[1] else 1
        if depth == 1 and not match[1]:
            start = match.start()
        if depth == 0:
            found.append(markup[start : match.end()])
    return found


def test_nested_elements(one):
    inner = "<table><tr><td>x</td><td>y</td></tr><tr><td>z</td></tr></table>"
    outer = f"<table class=a><tr><th>h</th></tr><tr><td>1{inner}2</td><td>3</td></tr></table><table><tr></tr></table>"
    found = lambda text, tag: one(html.elements(F.col("m"), tag), m=text)
    for tag in ("table", "tr", "td", "th"):
        assert found(outer, tag) == plain_elements(outer, tag)
    row = found(outer, "tr")[1]
    assert found(row, "td") == [f"<td>1{inner}2</td>", "<td>3</td>"]
    assert one(html.element_texts(F.col("m"), "td"), m=row) == ["1xyz2", "3"]
    lists = "<ul><li>a<ol><li>b</li><li>c</li></ol></li><li>d</li></ul><div><div>e</div></div><div>f</div>"
    assert found(lists, "li") == plain_elements(lists, "li") and found(lists, "div") == ["<div><div>e</div></div>", "<div>f</div>"]


def test_elements_without_end_tags(one):
    found = lambda text, tag: one(html.elements(F.col("m"), tag), m=text)
    rows = "<table><tbody><tr><td>1<td>2<table><tr><td>in</table><tr><th>3<td>4</tbody><tfoot><tr><td>5</table>after"
    assert found(rows, "tr") == ["<tr><td>1<td>2<table><tr><td>in</table>", "<tr><th>3<td>4", "<tr><td>5"]
    assert found("<tr><td>1<td>2<table><tr><td>in</table>", "td") == ["<td>1", "<td>2<table><tr><td>in</table>"]
    assert found("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "li") == ["<li>a", "<li>b<ul><li>c</ul>", "<li>d"]
    assert found("<div>a<div>b</div>", "div") == [] and found("</div><div>a</div></div>", "div") == ["<div>a</div>"]
    assert found("<!-- <td>no</td> --><TD>yes</TD >", "td") == ["<TD>yes</TD >"]
    assert found("", "td") == [] and one(html.elements(F.lit(None).cast("string"), "td"), m="") == []


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.recursive(st.just("x"), lambda inner: st.lists(inner, max_size=3).map(lambda xs: "<div>" + "".join(xs) + "</div>"), max_leaves=12), st.integers(0, 2))
def test_any_nesting(one, tree, n):
    text = "a" + tree * n + "b"
    assert one(html.elements(F.col("m"), "div"), m=text) == plain_elements(text, "div")


def test_chart_pages_are_dealt_out(spark):
    assert chart_pages(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() > 1
