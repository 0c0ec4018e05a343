import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmgrid.functions import text
from filmgrid.operators import competitors, dedup, distribution, lookup, merge, profile, reshape, resolve


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_keep_last(spark):
    df = spark.createDataFrame(
        [(1, None, 1, "a"), (1, None, 2, "b"), (2, "x", 1, "c"), (2, "x", None, "d")], "k int, l string, o int, v string"
    )
    assert rows(dedup.keep_last(df, ["k", "l"], ["o"]).select("v")) == [("b",), ("c",)]
    assert "WindowGroupLimit" in dedup.keep_last(df, ["k", "l"], ["o"])._jdf.queryExecution().toString()


def test_keep_last_ignores_file_split(spark):
    data = [(i % 7, i, str(i)) for i in range(100)]
    whole = spark.createDataFrame(data, "k int, o int, v string")
    split = spark.createDataFrame(data[:30], whole.schema).union(spark.createDataFrame(data[30:], whole.schema))
    assert rows(dedup.keep_last(whole, ["k"], ["o"])) == rows(dedup.keep_last(split.repartition(9), ["k"], ["o"]))


def test_latest_values(spark):
    log = spark.createDataFrame(
        [(1, "name", "A", 1), (1, "name", "B", 3), (1, "name", "C", 2), (1, "other", "x", 4), (2, "other", "y", 1), (3, "g", None, 1)],
        "id int, key string, value string, o int",
    )
    found = dedup.latest_values(log, "id", "key", "value", ["o"], {"name": "name", "g": "gender"})
    assert rows(found) == [(1, "B", None)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(dedup.union_by_name(a, b)) == [(1, "x", None), (None, "y", 2.0)]


def _chart(rng, titles, n):
    start = date(2021, 1, 7)
    found = []
    for _ in range(n):
        week = start + timedelta(weeks=rng.randrange(60))
        found.append((rng.choice(titles), week, week - timedelta(weeks=rng.randrange(1, 30)), rng.randrange(1, 9), rng.randrange(99), rng.randrange(9)))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_resolve_against_brute_force(spark, seed):
    rng = random.Random(seed)
    titles = ["hot"] * 6 + ["a", "b", "rare", None]
    chart = _chart(rng, titles, 400)
    films = [
        (rng.choice(["hot", "hot", "a", "b", None]), date(2021, 1, 1) + timedelta(days=rng.randrange(500)) if rng.random() > 0.1 else None, i)
        for i in range(60)
    ]
    best = {}
    for title, week, likely, rank, gross, theaters in chart:
        for name, released, film in films:
            if title is not None and title == name and released is not None:
                candidate = (abs((likely - released).days), film, rank, gross, theaters)
                key = (title, week)
                best[key] = min(best.get(key, candidate), candidate)
    wanted = [(t, w, f, r, g, c, d) for (t, w), (d, f, r, g, c) in best.items() if d <= 50]
    chart_df = spark.createDataFrame(chart, "title_cleaned string, week_end_date date, likely_release_date date, rank long, gross long, theaters long")
    films_df = spark.createDataFrame(films, "title_cleaned string, release_date date, movie_id long")
    found = resolve.resolve_chart(chart_df, films_df)
    assert rows(found) == sorted(wanted, key=str)
    assert wanted


def test_cut_off_days(spark):
    films = spark.createDataFrame([("x", date(2022, 1, 1), 1), ("y", date(2022, 1, 1), 2)], "title_cleaned string, release_date date, movie_id long")
    chart = spark.createDataFrame(
        [("x", date(2022, 3, 3), date(2022, 2, 20), 1, 1, 1), ("y", date(2022, 3, 3), date(2022, 2, 21), 1, 1, 1)],
        "title_cleaned string, week_end_date date, likely_release_date date, rank long, gross long, theaters long",
    )
    assert [(r.movie_id, r.days_diff) for r in resolve.resolve_chart(chart, films).collect()] == [(1, 50)]


def test_nearest_tie_goes_to_smaller_id(spark):
    films = spark.createDataFrame([("x", date(2022, 1, 1), 7), ("x", date(2022, 1, 11), 3)], "title_cleaned string, release_date date, movie_id long")
    wanted = spark.createDataFrame([("x", date(2022, 1, 6))], "title_cleaned string, day date")
    assert rows(resolve.nearest_films(wanted, films)) == [("x", date(2022, 1, 6), 5, 3)]


@pytest.mark.parametrize("crowd", [1000, 2])
def test_competitors_against_brute_force(spark, crowd):
    rng = random.Random(3)
    genres = ["hot", "a", "b", "c"]
    pick = lambda: rng.sample(genres, rng.randrange(0, 4))
    films = [(i, date(2020, 1, 1) + timedelta(days=rng.randrange(400)), pick() if rng.random() > 0.1 else None) for i in range(150)]
    plans = [(i, date(2020, 1, 1) + timedelta(days=rng.randrange(400)), pick() + ["hot", "hot"] if i % 3 else []) for i in range(30)]
    wanted = [
        (p, f) for p, centre, chosen in plans for f, day, has in films
        if abs((day - centre).days) < 45 and (not chosen or set(chosen) & set(has or []))
    ]
    planned = spark.createDataFrame(plans, "plan_id int, plan_date date, plan_genres array<string>")
    movies = spark.createDataFrame(films, "movie_id int, release_date date, genres array<string>")
    found = competitors.competitors(planned, movies, crowd).select("plan_id", "movie_id")
    assert rows(found) == sorted(wanted, key=str)


@pytest.mark.parametrize("rest", [1, 10_000])
@pytest.mark.parametrize("kind", ["normal", "ties", "constant", "heavy", "short"])
def test_exact_quantiles(spark, kind, rest, monkeypatch):
    monkeypatch.setattr(distribution, "REST", rest)
    rng = np.random.default_rng(5)
    values = {
        "normal": rng.normal(size=5000),
        "ties": np.concatenate([np.full(2000, 1.0), rng.integers(0, 5, 3000).astype(float)]),
        "constant": np.full(300, 2.5),
        "heavy": np.exp(rng.normal(size=5000) * 8),
        "short": np.array([1.0, 2.0, 4.0]),
    }[kind]
    data = [(float(v),) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(data, "v double").repartition(5)
    shares = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    found = distribution.exact_quantiles(df, "v", shares)
    assert np.allclose(found, np.quantile(values, shares), rtol=1e-12)


def test_density_repeats_no_rows(spark):
    curve = distribution.density(spark.createDataFrame([(1.0,), (2.0,), (2.0,), (4.0,)], "v double"), "v", 10)
    plan = curve._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and curve.count() == 11  # only the grid is spread, after the sums


def test_grid_of_many_names(spark):
    """More names than a pivot would take, and no job before the grid is asked for."""
    df = spark.range(12_000).select((F.col("id") % 2).alias("w"), F.col("id").cast("string").alias("g"), F.lit(1.0).alias("v"))
    spark.sparkContext.setJobGroup("grid", "grid")
    grid = reshape.full_grid(df, "w", "g", "v")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("grid")
    assert tuple(grid.agg(F.count("*"), F.count("v")).first()) == (24_000, 12_000)


def test_empty_genre_is_a_genre(spark):
    plans = [(1, date(2024, 1, 1), []), (2, date(2024, 1, 1), [""]), (3, date(2024, 1, 1), None)]
    planned = spark.createDataFrame(plans, "plan_id int, plan_date date, plan_genres array<string>")
    films = spark.createDataFrame([(1, date(2024, 1, 2), ["", "a"]), (2, date(2024, 1, 2), ["a"])], "movie_id int, release_date date, genres array<string>")
    assert rows(competitors.competitors(planned, films).select("plan_id", "movie_id")) == [(1, 1), (1, 2), (2, 1), (3, 1), (3, 2)]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert distribution.exact_quantiles(empty, "v", [0.5]) == [None]
    assert distribution.trim(empty, "v").count() == 0
    assert distribution.density(empty, "v").count() == 0
    assert distribution.histogram(empty, "v").count() == 0


def test_histogram(spark):
    df = spark.createDataFrame([(v / 10,) for v in range(0, 1000)], "v double")
    bins = distribution.histogram(df, "v", 50).orderBy("bin_start").collect()
    assert len(bins) == 50 and all(math.isclose(b.bin_end - b.bin_start, 2.0) for b in bins)
    assert sum(b.n for b in bins) == 1000
    flat = distribution.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v").collect()
    assert [tuple(b) for b in flat] == [(3.0, 4.0, 2)]


def test_density_against_numpy(spark):
    values = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    q1, q3 = np.quantile(values, [0.25, 0.75])
    width = 1.06 * min(values.std(ddof=1), (q3 - q1) / 1.34) * len(values) ** -0.2
    for point in distribution.density(df, "v", 20).collect():
        wanted = np.exp(-0.5 * ((point.x - values) / width) ** 2).sum() / (len(values) * width * math.sqrt(2 * math.pi))
        assert math.isclose(point.density, wanted, rel_tol=1e-9)


def test_extremes_skip_nan_and_break_ties(spark):
    df = spark.createDataFrame(
        [(3, 1.0, "c"), (1, 5.0, "a"), (2, 5.0, "b"), (4, float("nan"), "d"), (5, None, "e")], "id int, v double, title string"
    )
    found = {(r.metric, r.extreme): (r.value, r.title) for r in distribution.extremes(df, ["v"], ["id"], ["title"]).collect()}
    assert found == {("v", "highest"): (5.0, "a"), ("v", "lowest"): (1.0, "c")}


def test_pivot_and_grid(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)], "w int, g string, v double")
    grid = reshape.full_grid(df, "w", "g", "v")
    assert rows(grid) == [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (2, "b", None)]
    assert rows(grid.dropna()) == rows(df)
    doubled = df.union(df)
    with pytest.raises(Exception, match="two values for one cell"):
        reshape.to_wide(doubled, "w", "g", "v", ["a", "b"]).collect()


def test_lookups(spark):
    people = spark.createDataFrame([(2, "Ann", 2.0), (1, "Ann", 1.0), (3, None, 9.0)], "id int, name string, p double")
    wanted = spark.createDataFrame([("Ann",), ("Bob",), (None,)], "who string")
    assert rows(lookup.find_values(wanted, "who", people, "name", "id", "p", "popularity")) == [("Ann", 1.0), ("Bob", None), (None, None)]
    films = spark.createDataFrame([(1, date(2024, 3, 31)), (2, date(2024, 2, 29)), (3, date(2024, 2, 28)), (4, None)], "movie_id int, release_date date")
    assert rows(lookup.released_in_last_month(films)) == [(1,), (2,)]
    ids = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "a double, b double")
    assert rows(lookup.distinct_ids(ids, ["a", "b"], "id")) == [(1,), (2,)]


TARGET = "id long, v string, w double, kept string"


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1.0, "k1"), (2, "b", 2.0, "k2"), (None, "n", 0.0, "kn")], TARGET)
    source = spark.createDataFrame([(2, None, 9.0), (3, "c", 3.0), (None, "m", 5.0)], "id long, v string, w double")
    merged = merge.upsert(target, source, ["id"])
    wanted = [(1, "a", 1.0, "k1"), (2, None, 9.0, "k2"), (3, "c", 3.0, None), (None, "m", 5.0, None), (None, "n", 0.0, "kn")]
    assert rows(merged) == sorted(wanted, key=str)
    known = source.where("id IS NOT NULL")
    once = merge.upsert(target, known, ["id"])
    assert rows(merge.upsert(once, known, ["id"])) == rows(once)
    assert rows(merge.upsert(target, source.limit(0), ["id"])) == rows(target)


def test_upsert_refuses_two_rows_for_one(spark):
    target = spark.createDataFrame([(1, "a", 1.0, "k")], TARGET)
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "id long, v string")
    with pytest.raises(Exception, match="several source rows"):
        merge.upsert(target, twice, ["id"]).collect()
    with pytest.raises(Exception, match="several source rows"):
        merge.update_known(target, twice, ["id"]).collect()
    new = spark.createDataFrame([(7, "x"), (7, "y")], "id long, v string")
    assert merge.upsert(target, new, ["id"]).count() == 3
    assert merge.update_known(target, new, ["id"]).count() == 1
    with pytest.raises(ValueError, match="missing from the target"):
        merge.upsert(target, twice.withColumnRenamed("v", "z"), ["id"])


def test_update_known(spark):
    target = spark.createDataFrame([(1, "a", 1.0, "k1"), (2, "b", 2.0, "k2")], TARGET)
    source = spark.createDataFrame([(2, None, 9.0), (3, "c", 3.0)], "id long, v string, w double")
    assert rows(merge.update_known(target, source, ["id"])) == [(1, "a", 1.0, "k1"), (2, "b", 9.0, "k2")]


def test_composite_key(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "i int, k string, v double")
    source = spark.createDataFrame([(1, "b", 5.0), (2, "a", 6.0)], "i int, k string, v double")
    assert rows(merge.upsert(target, source, ["i", "k"])) == [(1, "a", 1.0), (1, "b", 5.0), (2, "a", 6.0)]
    assert rows(merge.update_known(target, source, ["i", "k"])) == [(1, "a", 1.0), (1, "b", 5.0)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k int, v string")
    assert rows(profile.null_profile(df)) == [("k", 0), ("v", 1)]
    assert profile.has_duplicates(df, ["k"]) and not profile.has_duplicates(df)
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("a", 2)]
    state = profile.series_state(spark.createDataFrame([(0.0,), (None,), (0.0,)], "v double"), "v").first()
    assert tuple(state) == (False, 1, 0, 0)


def test_text_helpers(one):
    assert one(text.join_list(F.array(F.lit("a"), F.lit("b"))), t="") == "a, b"
    assert one(text.contains_ignoring_case(F.col("t"), "Based On"), t="BASED ON novel") is True


def test_plans_are_copied_for_crowds_only(spark):
    """A genre of a season with ten times a crowd has ten places; elsewhere a plan meets its films in one."""
    films = spark.createDataFrame([(i, 1 if i < 100 else i, "x") for i in range(110)], "movie_id long, _bucket long, _genre string")
    cell = ["_bucket", "_genre"]
    places = competitors._places(films, cell, 10)
    assert rows(places) == [(1, "x", 10)]
    plan = spark.createDataFrame([(1, 1, "x"), (2, 105, "x"), (3, 7, "x")], "plan_id long, _bucket long, _genre string")
    met = competitors._met(plan, films, cell, 10)
    assert rows(met.groupBy("plan_id").agg(F.count("*").alias("n"), F.countDistinct("movie_id").alias("d"))) == [(1, 100, 100), (2, 1, 1)]


def test_grid_parts_follow_its_size(spark):
    df = spark.createDataFrame([(w, g, w * g) for w in range(10) for g in range(12) if (w + g) % 3], "w int, g int, v int")
    whole = rows(reshape.full_grid(df, "w", "g", "v"))
    assert len(whole) == 120
    for cells in (1, 7, 40):
        assert rows(reshape.full_grid(df, "w", "g", "v", part_cells=cells)) == whole
