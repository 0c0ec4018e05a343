"""Least squares with categories, cross-fitting and held-out intervals."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmgrid.operators import distribution, fixed_effects
from filmgrid.plans import prediction
from filmgrid.registry import prediction as registered
from filmgrid.registry import views
from filmgrid.session import written

SCHEMA = "id long, y double, x double, z double, a string, b long"


def rows_of(n, seed):
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        # one category holds a third of the rows, some are missing, one is empty
        a = "hot" if i % 3 == 0 else None if i % 11 == 0 else "" if i % 13 == 0 else f"a{i % 17}"
        b = None if i % 9 == 0 else int(i % 8)
        x, z = float(random.normal()), None if i % 10 == 0 else float(random.normal() + i % 5)
        y = 3 * x - 2 * (z or 0) + hash((a or "none")[:2]) % 7 + (b or 0) + float(random.normal())
        rows.append((i, None if i % 19 == 0 else y, x, z, a, b))
    return rows


def dense_fit(rows):
    """Fitted values by a dense solver."""
    known = [r for r in rows if r[1] is not None]
    z = [r[3] for r in known if r[3] is not None]
    fill = sum(z) / len(z)
    columns = [[1.0] * len(known), [r[2] for r in known], [fill if r[3] is None else r[3] for r in known]]
    for at in (4, 5):
        for value in {r[at] for r in known}:
            columns.append([float(r[at] == value) for r in known])
    matrix = np.array(columns).T
    solution = np.linalg.lstsq(matrix, np.array([r[1] for r in known]), rcond=None)[0]
    return dict(zip([r[0] for r in known], matrix @ solution)), solution[1:3]


def test_fit_is_the_least_squares_fit(spark):
    rows = rows_of(300, 1)
    frame = spark.createDataFrame(rows, SCHEMA)
    model = fixed_effects.fit(frame, "y", ["x", "z"], ["a", "b"])
    found = {r.id: r.prediction for r in model.predict(frame, "id").collect()}
    expected, slopes = dense_fit(rows)
    assert len(found) == 300 and all(abs(found[i] - value) < 1e-6 for i, value in expected.items())
    assert abs(model.slopes["x"] - slopes[0]) < 1e-6 and abs(model.slopes["z"] - slopes[1]) < 1e-6
    assert model.steps < 60


def test_effects_have_mean_zero_and_unknown_ones_count_nothing(spark):
    frame = spark.createDataFrame(rows_of(200, 2), SCHEMA)
    model = fixed_effects.fit(frame, "y", ["x", "z"], ["a", "b"])
    centres = model.effects.groupBy("role").agg((F.sum(F.col("effect") * F.col("n")) / F.sum("n")).alias("c"))
    assert all(abs(r.c) < 1e-9 for r in centres.collect())
    new = spark.createDataFrame([(1, None, 0.0, 0.0, "never seen", 999)], SCHEMA)
    assert abs(model.predict(new, "id").first().prediction - model.intercept) < 1e-9


def test_numbers_that_follow_from_others(spark):
    """Twice the same number and one that never changes: the fit stays that of one of them."""
    frame = spark.createDataFrame([(i, 2.0 * i + i % 3, float(i), float(i % 3)) for i in range(60)], "id long, y double, x double, r double")
    frame = frame.select("*", (F.col("x") * 5).alias("w"), F.lit(7.0).alias("k"))
    model = fixed_effects.fit(frame, "y", ["x", "w", "k"], ["r"])
    error = model.predict(frame, "id").agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error < 1e-6 and model.slopes["k"] == 0


def test_fit_of_little(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fixed_effects.fit(empty, "y", ["x"], ["a"]).intercept == 0.0
    one = spark.createDataFrame([(1, 5.0, None, None, None, None), (1, 5.0, None, None, None, None)], SCHEMA)
    model = fixed_effects.fit(one, "y", ["x", "z"], ["a", "b"])
    assert [round(r.prediction, 9) for r in model.predict(one, "id").collect()] == [5.0, 5.0]
    with pytest.raises(ValueError, match="role"):
        fixed_effects.fit(one, "y", ["x"], [])


def test_a_fit_that_does_not_get_there_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(fixed_effects, "MAX_STEPS", 1)
    with pytest.raises(ValueError, match="no fit after 1 steps"):
        fixed_effects.fit(spark.createDataFrame(rows_of(100, 3), SCHEMA), "y", ["x"], ["a", "b"])


def films(spark, n=90):
    rows = [(i, float(i % 7 * 10 + i % 2), float(i % 7), f"c{i % 5}", None, f"d{i % 2}", "p") for i in range(n)]
    schema = "movie_id long, label double, budget double, cast1_id string, cast2_id string, director_id string, producer_id string"
    return spark.createDataFrame(rows, schema)


def fold_of(i, folds=3):
    return int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % folds


def test_folds_follow_from_the_id(spark):
    found = spark.range(200).select("id", prediction.fold(F.col("id")).alias("fold")).collect()
    assert all(r.fold == fold_of(r.id) for r in found) and {r.fold for r in found} == {0, 1, 2}


def test_person_means_leave_the_own_fold_out(spark):
    rows = films(spark).collect()
    found = {r.movie_id: r for r in prediction.person_means_out_of_fold(films(spark)).collect()}
    prior = prediction.PRIOR_FILMS
    for row in rows:
        others = [r for r in rows if fold_of(r.movie_id) != fold_of(row.movie_id)]
        mean = sum(r.label for r in others) / len(others)
        for role, key in prediction.ROLES.items():
            same = [r.label for r in others if row[key] is not None and r[key] == row[key]]
            assert math.isclose(found[row.movie_id][f"{role}_mean"], (sum(same) + prior * mean) / (len(same) + prior))


def test_cross_fitting_does_not_see_the_own_fold(spark):
    """A model that learns the labels by heart has none for its own fold."""
    seen = []

    class Heart:
        def __init__(self, training):
            self.known = {r.movie_id for r in training.collect()}
            seen.append(self.known)

        def transform(self, features):
            return features.withColumn("predicted_revenue", F.when(F.col("movie_id").isin(self.known), 1.0).otherwise(0.0))

    found = prediction.cross_fit(Heart, films(spark)).collect()
    assert len(found) == 90 and all(r.predicted_revenue == 0.0 and r.fold == fold_of(r.movie_id) for r in found)
    assert sorted(map(len, seen)) == sorted(90 - sum(fold_of(i) == f for i in range(90)) for f in range(3))


def test_conformal_margin(spark):
    errors = [float(x) for x in range(1, 20)]
    frame = spark.createDataFrame([(e if i % 2 else -e, 0.0) for i, e in enumerate(errors)], "label double, predicted_revenue double")
    assert prediction.conformal_margin(frame, 0.9) == 18.0  # ceil(20 x 0.9)
    assert prediction.conformal_margin(frame, 0.5) == 10.0
    assert prediction.conformal_margin(frame.limit(3), 0.9) is None
    assert prediction.conformal_margin(frame.limit(0), 0.9) is None


def test_nth_smallest_with_ties(spark):
    frame = spark.createDataFrame([(float(x),) for x in [5, 1, 1, 1, 9, 5]] + [(None,), (float("nan"),)], "x double")
    assert [distribution.nth_smallest(frame, "x", lambda n, k=k: k) for k in range(0, 8)] == [None, 1.0, 1.0, 1.0, 5.0, 5.0, 9.0, None]


def test_forecast_features_take_films_that_are_made(spark):
    """Films written once serve both training tables: their sales are not summed again."""
    folder = "/root/testdata/sf0.001"
    films = written(views.movies(spark, folder), "films")
    made, anew = registered._forecast(spark, folder, films), registered._forecast(spark, folder)
    assert not any("lineitem" in f for f in made.inputFiles()) and any("lineitem" in f for f in anew.inputFiles())
    assert sorted(map(str, made.collect())) == sorted(map(str, anew.collect()))
