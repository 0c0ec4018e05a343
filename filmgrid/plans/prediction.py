"""Revenue prediction with ``pyspark.ml``: training tables, models, scoring, interval.

Person ids are categories of which there may be any number, and an index of them would have to pass through the driver.
The linear model solves for an effect of every person in every role (``operators.fixed_effects``); the forest gets, for
each role, the mean revenue of the person's other films, looked up by a join. Models are judged on films that they have
not seen: ``cross_fit`` trains one model for each fold without that fold, and a margin comes from the errors there.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.functions import numbers
from filmgrid.operators import distribution, fixed_effects, lookup
from filmgrid.session import written

#: parts that films are dealt into by their id
FOLDS = 3
#: films that the mean over all of them counts for in a person's mean
PRIOR_FILMS = 5
ROLES = {"cast1": "cast1_id", "cast2": "cast2_id", "director": "director_id", "producer": "producer_id"}
CALENDAR = ["release_year", "release_month", "release_day"]
IDENTITY_NUMBERS = ["budget", "runtime", "tmdb_vote_count", *CALENDAR]
FORECAST_NUMBERS = [
    "budget",
    "runtime",
    "is_adult",
    "is_adaptation",
    *[f"{role}_popularity" for role in ROLES],
    "view_count",
    "avg_popularity_before_2020",
    *CALENDAR,
]


def with_release_parts(df: DataFrame) -> DataFrame:
    """A date as the numbers a model can use: year, month, day of the year."""
    day = F.col("release_date")
    return df.withColumns({"release_year": F.year(day), "release_month": F.month(day), "release_day": F.dayofyear(day)})


def identity_features(movies: DataFrame) -> DataFrame:
    """Film features with the four person ids as categories; the label is the revenue."""
    ids = [numbers.as_category(F.col(c)).alias(c) for c in ROLES.values()]
    films = movies.select("movie_id", F.col("revenue").alias("label"), "budget", "release_date", "runtime", "tmdb_vote_count", *ids)
    return with_release_parts(films)


def forecast_features(movies: DataFrame, people: DataFrame, collections: DataFrame, video_stats: DataFrame) -> DataFrame:
    """What is known about a film before it opens, with its revenue as the label.

    A film's view count is that of its most viewed trailer.
    """
    features = movies.select(
        "movie_id", F.col("revenue").alias("label"), "budget", "release_date", "runtime", "is_adult", "is_adaptation",
        "collection_id", *ROLES.values(),
    )
    # all roles in one join: a row for each film and role, folded back to the film
    ids = movies.select("movie_id", *[F.col(c).cast("bigint").alias(c) for c in ROLES.values()])
    roles = ids.unpivot("movie_id", list(ROLES.values()), "role", "people_id").where("people_id IS NOT NULL")
    known = roles.join(people.select("people_id", "tmdb_popularity"), "people_id")
    popularity = lambda key: F.max(F.when(F.col("role") == key, F.col("tmdb_popularity")))
    folded = known.groupBy("movie_id").agg(*[popularity(key).alias(f"{role}_popularity") for role, key in ROLES.items()])
    features = features.join(folded, "movie_id", "left")
    series = collections.select("collection_id", "avg_popularity_before_2020")
    views = video_stats.groupBy("movie_id").agg(F.max("view_count").alias("view_count"))
    features = features.join(series, "collection_id", "left").join(views, "movie_id", "left")
    return with_release_parts(features.drop("collection_id", *ROLES.values()))


def planned_features(planned: DataFrame, people: DataFrame, collections: DataFrame) -> DataFrame:
    """Planned films as filled in on a form, with names replaced by what is known about them.

    ``planned`` has ``budget, release_date, runtime, is_adult, is_adaptation`` (``Yes``/``No``), a name per role,
    ``series`` and ``view_count``. Unknown names give null.
    """
    features = planned.withColumns({c: numbers.yes_no(F.col(c)) for c in ("is_adult", "is_adaptation")})
    for role in ROLES:
        features = lookup.find_values(features, role, people, "name", "people_id", "tmdb_popularity", f"{role}_popularity")
    features = lookup.find_values(
        features, "series", collections, "name", "collection_id", "avg_popularity_before_2020", "avg_popularity_before_2020"
    )
    return with_release_parts(features.drop(*ROLES, "series"))


def parameter_row(spark, values: dict, schema) -> DataFrame:
    """One row of typed parameters; a missing value is a typed null."""
    return spark.createDataFrame([tuple(values.get(name) for name in schema.names)], schema)


def _numbers(training: DataFrame, columns: Sequence[str]) -> list:
    """Stages that make ``*_number`` columns: doubles, with the training mean for missing values and NaN.

    A column without any value in the training set is 0 everywhere, as it has no mean.
    """
    present = [F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).alias(c) for c in columns]
    counts = training.agg(*present).first()
    known = [c for c in columns if counts[c]]
    casts = [f"CAST({c} AS DOUBLE) AS {c}_number" if c in known else f"0D AS {c}_number" for c in columns]
    names = [f"{c}_number" for c in known]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(casts)} FROM __THIS__")]
    return stages + ([Imputer(strategy="mean", inputCols=names, outputCols=names)] if known else [])


def _fit(training: DataFrame, columns: Sequence[str], regressor) -> PipelineModel:
    known = training.where("label IS NOT NULL")
    stages = [*_numbers(known, columns), VectorAssembler(inputCols=[f"{c}_number" for c in columns], outputCol="features"), regressor]
    return Pipeline(stages=stages).fit(known)


@dataclass(frozen=True)
class LinearModel:
    """Slopes of the numbers and an effect of each person in each role."""

    model: fixed_effects.EffectsModel

    def transform(self, features: DataFrame) -> DataFrame:
        return self.model.predict(features, "movie_id", "predicted_revenue")


def train_linear(training: DataFrame) -> LinearModel:
    """Least squares over numbers and person ids, solved until the equations hold."""
    return LinearModel(fixed_effects.fit(training, "label", IDENTITY_NUMBERS, list(ROLES.values())))


def train_line(training: DataFrame, column: str) -> PipelineModel:
    """Linear regression over one number, solved exactly."""
    return _fit(training, [column], LinearRegression(solver="normal", predictionCol="predicted_revenue"))


@dataclass(frozen=True)
class PeopleModel:
    """A model over numbers and the mean revenue of the people, with the table of means that it was trained with."""

    model: PipelineModel
    totals: DataFrame
    mean: float

    def transform(self, features: DataFrame) -> DataFrame:
        return self.model.transform(with_person_means(features, self.totals, self.mean))


def person_totals(training: DataFrame) -> DataFrame:
    """``(role, person, total, films)``: summed labels and number of films of every person in every role."""
    roles = training.where("label IS NOT NULL").unpivot(["movie_id", "label"], list(ROLES.values()), "role", "person")
    return roles.where("person IS NOT NULL").groupBy("role", "person").agg(F.sum("label").alias("total"), F.count("label").alias("films"))


def with_person_means(features: DataFrame, totals: DataFrame, mean: float, own: bool = False) -> DataFrame:
    """Adds ``*_mean`` for each role: the mean label of the person's films, shrunk to ``mean`` where there are few.

    With ``own`` a row's own label is left out, as it must be in training. Rows are told apart by ``movie_id``. One
    join looks up all roles.
    """
    label = F.col("label") if own else F.lit(None).cast("double")
    rows = features.select("movie_id", label.alias("label"), *ROLES.values())
    roles = rows.unpivot(["movie_id", "label"], list(ROLES.values()), "role", "person").where("person IS NOT NULL")
    joined = roles.join(totals, ["role", "person"], "left")
    total = F.coalesce("total", F.lit(0.0)) - F.coalesce("label", F.lit(0.0))
    films = F.coalesce("films", F.lit(0)) - F.when(F.col("label").isNotNull(), 1).otherwise(0)
    shrunk = (total + PRIOR_FILMS * mean) / (films + PRIOR_FILMS)
    of_role = lambda key: F.max(F.when(F.col("role") == key, F.col("shrunk")))
    folded = joined.withColumn("shrunk", shrunk).groupBy("movie_id").agg(*[of_role(key).alias(f"{role}_mean") for role, key in ROLES.items()])
    return features.join(folded, "movie_id", "left").na.fill(mean, [f"{role}_mean" for role in ROLES])


def train_forest(training: DataFrame, trees: int = 20, seed: int = 17) -> PeopleModel:
    """Random forest over numbers and, for each role, the mean revenue of the person's other films."""
    known = training.where("label IS NOT NULL").withColumn("label", F.col("label").cast("double"))
    totals = written(person_totals(known), "person-totals")
    mean = known.agg(F.avg("label")).first()[0] or 0.0
    regressor = RandomForestRegressor(numTrees=trees, seed=seed, predictionCol="predicted_revenue")
    columns = [*IDENTITY_NUMBERS, *[f"{role}_mean" for role in ROLES]]
    return PeopleModel(_fit(with_person_means(known, totals, mean, own=True), columns, regressor), totals, mean)


def train_forecast(training: DataFrame, trees: int = 20, seed: int = 17) -> PipelineModel:
    """Random forest over what is known before a film opens."""
    regressor = RandomForestRegressor(numTrees=trees, seed=seed, predictionCol="predicted_revenue")
    return _fit(training, FORECAST_NUMBERS, regressor)


def predict(model: PipelineModel | PeopleModel | LinearModel, features: DataFrame) -> DataFrame:
    """The rows with their predicted revenue; missing features are allowed."""
    return model.transform(features).select(*features.columns, "predicted_revenue")


def with_interval(predictions: DataFrame, margin: float = numbers.INTERVAL_MARGIN) -> DataFrame:
    value = F.col("predicted_revenue")
    return predictions.withColumns(
        {"lower_bound": numbers.interval_low(value, margin), "upper_bound": numbers.interval_high(value, margin)}
    )


def residual_margin(predictions: DataFrame, factor: float = 1.99) -> float | None:
    """Half-width of an interval from the errors on rows the model has not seen."""
    spread = predictions.agg(F.stddev_samp(F.col("label") - F.col("predicted_revenue"))).first()[0]
    return None if spread is None else factor * spread


def fold(row_id: Column, folds: int = FOLDS) -> Column:
    """The part that a row falls into: by a digest of its id, so the same in every run and on every engine."""
    return F.conv(F.substr(F.md5(row_id.cast("string").cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("long") % folds


def cross_fit(train: Callable[[DataFrame], object], features: DataFrame, folds: int = FOLDS) -> DataFrame:
    """The rows with their ``fold`` and ``predicted_revenue`` by a model that has not seen any row of that fold.

    ``train`` makes a model of a training table; whatever it derives from labels, such as a person's mean, so comes from
    the other folds alone. The models are independent and are trained side by side. Rows without an id are of the first
    fold. A fold whose other folds have no label has no predictions.
    """
    dealt = written(features.withColumn("fold", F.coalesce(fold(F.col("movie_id"), folds), F.lit(0))), "folds")

    def of_fold(number: int) -> DataFrame:
        rest, own = dealt.where(F.col("fold") != number), dealt.where(F.col("fold") == number)
        if rest.where("label IS NOT NULL").isEmpty():
            return own.withColumn("predicted_revenue", F.lit(None).cast("double"))
        return predict(train(rest.drop("fold")), own)

    with ThreadPoolExecutor(folds) as pool:
        return functools.reduce(DataFrame.unionByName, pool.map(of_fold, range(folds)))


def person_means_out_of_fold(training: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``(movie_id, fold, *_mean)``: for each role the mean label of the person's films in the other folds.

    Shrunk, where there are few, to the mean over all films of the other folds. Sums are kept by person and fold, so one
    aggregate serves all folds, and a film's own fold is taken off where it is looked up.
    """
    rows = training.select("movie_id", F.col("label").cast("double").alias("label"), *ROLES.values(), fold(F.col("movie_id"), folds).alias("fold"))
    known = rows.where("label IS NOT NULL")
    whole = known.groupBy("fold").agg(F.sum("label").alias("total"), F.count("label").alias("films")).collect()  # one row a fold
    rest = lambda number: [sum(r[c] for r in whole if r["fold"] != number) for c in ("total", "films")]
    means = {number: rest(number)[0] / rest(number)[1] if rest(number)[1] else 0.0 for number in range(folds)}
    prior = F.element_at(F.array(*[F.lit(means[i]) for i in range(folds)]), (F.col("fold") + 1).cast("int"))

    long = lambda df: df.unpivot(["movie_id", "label", "fold"], list(ROLES.values()), "role", "person").where("person IS NOT NULL")
    by_fold = long(known).groupBy("role", "person", "fold").agg(F.sum("label").alias("total"), F.count("label").alias("films"))
    entry = F.struct("fold", F.struct("total", "films"))
    totals = by_fold.groupBy("role", "person").agg(
        F.sum("total").alias("total"), F.sum("films").alias("films"), F.map_from_entries(F.collect_list(entry)).alias("by_fold")
    )
    own = F.try_element_at("by_fold", F.col("fold"))
    less = lambda c: F.coalesce(c, F.lit(0)) - F.coalesce(own[c], F.lit(0))
    shrunk = (less("total") + PRIOR_FILMS * prior) / (less("films") + PRIOR_FILMS)
    of_role = lambda key: F.max(F.when(F.col("role") == key, F.col("shrunk")))
    found = long(rows).join(totals, ["role", "person"], "left").withColumn("shrunk", shrunk)
    folded = found.groupBy("movie_id").agg(*[of_role(key).alias(f"{role}_mean") for role, key in ROLES.items()])
    filled = {f"{role}_mean": F.coalesce(f"{role}_mean", prior) for role in ROLES}
    return rows.select("movie_id", "fold").join(folded, "movie_id", "left").withColumns(filled)


def conformal_margin(calibration: DataFrame, level: float = 0.9) -> float | None:
    """Half-width that covers a new film's revenue with probability ``level`` or more, whatever the model is.

    ``calibration`` has ``label, predicted_revenue`` of films that the model has not seen: split-conformal prediction
    takes the ``ceil((n + 1) x level)``-th smallest of their ``n`` absolute errors. None if there are too few films.
    """
    errors = calibration.select(F.abs(F.col("label") - F.col("predicted_revenue")).alias("error"))
    return distribution.nth_smallest(errors, "error", lambda n: math.ceil(round((n + 1) * level, 9)))
