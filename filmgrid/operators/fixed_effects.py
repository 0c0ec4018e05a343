"""Least squares over a few numbers and any number of categories, solved exactly and without an index of the categories.

The model is ``label = intercept + sum(slope x number) + sum(effect of each role's category)``. Its normal equations are
solved by conjugate gradients. The unknowns are a table of one row per (role, category), which never leaves Spark; the
slopes are few and reach the driver. The rows are read once more to count which categories meet, folded before they are
shuffled, so a category may hold any share of the rows; a step then joins those counts with the search direction and sums
them by unknown. Spark broadcasts the direction while it is small and splits skewed joins when it is not. Columns are
scaled to length one and the numbers turned at right angles to each other, which saves steps, and steps go on until the
equations hold.

The fitted values are unique. The effects are not where roles overlap; they are given with a mean of zero in each role, so
that a category that was never seen counts as the average one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.session import written

#: how far off the equations may be, in lengths of the centred label, and the steps after which a fit has failed
TOLERANCE, MAX_STEPS = 1e-9, 1000


@dataclass(frozen=True)
class EffectsModel:
    """``effects`` has ``role, category, effect, n``; a missing category is one of its own, the text ``""``."""

    intercept: float
    slopes: dict[str, float]
    means: dict[str, float]
    roles: tuple[str, ...]
    effects: DataFrame
    steps: int

    def predict(self, rows: DataFrame, row_id: str, name: str = "prediction") -> DataFrame:
        """The rows with their fitted value; unknown categories count 0, missing numbers as the training mean.

        Rows are told apart by ``row_id``. One join looks up the categories of all roles.
        """
        found = _categories(rows.select(row_id, *self.roles).distinct(), [row_id], self.roles).join(self.effects, ["role", "category"])
        summed = found.groupBy(row_id).agg(F.sum("effect").alias("_effects"))
        value = F.lit(self.intercept)
        for number, slope in self.slopes.items():
            value = value + F.lit(slope) * _filled(number, self.means[number])
        joined = rows.join(summed, row_id, "left")
        return joined.withColumn(name, value + F.coalesce("_effects", F.lit(0.0))).drop("_effects")


def _filled(number: str, mean: float) -> Column:
    x = F.col(number).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(mean)).otherwise(x)


def _category(role: str) -> Column:
    # a mark keeps a missing category apart from an empty one
    return F.coalesce(F.concat(F.lit("="), F.col(role).cast("string")), F.lit(""))


def _categories(rows: DataFrame, keep: Sequence[str], roles: Sequence[str]) -> DataFrame:
    """One row per row and role: ``(*keep, role, category)``."""
    cells = F.array(*[F.struct(F.lit(role).alias("role"), _category(role).alias("category")) for role in roles])
    return rows.select(*keep, F.inline(cells))


def _moments(rows: DataFrame, label: str, numbers: Sequence[str]) -> tuple[dict, int, float, float, np.ndarray]:
    """Means of the numbers, rows, mean and deviation of the label, and the numbers' centred products: two rows of sums."""
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    aggregates = [F.count(F.lit(1)).alias("n"), F.avg(label).alias("label"), F.stddev_pop(label).alias("spread")]
    row = rows.agg(*aggregates, *[F.avg(value(c)).alias(f"m{i}") for i, c in enumerate(numbers)]).first()
    means = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(numbers)}
    centred = [_filled(c, means[c]) - means[c] for c in numbers]
    pairs = [(i, j) for i in range(len(numbers)) for j in range(i + 1)]
    products = np.zeros((len(numbers), len(numbers)))
    if pairs:
        sums = rows.agg(*[F.sum(centred[i] * centred[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
        for i, j in pairs:
            products[i, j] = products[j, i] = sums[f"p{i}_{j}"] or 0.0
    return means, row["n"], row["label"] or 0.0, row["spread"] or 0.0, products


def _independent(products: np.ndarray) -> np.ndarray:
    """Combinations of the numbers (a column each) that have length one and are at right angles to each other.

    Numbers that never change, or follow from others, add none.
    """
    lengths = np.sqrt(np.diag(products))
    scale = np.divide(1.0, lengths, out=np.zeros_like(lengths), where=lengths > 0)
    weights, ways = np.linalg.eigh(products * scale[:, None] * scale[None, :])
    kept = weights > 1e-10
    return scale[:, None] * ways[:, kept] / np.sqrt(weights[kept])


def fit(
    rows: DataFrame, label: str, numbers: Sequence[str], roles: Sequence[str], tolerance: float = TOLERANCE
) -> EffectsModel:
    """The least-squares fit over rows with a label.

    Steps end once all equations together, with every unknown's column scaled to length one, are off by no more than
    ``tolerance`` times the length of the centred label. A fit that has not got there after ``MAX_STEPS`` is an error, not
    a result. Numbers that follow from others share their slope, those that never change have slope 0. Without rows,
    and for a label that never changes, the fit is the label's mean.
    """
    if not roles:
        raise ValueError("a fit needs at least one role")
    known = rows.where(F.col(label).isNotNull())
    means, n, mean, spread, products = _moments(known, label, numbers)
    ways = _independent(products)
    centred = [_filled(c, means[c]) - means[c] for c in numbers]
    x = [sum((centred[i] * float(w) for i, w in enumerate(way) if w), F.lit(0.0)).alias(f"x{j}") for j, way in enumerate(ways.T)]
    shifted = known.select((F.col(label).cast("double") - mean).alias("y"), *x, *[_category(r).alias(f"r{j}") for j, r in enumerate(roles)])
    unknowns, equations = _equations(written(shifted, "effects-rows"), len(x), len(roles))
    solved, steps = _solved(unknowns.select("id", "s"), equations, tolerance * spread * math.sqrt(n))
    found = written(unknowns.drop("s").join(solved, "id").withColumn("effect", F.col("u") / _length()), "effects-solved")
    # one row a number, and one a role
    turned = {r["category"]: r["effect"] for r in found.where("role < 0").select("category", "effect").collect()}
    effects = found.where("role >= 0")
    centres = {r["role"]: r["centre"] for r in effects.groupBy("role").agg((F.sum(F.col("effect") * F.col("rows")) / F.sum("rows")).alias("centre")).collect()}
    of_role = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("role") + 1)
    named = effects.select(
        of_role(roles).alias("role"), "category", (F.col("effect") - of_role([centres.get(j, 0.0) for j in range(len(roles))])).alias("effect"), F.col("rows").alias("n")
    )
    slopes = dict(zip(numbers, (ways @ np.array([turned.get(f"x{j}", 0.0) for j in range(len(x))])).tolist()))
    intercept = mean + sum(centres.values()) - sum(slopes[c] * means[c] for c in numbers)
    return EffectsModel(intercept, slopes, means, tuple(roles), named, steps)


def _length() -> Column:
    """Length of an unknown's column: the numbers' have length one, a category's has a one for each of its rows."""
    return F.when(F.col("role") < 0, 1.0).otherwise(F.sqrt(F.col("rows").cast("double")))


def _equations(base: DataFrame, n_numbers: int, n_roles: int) -> tuple[DataFrame, DataFrame]:
    """The unknowns ``(id, role, category, rows, s)`` with their right side, and the equations' ``(id, other, weight)``.

    Everything is scaled to columns of length one, so each unknown has the weight one in its own equation, which is left
    out. An equation has an entry for every number and for every category that some row shares with its own.
    """
    cell = lambda j, value: F.struct(F.lit(j).alias("role"), F.col(f"r{j}").alias("category"), value.alias("value"))
    number = lambda c, value: F.struct(F.lit(-1).alias("role"), F.lit(c).alias("category"), value.alias("value"))
    xs, roles = [f"x{i}" for i in range(n_numbers)], range(n_roles)
    sides = base.select(F.inline(F.array(*[cell(j, F.col("y")) for j in roles], *[number(c, F.col("y") * F.col(c)) for c in xs])))
    sides = sides.groupBy("role", "category").agg(F.sum("value").alias("side"), F.count(F.lit(1)).alias("rows"))
    numbered = sides.select(F.monotonically_increasing_id().alias("id"), "role", "category", "rows", (F.col("side") / _length()).alias("s"))
    unknowns = written(numbered, "effects-unknowns")
    one = F.lit(1.0)
    met = [F.struct(cell(i, one).alias("a"), cell(j, one).alias("b"), one.alias("value")) for i in roles for j in range(i)]
    met += [F.struct(cell(i, one).alias("a"), number(c, one).alias("b"), F.col(c).alias("value")) for i in roles for c in xs]
    if not met:
        return unknowns, unknowns.select("id", F.col("id").alias("other"), F.lit(0.0).alias("weight")).limit(0)
    pairs = base.select(F.inline(F.array(*met))).select(
        F.col("a.role").alias("a_role"), F.col("a.category").alias("a"), F.col("b.role").alias("b_role"), F.col("b.category").alias("b"), "value"
    )
    pairs = pairs.groupBy("a_role", "a", "b_role", "b").agg(F.sum("value").alias("weight"))
    names = unknowns.select("role", "category", "id", _length().alias("length"))
    left = names.select(F.col("role").alias("a_role"), F.col("category").alias("a"), F.col("id"), F.col("length").alias("a_length"))
    right = names.select(F.col("role").alias("b_role"), F.col("category").alias("b"), F.col("id").alias("other"), F.col("length").alias("b_length"))
    half = pairs.join(left, ["a_role", "a"]).join(right, ["b_role", "b"])
    half = written(half.select("id", "other", (F.col("weight") / F.col("a_length") / F.col("b_length")).alias("weight")), "effects-pairs")
    return unknowns, half.union(half.select(F.col("other").alias("id"), F.col("id").alias("other"), "weight"))


def _solved(sides: DataFrame, equations: DataFrame, limit: float) -> tuple[DataFrame, int]:
    """Conjugate gradients from zero: ``(id, u)`` and the number of steps.

    ``s`` is what is left of the right side, ``p`` the direction of the next step, ``t`` what the equations make of it.
    Every step's state is written, so a lost executor costs one step at most.
    """
    state = written(sides.select("id", F.lit(0.0).alias("u"), "s", F.col("s").alias("p")), "effects-state")
    square = state.agg(F.sum(F.col("s") * F.col("s")).alias("square")).first()["square"] or 0.0
    steps = 0
    equations = equations.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while math.sqrt(square) > limit:
            if steps == MAX_STEPS:
                raise ValueError(f"no fit after {steps} steps: the equations are off by {math.sqrt(square)}, {limit} is allowed")
            steps += 1
            others = equations.join(state.select(F.col("id").alias("other"), "p"), "other")
            back = others.groupBy("id").agg(F.sum(F.col("weight") * F.col("p")).alias("back"))
            stepped = state.join(back, "id", "left").select("id", "u", "s", "p", (F.col("p") + F.coalesce("back", F.lit(0.0))).alias("t"))
            stepped = written(stepped, "effects-state")
            pairs = [("p", "t"), ("s", "s"), ("s", "t"), ("t", "t")]
            sums = stepped.agg(*[F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in pairs]).first()
            along = sums["ss"] / sums["pt"]
            square = max(0.0, sums["ss"] - 2 * along * sums["st"] + along * along * sums["tt"])
            s = F.col("s") - along * F.col("t")
            state = stepped.select("id", (F.col("u") + along * F.col("p")).alias("u"), s.alias("s"), (s + square / sums["ss"] * F.col("p")).alias("p"))
        return written(state.select("id", "u"), "effects-state"), steps
    finally:
        equations.unpersist()
