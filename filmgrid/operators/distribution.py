"""Exact quantiles, trimming, histogram, density and trend line at any size of input."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ACCURACY = 10_000
#: values left between two bounds that are sorted as one array; more are narrowed down again
REST = 10_000


def _order_statistics(values: DataFrame, ranks: Sequence[int], n: int) -> dict[int, float]:
    """Values at 0-based ranks of a one-column frame ``x`` of ``n`` rows.

    Each round asks the quantile sketch for bounds around every rank, counts the rows below, at and between the
    bounds, and goes on with the rows strictly between them. The sketch's error bound makes these a small fraction
    of the rows, whatever the ties, so a few rounds of one-row aggregates suffice.
    """
    margin = 3 / _ACCURACY
    shares = [s for rank in ranks for s in (max(0.0, rank / n - margin), min(1.0, (rank + 1) / n + margin))]
    bounds = values.agg(F.percentile_approx("x", shares, _ACCURACY).alias("b"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    brackets = []
    for i, rank in enumerate(ranks):
        low = bounds["lo"] if shares[2 * i] == 0.0 else bounds["b"][2 * i]
        high = bounds["hi"] if shares[2 * i + 1] == 1.0 else bounds["b"][2 * i + 1]
        brackets.append((low, high))
    x = F.col("x")
    counts = []
    for i, (low, high) in enumerate(brackets):
        counts += [
            F.count_if(x < low).alias(f"below{i}"),
            F.count_if(x == low).alias(f"low{i}"),
            F.count_if((x > low) & (x < high)).alias(f"inside{i}"),
        ]
    row = values.agg(*counts).first()
    found: dict[int, float] = {}
    inner: dict[tuple[float, float], list[tuple[int, int, int]]] = {}
    for i, (rank, (low, high)) in enumerate(zip(ranks, brackets)):
        below, at_low, inside = row[f"below{i}"], row[f"low{i}"], row[f"inside{i}"]
        if rank < below + at_low:
            found[rank] = low
        elif rank >= below + at_low + inside:
            found[rank] = high
        else:
            inner.setdefault((low, high), []).append((rank, rank - below - at_low, inside))
    for (low, high), wanted in inner.items():
        part = values.where((x > low) & (x < high))
        if wanted[0][2] <= REST:
            rest = part.agg(F.array_sort(F.collect_list("x")).alias("x")).first()["x"]
            found.update({rank: rest[local] for rank, local, _ in wanted})
            continue
        deeper = _order_statistics(part, sorted({w[1] for w in wanted}), wanted[0][2])
        found.update({rank: deeper[local] for rank, local, _ in wanted})
    return found


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))


def nth_smallest(df: DataFrame, column: str, nth) -> float | None:
    """The value that ``nth(n)`` says, counted from 1, of the ``n`` that are neither null nor NaN; None beyond the last."""
    values = _values(df, column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = values.count()
        rank = nth(n) - 1
        return _order_statistics(values, [rank], n)[rank] if 0 <= rank < n else None
    finally:
        values.unpersist()


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation, nulls and NaN left out; ``[None, ...]`` for no values."""
    values = _values(df, column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = values.count()
        if n == 0:
            return [None for _ in shares]
        positions = [share * (n - 1) for share in shares]
        ranks = sorted({r for p in positions for r in (math.floor(p), math.ceil(p))})
        at = _order_statistics(values, ranks, n)
    finally:
        values.unpersist()
    result = []
    for position in positions:
        low, high = math.floor(position), math.ceil(position)
        result.append(at[low] + (at[high] - at[low]) * (position - low))
    return result


def trim(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows between two quantiles of a column, both included."""
    bottom, top = exact_quantiles(df, column, [low, high])
    return df.where(F.col(column).between(F.lit(bottom).cast("double"), F.lit(top).cast("double")))


def histogram(df: DataFrame, column: str, max_bins: int = 50) -> DataFrame:
    """``(bin_start, bin_end, n)`` of the non-empty bins.

    The step is the smallest of 1, 2 or 5 times a power of ten with which the range fits into ``max_bins``. The range
    is a one-row aggregate; counting folds to at most ``max_bins`` rows per task before the shuffle.
    """
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    span = F.col("hi") - F.col("lo")
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.col("span") / max_bins)))
    step = F.when(F.col("span") == 0, F.lit(1.0))
    for factor in (1.0, 2.0, 5.0):
        step = step.when(F.col("span") / (F.col("unit") * factor) <= max_bins, F.col("unit") * factor)
    scale = (
        values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .withColumn("span", span)
        .withColumn("unit", F.when(F.col("span") > 0, unit))
        .select(step.otherwise(F.col("unit") * 10.0).alias("step"))
    )
    stepped = values.withColumn("step", scale.scalar())
    bins = stepped.select(F.floor(F.col("x") / F.col("step")).alias("bin"), "step")
    return bins.groupBy("bin", "step").agg(F.count("*").alias("n")).select(
        (F.col("bin") * F.col("step")).alias("bin_start"), ((F.col("bin") + 1) * F.col("step")).alias("bin_end"), "n"
    )


def density(df: DataFrame, column: str, steps: int = 100) -> DataFrame:
    """``(x, density)``: Gaussian kernel estimate over all rows on an even grid of ``steps + 1`` points.

    The bandwidth is Scott's rule with the smaller of deviation and scaled quartile range. Equal values are counted
    first; one aggregate then sums their weights at every grid point, so no row is repeated and the result is exact.
    """
    x = F.col(column).cast("double")
    values = df.select(x.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    q1, q3 = exact_quantiles(values, "v", [0.25, 0.75])
    if q1 is None:
        return values.select(F.col("v").alias("x"), F.col("v").alias("density"))
    stats = values.agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"), F.stddev_samp("v").alias("deviation")
    ).first()
    spread, deviation = (q3 - q1) / 1.34, stats["deviation"] or 0.0
    width = min(deviation, spread) if deviation > 0 and spread > 0 else deviation if deviation > 0 else abs(q1) or 1.0
    bandwidth = 1.06 * width * stats["n"] ** -0.2
    points = [stats["lo"] + (stats["hi"] - stats["lo"]) * i / steps for i in range(steps + 1)]
    counted = values.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("m"))

    def height(point: float) -> Column:
        z = (F.lit(point) - F.col("v")) / bandwidth
        return F.sum(F.col("m") * F.exp(z * z * -0.5)) / (stats["n"] * bandwidth * math.sqrt(2 * math.pi))

    curve = counted.agg(*[height(p).alias(f"d{i}") for i, p in enumerate(points)])
    pairs = [F.struct(F.lit(p).alias("x"), F.col(f"d{i}").alias("density")) for i, p in enumerate(points)]
    return curve.select(F.inline(F.array(*pairs)))


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line in one row: ``slope, intercept, r2, n``."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column in one row, cut to whole numbers."""
    parts = []
    for column in columns:
        parts += [
            F.min(column).cast("bigint").alias(f"{column}_min"),
            F.max(column).cast("bigint").alias(f"{column}_max"),
        ]
    return df.agg(*parts)


def extremes(df: DataFrame, metrics: Sequence[str], ids: Sequence[str], show: Sequence[str]) -> DataFrame:
    """For each metric the rows with the highest and the lowest value, ``(metric, extreme, value, *show)``.

    One pass for all of them. Nulls and NaN are passed over; ties go to the smallest ids.
    """
    aggregates = []
    for metric in metrics:
        value = F.col(metric).cast("double")
        value = F.when(~F.isnan(value), value)
        shown = F.struct(value.alias("value"), *[F.col(c) for c in show])
        # the highest value is the smallest of its negatives, which keeps the tie rule the same for both
        for extreme, order in (("highest", -value), ("lowest", value)):
            key = F.when(value.isNotNull(), F.struct(order.alias("_order"), *[F.col(c) for c in ids]))
            aggregates.append(F.min_by(shown, key).alias(f"{extreme}_{metric}"))
    row = df.agg(*aggregates)
    entries = [
        F.struct(F.lit(metric).alias("metric"), F.lit(extreme).alias("extreme"), F.col(f"{extreme}_{metric}").alias("row"))
        for metric in metrics
        for extreme in ("highest", "lowest")
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.metric", "e.extreme", "e.row.*")
