"""Quality checks on a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, nulls)`` for every column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def has_duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> bool:
    return not duplicate_keys(df, keys or df.columns).isEmpty()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), column)


def series_state(df: DataFrame, column: str) -> DataFrame:
    """One row telling a panel what it can show: any value other than 0, how many different ones, and their range.

    The different values are counted on the already folded list, so nothing but that list is shuffled.
    """
    values = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    return values.agg(
        F.coalesce(F.bool_or(F.coalesce(F.col("v"), F.lit(0)) != 0), F.lit(False)).alias("any_nonzero"),
        F.count("v").alias("distinct_values"),
        F.min("v").cast("bigint").alias("smallest"),
        F.max("v").cast("bigint").alias("largest"),
    )
