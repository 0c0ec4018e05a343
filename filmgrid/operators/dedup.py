"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of every key in the given order; null keys are equal to each other.

    The rank filter lets Spark cut every task's rows to one per key before the shuffle, so a key that holds a large
    share of the rows sends at most one row per task to its final place.
    """
    latest_first = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_values(
    df: DataFrame, entity: str, key: str, value: str, order: Sequence[str], wanted: Mapping[str, str]
) -> DataFrame:
    """Key/value rows as one sparse row per entity, each column the latest value of its key.

    ``wanted`` maps a key to the name of its column. Entities without any wanted value are left out. One aggregate
    with a filter per column: rows are folded before the shuffle and no list of changes is ever built.
    """
    stamp = F.struct(*order)
    columns = [
        F.max_by(F.col(value), F.when(F.col(key) == name, stamp)).alias(column) for name, column in wanted.items()
    ]
    folded = df.where(F.col(key).isin(*wanted)).groupBy(entity).agg(*columns)
    return folded.dropna(how="all", subset=list(wanted.values()))


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; a column a frame lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
