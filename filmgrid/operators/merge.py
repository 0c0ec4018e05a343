"""Upsert and null-preserving update of one frame by another.

Both read the target without a shuffle as long as the batch of changes is small enough for Spark to broadcast, and
fall back to shuffled joins when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, _source, _copies)``, the other columns as one struct. Rows with a null key can match nothing."""
    rest = [c for c in source.columns if c not in keys]
    usable = source.dropna(how="any", subset=list(keys))
    return usable.groupBy(*keys).agg(
        F.first(F.struct(F.lit(1).alias("_present"), *rest)).alias("_source"), F.count("*").alias("_copies")
    )


def _single():
    """True for one source row per key, an error for more."""
    message = F.lit("several source rows match one target row")
    return F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.lit(True))


def _matched(target: DataFrame, source: DataFrame, keys: Sequence[str], replace) -> DataFrame:
    changed = [c for c in source.columns if c not in keys]
    joined = target.join(_one_per_key(source, keys), list(keys), "left")
    columns = [
        replace(c).cast(target.schema[c].dataType).alias(c) if c in changed else F.col(c) for c in target.columns
    ]
    return joined.where(F.col("_copies").isNull() | _single()).select(*columns)


def _check_columns(target: DataFrame, source: DataFrame) -> None:
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns missing from the target: {unknown}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], newer: Sequence[str] = ()) -> DataFrame:
    """Matched rows take all of the source's columns, nulls included; unmatched source rows are added.

    Target columns that the source lacks keep their values, or are null in added rows. Two source rows for one
    target row are an error. A null key matches nothing. With ``newer``, columns of both sides, a target row is left
    as it is if the source row comes before it in their order (nulls first).
    """
    _check_columns(target, source)
    counts = F.col("_copies").isNotNull()
    if newer:
        counts = counts & (F.struct(*[F.col(f"_source.{c}") for c in newer]) >= F.struct(*newer))

    def replace(c: str):
        return F.when(counts, F.col(f"_source.{c}")).otherwise(F.col(c))

    updated = _matched(target, source, keys, replace)
    known = target.select(*keys).join(source.select(*keys).dropna().distinct(), list(keys), "left_semi")
    added = source.join(known, list(keys), "left_anti")
    added = added.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in source.columns])
    return updated.unionByName(added, allowMissingColumns=True)


def update_known(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's non-null values; the number of rows never changes."""
    _check_columns(target, source)
    return _matched(target, source, keys, lambda c: F.coalesce(F.col(f"_source.{c}"), F.col(c)))
