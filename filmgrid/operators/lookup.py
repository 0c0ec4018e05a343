"""Left joins to dimensions, value lookups and differences of id lists.

No join here forces a broadcast. Spark broadcasts a side when its size on disk, or as measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold``; a larger one is shuffled, with skewed partitions split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_code(df: DataFrame, column: str, lookup: DataFrame, code: str, name: str) -> DataFrame:
    """Replace a code by its name from a lookup table; an unknown code gives null."""
    names = lookup.select(F.col(code).alias("_code"), F.col(name).alias("_name"))
    joined = df.join(names, F.col(column) == F.col("_code"), "left")
    return joined.withColumn(column, F.col("_name")).select(*df.columns)


def first_by_name(dimension: DataFrame, name: str, key: str, value: str) -> DataFrame:
    """One row per name; of namesakes the one with the smallest key."""
    return (
        dimension.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.min(F.struct(key, value)).alias("_first"))
        .select(name, F.col(f"_first.{value}").alias(value))
    )


def find_values(
    df: DataFrame, column: str, dimension: DataFrame, name: str, key: str, value: str, output: str
) -> DataFrame:
    """Add ``output``: the value found under the name in ``column``, null if the name is unknown."""
    found = first_by_name(dimension, name, key, value).select(
        F.col(name).alias("_name"), F.col(value).alias(output)
    )
    return df.join(found, F.col(column) == F.col("_name"), "left").drop("_name")


def distinct_ids(df: DataFrame, columns: Sequence[str], output: str, ordered: bool = False) -> DataFrame:
    """All different non-null ids found in several columns, in one scan."""
    ids = df.select(F.explode(F.array(*[F.col(c).cast("bigint") for c in columns])).alias(output))
    ids = ids.where(F.col(output).isNotNull()).distinct()
    return ids.orderBy(output) if ordered else ids


def ids_missing_from(ids: DataFrame, known: DataFrame, column: str) -> DataFrame:
    return ids.join(known.select(column), column, "left_anti")


def released_in_last_month(films: DataFrame, key: str = "movie_id", day: str = "release_date") -> DataFrame:
    """Ids of films released within one month up to the latest release, both ends included."""
    latest = films.select(F.max(day)).scalar()
    recent = films.where(F.col(day).between(F.add_months(latest, -1), latest))
    return recent.select(F.col(key).cast("bigint").alias(key)).distinct()
