"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: cells of a grid that one part makes
PART_CELLS = 1_000_000


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    """One row per (row, value column)."""
    return df.unpivot(list(ids), list(values), variable, value)


def _one_value(value: str) -> Column:
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two values for one cell"))).otherwise(F.first(value))


def to_wide(df: DataFrame, index: str, names: str, value: str, wanted: Sequence[str]) -> DataFrame:
    """One column per wanted name; two values for one cell are an error.

    The names are given, since as columns they are part of the plan. A long form over all names is ``full_grid``.
    """
    return df.groupBy(index).pivot(names, list(wanted)).agg(_one_value(value))


def full_grid(df: DataFrame, index: str, names: str, value: str, wanted: Sequence[str] | None = None, part_cells: int = PART_CELLS) -> DataFrame:
    """Long form with a row for every (index, name), null where there was no value; two values for one are an error.

    Without ``wanted`` the names are those of the frame, any number of them. The grid itself is the output, so it is
    made where it ends up: names are dealt out over parts, each index goes to every part, and rows of a part meet. Both
    are counted first, so that a part makes about ``part_cells`` cells whatever the grid's size. The frame is read several
    times; pass one that is cheap to read.
    """
    cells = df.groupBy(index, names).agg(_one_value(value).alias(value))
    indexes = df.select(index).distinct()
    if wanted is not None:
        grid = indexes.select(index, F.explode(F.array(*[F.lit(w) for w in wanted])).alias(names))
    else:
        named = df.select(names).distinct()
        # both counts are part of the plan, so that nothing runs before the grid is asked for
        size = lambda frame: frame.agg(F.count(F.lit(1)).alias("n")).scalar()
        parts = F.greatest(F.lit(1), F.least(size(named), F.ceil(size(indexes) * size(named) / F.lit(part_cells)))).cast("int")
        dealt = named.withColumn("_parts", parts).select(names, F.pmod(F.xxhash64(names), F.col("_parts")).cast("int").alias("_part"))
        everywhere = indexes.withColumn("_parts", parts).select(index, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
        grid = everywhere.join(dealt, "_part").select(index, names)
    return grid.join(cells, [index, names], "left").select(index, names, value)


def explode_structs(df: DataFrame, keys: Sequence[str], items: str) -> DataFrame:
    """One row per element of an array of structs, its fields as columns; null elements are left out."""
    exploded = df.select(*keys, F.explode(items).alias("_item")).where("_item IS NOT NULL")
    return exploded.select(*keys, "_item.*")
