"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# White space between words, and the letters that are lower-cased.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it, lambdas included."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_id(docs: DataFrame, doc_id: str, *others: Column) -> tuple[DataFrame, str]:
    """``(doc_id, *others)`` and the type of the id: a struct that names rows stays as it is, any other id becomes a long."""
    kind = docs.select(doc_id).schema[0].dataType
    ids = F.col(doc_id) if isinstance(kind, StructType) else F.col(doc_id).cast("long")
    read = docs.select(ids.alias("doc_id"), *others)
    return read, read.schema["doc_id"].dataType.simpleString()


def words(text: Column) -> Column:
    """Array of the maximal runs of characters that are not white space; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def ranked(df: DataFrame, groups: Sequence[str], bucket: Column, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the 0-based position of every row in its group, in the order of (bucket, order).

    A group is never sorted in one task: each (group, bucket) is, and the rows before a bucket are a running sum over
    the bucket counts, a table of one short row per (group, bucket). Buckets must not be null; groups may be.
    """
    keyed = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    inside = keyed.withColumn("_local", local.cast("long") - 1).alias("rows")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"rows.{key}").eqNullSafe(F.col(f"offsets.{key}"))
    joined = inside.join(offsets.alias("offsets"), same)
    return joined.select(*[F.col(f"rows.`{c}`") for c in df.columns], (F.col("_before") + F.col("_local")).alias(name))
