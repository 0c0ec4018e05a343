"""Plain file writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header. CSV knows no arrays or structs, so these are written as JSON text.

    Texts with line feeds are written in quotes; read such files with ``multi_line``.
    """
    nested = (T.ArrayType, T.StructType, T.MapType)
    columns = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields
    ]
    df.select(*columns).write.mode(mode).options(header=True, escape='"').csv(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def stamp(df: DataFrame, run_time) -> DataFrame:
    """One insertion time for the whole run, given by the caller."""
    return df.withColumn("insertion_datetime", F.lit(run_time).cast("timestamp"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with a table's columns and types; columns that it lacks are null, others are refused."""
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns missing from the table: {unknown}")
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
