"""Landed files into a warehouse table, each file once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmgrid.operators import dedup
from filmgrid.session import delete_path, path_exists
from filmgrid.sources.ordering import order_text
from filmgrid.sources.warehouse import ORDER, Warehouse


#: column for the name of the file
FILE = "_file_name"
#: column for the text of a line that is no record of the schema
BAD = "_bad_line"
#: formats whose files may hold such lines
LINES = ("json", "csv")
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "reason", "line")])
NOT_A_RECORD, NO_KEY = "not a record of the schema", "a key is missing"


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """``(file, reason, line, batch)`` of everything that was not taken in."""
    if not path_exists(spark, rejects):
        return spark.createDataFrame([], T.StructType([*REJECTS.fields, T.StructField("batch", T.LongType())]))
    return spark.read.schema(T.StructType([*REJECTS.fields, T.StructField("batch", T.LongType())])).parquet(rejects)


def ingest_files(
    spark: SparkSession,
    warehouse: Warehouse,
    table: str,
    folder: str,
    pattern: str,
    file_format: str,
    schema: T.StructType,
    order: Sequence[str],
    checkpoint: str,
    run_time,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    files_per_batch: int | None = None,
    options: dict | None = None,
    rejects: str | None = None,
) -> None:
    """Take in all files that have landed since the last call, then stop.

    Every batch is cut to the last row per key in ``order`` and merged into the table, which keeps the order with the
    row: an older row that lands later does not overwrite a newer one, so the table does not depend on how files fall
    into batches. The checkpoint remembers which files were taken; merging a batch again after a failure gives the
    same table. The columns of ``order`` need not be part of the table.

    Lines that are no record of the schema, and rows without a key, are no part of the table: they go to the folder
    ``rejects``, which belongs to the checkpoint. A batch's rejects replace those of an earlier attempt at the same batch.
    Without such a folder they are an error, and the batch is not taken.
    """
    warehouse.create_if_absent(table)
    table_schema, keys = warehouse.tables[table]
    of_lines = file_format in LINES

    def put_aside(batch_id: int, bad: DataFrame) -> None:
        path = f"{rejects}/batch={batch_id}"
        if bad.isEmpty():
            if rejects:
                delete_path(spark, path)
        elif not rejects:
            row = bad.first()
            raise ValueError(f"{row['file']}: {row['reason']}: {row['line']}")
        else:
            bad.write.mode("overwrite").parquet(path)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = batch.where(F.col(BAD).isNull()) if of_lines else batch
            rows = transform(good.drop(BAD, FILE))
            usable = reduce(and_, [F.col(k).isNotNull() for k in keys])
            # a transform may make keys, so rows without one are looked for behind it
            bad = rows.where(~usable).select(F.lit(None).cast("string").alias("file"), F.lit(NO_KEY).alias("reason"), F.to_json(F.struct(*rows.columns)).alias("line"))
            if of_lines:
                lines = batch.where(F.col(BAD).isNotNull())
                bad = bad.union(lines.select(F.col(FILE).alias("file"), F.lit(NOT_A_RECORD).alias("reason"), F.col(BAD).alias("line")))
            put_aside(batch_id, bad)
            rows = rows.where(usable)
            latest = dedup.keep_last(rows, keys, order).withColumn(ORDER, order_text(rows, order))
            columns = [c for c in latest.columns if c in table_schema.names]
            warehouse.upsert(table, latest.select(*columns, ORDER), run_time, keys)
        finally:
            batch.unpersist()

    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())]) if of_lines else schema
    reader = spark.readStream.format(file_format).schema(whole).option("pathGlobFilter", pattern)
    if of_lines:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.options(**(options or {}))
        .load(folder)
        .select("*", F.col("_metadata.file_name").alias(FILE))
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
