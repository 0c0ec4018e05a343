"""A folder of parquet tables with declared schemas, kept as hash buckets of their keys.

A table is one partitioned parquet data set. ``bucket`` follows from the key, so a merge reads and rewrites the buckets
that its batch touches and leaves the files of all others alone: Spark's dynamic partition overwrite replaces exactly
the partitions that are written. An append adds a ``load_id`` partition of its own inside the buckets; a load that is
run again under the same id replaces what it wrote. A merge keeps every row in its load's partition.

The number of buckets is part of a table's folders, so a table is always read with the number it was written with. A load
that replaces all rows chooses it by their size, and ``fit`` deals a table out anew that has outgrown its buckets.

Reads use the declared schema, so files that lack a column give nulls for it. Rows may carry ``source_order``, a text
that tells which of two rows is the later one; the tables keep it, and upserts do not let an older row win. A table may
keep further columns that it does not show.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmgrid import schemas
from filmgrid.operators import merge
from filmgrid.session import bytes_below, delete_path, path_exists, sub_folders
from filmgrid.sources import readers, writers

#: buckets of a table at least, and the bytes of a bucket at which a load that replaces all rows makes more of them
BUCKETS, BUCKET_BYTES = 64, 512 * 1024 * 1024
#: the load that merged and replaced rows belong to
MERGED = "merged"
ORDER = "source_order"
PLACE = T.StructType([T.StructField("buckets", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("load_id", T.StringType())])


class Warehouse:
    """Tables below ``root``; ``tables`` maps a name to its schema and its key columns. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, tables=None, buckets: int = BUCKETS, hidden=None, bucket_bytes: int = BUCKET_BYTES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(tables if tables is not None else schemas.WAREHOUSE_TABLES)
        self.hidden = dict(hidden if hidden is not None else schemas.WAREHOUSE_HIDDEN if tables is None else {})
        self.buckets = buckets
        self.bucket_bytes = bucket_bytes

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _schema(self, table: str) -> T.StructType:
        """What is stored of a row, apart from its place."""
        hidden = self.hidden.get(table, T.StructType()).fields
        return T.StructType([*self.tables[table][0].fields, *hidden, T.StructField(ORDER, T.StringType())])

    def _stored(self, table: str) -> DataFrame:
        """The rows with their place."""
        if not self.exists(table):
            raise ValueError(f"no table {table}")
        return self.spark.read.schema(T.StructType([*self._schema(table).fields, *PLACE.fields])).parquet(self.path(table))

    def buckets_of(self, table: str) -> int:
        """The number that the table's folders name; a table without rows may take any."""
        named = [name for name in sub_folders(self.spark, self.path(table)) if name.startswith("buckets=")]
        return int(named[0].split("=")[1]) if named else self.buckets

    def _bucket(self, table: str, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(*self.tables[table][1]), F.lit(buckets or self.buckets_of(table))).cast("int")

    def _write(self, table: str, rows: DataFrame, overwrite: str, buckets: int | None = None) -> None:
        """Rows with their ``load_id`` to their buckets; adaptive execution decides on the files of a bucket.

        Files are sorted by key, so that a reader can pass over parts of them.
        """
        n = buckets or self.buckets_of(table)
        placed = rows.withColumns({"buckets": F.lit(n), "bucket": self._bucket(table, n)}).hint("rebalance", "bucket")
        sorted_rows = placed.sortWithinPartitions(*PLACE.names, *self.tables[table][1])
        writer = sorted_rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
        writer.partitionBy(*PLACE.names).parquet(self.path(table))

    def _place(self, table: str, bucket: int, load_id: str) -> str:
        return f"{self.path(table)}/buckets={self.buckets_of(table)}/bucket={bucket}/load_id={load_id}"

    def _wanted(self, folder: str) -> int:
        """Buckets for the rows in a folder, by their size."""
        return max(self.buckets, -(-bytes_below(self.spark, folder) // self.bucket_bytes))

    def _aside(self, rows: DataFrame) -> str:
        """The rows written to a folder of their own: that cuts their lineage and gives Spark their true size."""
        folder = f"{self.root}/_staging/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    # tables

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, f"{self.path(table)}/_SUCCESS")

    def create_if_absent(self, table: str) -> None:
        if not self.exists(table):
            self.truncate(table)

    def create_all(self) -> None:
        for table in self.tables:
            self.create_if_absent(table)

    def read(self, table: str) -> DataFrame:
        return self._stored(table).select(*self.tables[table][0].names)

    def _buckets_of(self, table: str, *frames: DataFrame) -> list[int]:
        """The buckets that the keys in some frames fall into; at most as many numbers as the table has buckets."""
        numbers = [frame.select(self._bucket(table).alias("bucket")) for frame in frames]
        return sorted(r["bucket"] for r in functools.reduce(DataFrame.union, numbers).distinct().collect())

    def rows_of(self, table: str, keys: DataFrame) -> DataFrame:
        """The rows, with all that is kept of them, whose columns agree with some row of ``keys``; null agrees with nothing.

        ``keys`` must have the table's key columns. Only the buckets that they fall into are read.
        """
        if not set(self.tables[table][1]) <= set(keys.columns):
            raise ValueError(f"the buckets of {table} follow from {self.tables[table][1]}")
        kinds = self._schema(table)
        wanted = keys.select(*[F.col(c).cast(kinds[c].dataType).alias(c) for c in keys.columns]).distinct()
        there = self._stored(table).where(F.col("bucket").isin(self._buckets_of(table, wanted)))
        return there.drop(*PLACE.names).join(wanted, keys.columns, "left_semi")

    def truncate(self, table: str) -> None:
        """Remove all rows."""
        self._write(table, self.spark.createDataFrame([], self._schema(table)).withColumn("load_id", F.lit(MERGED)), "static")

    def drop_all(self, confirm: bool = False) -> None:
        if not confirm:
            raise ValueError("dropping every table needs confirm=True")
        for table in self.tables:
            delete_path(self.spark, self.path(table))

    def rebucket(self, table: str, buckets: int | None = None) -> None:
        """Deal the rows out over another number of buckets, by their size if none is given. Rows keep their loads."""
        folder = self._aside(self._stored(table).drop("buckets", "bucket"))
        try:
            schema = T.StructType([*self._schema(table).fields, PLACE["load_id"]])
            self._write(table, self.spark.read.schema(schema).parquet(folder), "static", buckets or self._wanted(folder))
        finally:
            delete_path(self.spark, folder)

    def fit(self, table: str) -> bool:
        """Rebucket a table whose buckets have grown to twice their size, so that a small merge stays a small one."""
        outgrown = self._wanted(self.path(table)) > 2 * self.buckets_of(table)
        if outgrown:
            self.rebucket(table)
        return outgrown

    # loads

    def load(self, table: str, df: DataFrame, run_time, mode: str = "append", load_id: str | None = None) -> None:
        """``append`` adds rows, ``truncate`` replaces all rows, ``empty`` adds rows to an empty table only.

        Columns that the batch lacks are null. Rows appended under a ``load_id`` replace those that an earlier attempt
        under the same id has written; without one, every append is a load of its own.
        """
        if mode not in ("append", "truncate", "empty"):
            raise ValueError(f"unknown mode {mode}")
        if load_id == MERGED:
            raise ValueError(f"{MERGED} names no load")
        rows = writers.conform(writers.stamp(df, run_time), self._schema(table))
        if mode == "truncate":
            # computed in full before the old rows go
            folder = self._aside(rows)
            try:
                whole = self.spark.read.schema(rows.schema).parquet(folder).withColumn("load_id", F.lit(MERGED))
                self._write(table, whole, "static", self._wanted(folder))
            finally:
                delete_path(self.spark, folder)
            return
        self.create_if_absent(table)
        if mode == "empty" and not self.read(table).isEmpty():
            raise ValueError(f"table {table} is not empty")
        if load_id:  # a bucket that this attempt does not reach must not keep rows of the last one
            earlier = self._stored(table).where(F.col("load_id") == load_id).select("bucket").distinct()
            for row in earlier.collect():  # at most as many numbers as the table has buckets
                delete_path(self.spark, self._place(table, row["bucket"], load_id))
        self._write(table, rows.withColumn("load_id", F.lit(load_id or uuid.uuid4().hex)), "dynamic")

    def load_csv(
        self, table: str, path: str, run_time, mode: str = "append", multi_line: bool = False, load_id: str | None = None
    ) -> None:
        """A cleaned CSV file with a header row; arrays in it are JSON text."""
        fields = [f for f in self.tables[table][0].fields if f.name != "insertion_datetime"]
        flat = T.StructType([T.StructField(f.name, T.StringType() if _is_nested(f) else f.dataType) for f in fields])
        df = readers.read_csv(self.spark, path, flat, multi_line)
        columns = [F.from_json(f.name, f.dataType).alias(f.name) if _is_nested(f) else F.col(f.name) for f in fields]
        self.load(table, df.select(*columns), run_time, mode, load_id)

    # merges

    def _merge(self, table: str, df: DataFrame, run_time, keys: Sequence[str] | None, apply) -> None:
        """Reads and rewrites the buckets of the batch; the result is computed in full before any file is replaced."""
        stored = self.tables[table][1]
        keys = list(keys or stored)
        stamped = writers.stamp(df, run_time)
        schema = self._schema(table)
        unknown = [c for c in stamped.columns if c not in schema.names]
        if unknown:
            raise ValueError(f"columns missing from the target: {unknown}")
        fields = [f for f in schema.fields if f.name in stamped.columns]
        batch_folder = self._aside(stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]))
        result_folder = None
        try:
            batch = self.spark.read.schema(T.StructType(fields)).parquet(batch_folder)
            missing = functools.reduce(Column.__or__, [F.col(k).isNull() for k in keys])
            row = batch.agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing")).first()
            if not row["n"]:
                return
            if row["missing"]:
                raise ValueError(f"a row for {table} has no {' or no '.join(keys)}; it would be added again by every repetition")
            target = self._stored(table)
            if set(stored) <= set(keys):  # other keys say nothing about the buckets
                target = target.where(F.col("bucket").isin(self._buckets_of(table, batch)))
            merged = apply(target.drop("buckets", "bucket"), batch, keys)
            result_folder = self._aside(merged.withColumn("load_id", F.coalesce("load_id", F.lit(MERGED))))
            result = self.spark.read.schema(T.StructType([*schema.fields, PLACE["load_id"]])).parquet(result_folder)
            self._write(table, result, "dynamic")
        finally:
            delete_path(self.spark, batch_folder)
            if result_folder:
                delete_path(self.spark, result_folder)

    def upsert(self, table: str, df: DataFrame, run_time, keys: Sequence[str] | None = None) -> None:
        """Add new rows and overwrite known ones, nulls included. An empty batch changes nothing, a null key is an error.

        If the batch has ``source_order``, a known row is overwritten only by one that is not older.
        """
        newer = [ORDER] if ORDER in df.columns else []
        self._merge(table, df, run_time, keys, lambda target, batch, on: merge.upsert(target, batch, on, newer))

    def update(self, table: str, df: DataFrame, run_time, keys: Sequence[str] | None = None) -> None:
        """Overwrite known rows where the batch has a value. An empty batch changes nothing."""
        self._merge(table, df, run_time, keys, merge.update_known)


    def replace(self, table: str, gone: DataFrame, rows: DataFrame, run_time) -> None:
        """Take out the rows that agree with some row of ``gone`` in its columns, and add ``rows``.

        Both say by the table's key columns which buckets are read and written; the others stay as they are. The result
        is computed in full before any file goes, and doing the same again changes nothing.
        """
        schema = self._schema(table)
        on = gone.columns
        if not set(self.tables[table][1]) <= set(on):
            raise ValueError(f"the buckets of {table} follow from {self.tables[table][1]}")
        folders = [
            self._aside(gone.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in on]).dropna().distinct()),
            self._aside(writers.conform(writers.stamp(rows, run_time), schema)),
        ]
        try:
            leaving = self.spark.read.parquet(folders[0])
            coming = self.spark.read.schema(schema).parquet(folders[1])
            numbers = self._buckets_of(table, leaving, coming)
            if not numbers:
                return
            target = self._stored(table).where(F.col("bucket").isin(numbers))
            before = {(r["bucket"], r["load_id"]) for r in target.select("bucket", "load_id").distinct().collect()}
            stay = target.join(leaving, on, "left_anti").select(*schema.names, "load_id")
            folders.append(self._aside(stay.union(coming.withColumn("load_id", F.lit(MERGED)))))
            result = self.spark.read.schema(T.StructType([*schema.fields, PLACE["load_id"]])).parquet(folders[2])
            after = {(r["bucket"], r["load_id"]) for r in result.select(self._bucket(table).alias("bucket"), "load_id").distinct().collect()}
            if after:
                self._write(table, result, "dynamic")
            # an overwrite leaves places alone that get no row
            for bucket, load in before - after:
                delete_path(self.spark, self._place(table, bucket, load))
        finally:
            for folder in folders:
                delete_path(self.spark, folder)


def _is_nested(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.ArrayType, T.StructType))
