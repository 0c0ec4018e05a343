"""CSV files with line feeds in quoted fields, read by many tasks.

A line feed ends a record unless an odd number of quotes stands before it in the file. Tasks begin anywhere, so the blocks
of a file are read twice. The first time, each says whether its quotes are odd, and how many of its lines end a record if it
begins outside of a field and if inside; running sums over the blocks, a short table, say which of both it does and what
number its first record has. Then the task that reads a block puts its lines together to records, and only the lines of
records that reach beyond a block leave their task. A quote inside of a field is doubled, so it counts twice and changes
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmgrid.session import written
from filmgrid.sources.json_split import running_before

LINE_FEED = "\n"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The lines ``(path, block, ...)`` of a task, cut where its batches end and where another block begins."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column(0), batch.column(1)
        other = [pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in (path, block)]
        cuts = [0, *(np.flatnonzero(other[0] | other[1]) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            yield (path[begin].as_py(), block[begin].as_py()), batch.slice(begin, end - begin)


def _open_after(lines: pa.Array, before: int) -> np.ndarray:
    """1 for every line at whose end a field is open, 0 for the others."""
    return (before + np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False), dtype=np.int64)) % 2


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(path, block, odd, ends0, ends1)`` for every block of lines ``(path, block, value)``."""
    kinds = {"path": pa.string(), "block": pa.int64(), "odd": pa.int64(), "ends0": pa.int64(), "ends1": pa.int64()}
    row = lambda key, sums: pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*key, *sums), kinds.values())], names=list(kinds))
    now, sums = None, (0, 0, 0)
    for key, run in _runs(batches):
        if key != now:
            if now is not None:
                yield row(now, sums)
            now, sums = key, (0, 0, 0)
        opened = _open_after(run.column(2), sums[0])
        sums = (int(opened[-1]), sums[1] + int((opened == 0).sum()), sums[2] + int(opened.sum()))
    if now is not None:
        yield row(now, sums)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(path, number, block, whole, text)`` from lines ``(path, block, value, begins, offset)``; not ``whole`` are the
    pieces of records that began in an earlier block or go on in a later one."""
    names = ["path", "number", "block", "whole", "text"]

    def rows(key: tuple[str, int], number: int, texts: pa.Array, first: bool, last: bool) -> pa.RecordBatch:
        n = len(texts)
        whole = np.ones(n, dtype=bool)
        whole[0] &= first
        whole[-1] &= last
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(key[0]), n), pa.array(np.arange(number, number + n)), pa.repeat(pa.scalar(key[1], pa.int64()), n), pa.array(whole), texts], names=names)

    # of the record that is not at its end: its lines so far, and whether it began in this block
    now, opened, number, held, own = None, 0, 0, [], True
    for key, run in _runs(batches):
        if key != now:
            if held:
                yield rows(now, number, pa.array([LINE_FEED.join(held)], pa.string()), own, False)
            now, opened, number, held = key, run.column(3)[0].as_py(), run.column(4)[0].as_py(), []
            own = not opened
        lines = run.column(2)
        parity = _open_after(lines, opened)
        opened = int(parity[-1])
        ends = np.flatnonzero(parity == 0) + 1
        begun = int(ends[-1]) if len(ends) else 0
        if begun:
            starts = pa.array(np.concatenate([[0], ends]), pa.int32())
            lists = pa.ListArray.from_arrays(starts, pa.concat_arrays([lines[:begun]]))
            texts = pc.binary_join(lists, LINE_FEED)
            if held:
                texts = pa.concat_arrays([pa.array([LINE_FEED.join([*held, texts[0].as_py()])], pa.string()), texts[1:]])
            yield rows(key, number, texts, own, True)
            number, held, own = number + len(texts), [], True
        held += lines[begun:].to_pylist()
    if held:
        yield rows(now, number, pa.array([LINE_FEED.join(held)], pa.string()), own, False)


def record_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(path, number, text)`` of every record, counted from 0 in its file, without the line feed at its end.

    Empty lines between records are records without text. Quotes must stand around whole fields; a file that ends inside of
    a field is an error.
    """
    lines = spark.read.option("lineSep", LINE_FEED).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    sums = lines.mapInArrow(_block_sums, "path string, block long, odd long, ends0 long, ends1 long")
    by_file, whole_file = Window.partitionBy("path").orderBy("block"), Window.partitionBy("path")
    states = sums.withColumns({"begins": running_before("odd", by_file) % 2, "in_field": F.sum("odd").over(whole_file) % 2})
    ended = F.when(F.col("begins") == 0, F.col("ends0")).otherwise(F.col("ends1"))
    states = states.withColumn("offset", running_before(ended, by_file))
    message = F.concat(F.lit("the CSV file ends inside of a quoted field: "), "path")
    states = states.where(F.when(F.col("in_field") == 0, True).otherwise(F.raise_error(message).cast("boolean")))
    # a row a block
    known = F.broadcast(written(states.select("path", "block", "begins", "offset", ((F.col("begins") + F.col("odd")) % 2).alias("goes_on")), "csv-blocks"))

    def records(blocks: DataFrame) -> DataFrame:
        placed = lines.join(blocks, ["path", "block"]).select("path", "block", "value", "begins", "offset")
        return placed.mapInArrow(_records, "path string, number long, block long, whole boolean, text string")

    pieces = F.array_sort(F.collect_list(F.struct("block", "text")))
    cut = records(known.where("begins = 1 OR goes_on = 1")).where("NOT whole").groupBy("path", "number").agg(pieces.alias("pieces"))
    joined = cut.select("path", "number", F.array_join(F.transform("pieces", lambda p: p["text"]), LINE_FEED).alias("text"))
    every = records(known).where("whole").select("path", "number", "text").union(joined)
    return every.select("path", "number", F.regexp_replace("text", "\r$", "").alias("text"))
