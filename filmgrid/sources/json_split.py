"""One large JSON document read by many tasks.

Where a record ends depends on everything before it: on the depth of brackets, and on whether a bracket stands in a string.
So the file is cut at every closing brace, wherever tasks happen to begin, and each piece says what it does to both: how
many quotes it has, and how it changes the depth if it begins outside of a string, and if inside. These maps compose:
running sums inside a block of the file, which one task has read, and over the blocks' totals, a short table, give the
state at the start of every piece. Pieces between two ends of records are then put together again, so a task never holds
more than a block's pieces in sequence and a record's pieces at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmgrid.session import written

END = "}"


def _depth_change(segments: Column, quotes: Column, inside: int) -> Column:
    """Brackets opened less brackets closed by a piece and the brace behind it, for one that begins inside a string or not."""
    outside = F.array_join(F.filter(segments, lambda s, i: i % 2 == inside), "")
    opened = F.length(F.regexp_replace(outside, r"[^{\[]", ""))
    closed = F.length(F.regexp_replace(outside, r"[^}\]]", ""))
    return opened - closed - F.when((quotes + inside) % 2 == 0, 1).otherwise(0)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, path, block, size, row, value, quotes, change0, change1)`` for every piece that a brace ends."""
    rows = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    # characters behind a backslash mean nothing; a backslash never stands before a brace
    split = rows.withColumn("segments", F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"'))
    quoted = split.withColumn("quotes", F.size("segments") - 1)
    changes = {f"change{e}": _depth_change(F.col("segments"), F.col("quotes"), e) for e in (0, 1)}
    return quoted.withColumns(changes).drop("segments")


def running_before(column: str | Column, window) -> Column:
    """Sum over the rows before a row."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def record_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, path, part, text, opening, last)``: the document cut into parts that each hold whole records, in order.

    A part ends behind an object that is an entry of the document's outermost array or object; the ``last`` part is what
    follows the last such object. ``opening`` is the document's first character. A document that does not end where its
    brackets do is an error. Files of a record or less have one part.
    """
    place = Window.partitionBy("path", "block").orderBy("row")
    inside = _pieces(spark, path).withColumn("strings", running_before("quotes", place) % 2)
    # the change if the block begins outside of a string, and if inside
    whole = lambda e: F.when((F.col("strings") + e) % 2 == 0, F.col("change0")).otherwise(F.col("change1"))
    changed = inside.withColumns({f"in{e}": whole(e) for e in (0, 1)})
    summed = changed.withColumns({f"depth{e}": F.sum(f"in{e}").over(place) for e in (0, 1)})
    kept = written(summed.select("file", "path", "block", "size", "row", "value", "quotes", "strings", "in0", "in1", "depth0", "depth1"), "json-pieces")

    # what every block does, and the state in which it begins
    by_file = Window.partitionBy("path").orderBy("block")
    first = F.min_by(F.regexp_extract("value", r"^\s*(\S)", 1), "row").alias("opening")
    taken = F.sum(F.octet_length("value") + 1).alias("taken")
    sums = [F.sum(c).alias(c) for c in ("quotes", "in0", "in1")]
    blocks = kept.groupBy("path", "block").agg(*sums, taken, F.first("size").alias("size"), first)
    begun = blocks.withColumn("begins", running_before("quotes", by_file) % 2)
    begun = begun.withColumn("change", F.when(F.col("begins") == 0, F.col("in0")).otherwise(F.col("in1")))
    whole_file = Window.partitionBy("path")
    ends = begun.withColumns(
        {
            "depth": running_before("change", by_file),
            "opening": F.first("opening").over(by_file),
            "at_end": F.sum("change").over(whole_file),
            "in_string": F.sum("quotes").over(whole_file) % 2,
            "taken": F.sum("taken").over(whole_file),
        }
    )
    # every piece was taken to end in a brace, the last one too, and it may not
    surplus = F.when(F.col("taken") > F.col("size"), -1).otherwise(0)
    closed = (F.col("at_end") == surplus) & (F.col("in_string") == 0)
    message = F.concat(F.lit("the JSON document ends inside a record: "), "path")
    checked = ends.where(F.when(closed, True).otherwise(F.raise_error(message).cast("boolean")))
    states = written(checked.select("path", "block", "begins", "depth", "opening", (surplus == 0).alias("braced")), "json-blocks")

    known = kept.join(states, ["path", "block"])
    outside = (F.col("begins") + F.col("strings") + F.col("quotes")) % 2 == 0
    depth = F.col("depth") + F.when(F.col("begins") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    flagged = known.withColumn("ends", F.when(outside & (depth == 1), 1).otherwise(0))
    counts = flagged.groupBy("path", "block").agg(F.sum("ends").alias("ended"))
    offsets = counts.select("path", "block", running_before("ended", by_file).alias("offset"), F.sum("ended").over(whole_file).alias("ended"))
    numbered = flagged.join(offsets, ["path", "block"]).withColumn("part", F.col("offset") + running_before("ends", place))
    pieces = F.array_sort(F.collect_list(F.struct("block", "row", "value")))
    parts = numbered.groupBy("file", "path", "opening", "braced", "ended", "part").agg(pieces.alias("pieces"), F.max("ends").alias("ends"))
    last = F.col("part") == F.col("ended")
    ends = (F.col("ends") == 1) | (last & F.col("braced"))
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["value"]), END), F.when(ends, END).otherwise(""))
    return parts.select("file", "path", "part", text.alias("text"), "opening", last.alias("last"))


def entries_of_part() -> Column:
    """A part's entries as a document of its own: the outer brackets and the comma before it go, and brackets come around."""
    text, is_array = F.col("text"), F.col("opening") == "["
    begun = F.when(F.col("part") == 0, F.regexp_replace(text, r"^\s*[{\[]", "")).otherwise(F.regexp_replace(text, r"^\s*,", ""))
    bare = F.when(F.col("last"), F.regexp_replace(begun, r"[}\]]\s*$", "")).otherwise(begun)
    return F.when(is_array, F.concat(F.lit("["), bare, F.lit("]"))).otherwise(F.concat(F.lit("{"), bare, F.lit("}")))
