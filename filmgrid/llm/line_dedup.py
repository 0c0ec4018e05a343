"""Line deduplication that can be undone, document by document.

The index is a folder of tables, each written in batches that only a finished Spark write makes visible:

* ``references``: one row per (key, document) that a batch brought in, and ``documents``: +1 for every document that a
  batch took in and -1 for one that it took out.
* ``counts``: the exact reference-count table. For every key that a batch touched: how many documents hold it after
  the batch, and the smallest of them. The latest batch of a key counts. Rows lie sorted by shard, so that a look at some
  shards passes over the others.
* ``filters``: one cuckoo filter per shard of the key space, over the keys held by at least one document. Insertion
  asks it which keys may be known: keys it does not know are new for sure, enter the filter and are counted without a
  look at the tables; the others are looked up in the exact counts of their shards. Keys that lose their last holder are
  deleted from it.

When the keys outgrow the shards, the batch that brings them deals all counts and filters out anew over more shards, so no
task ever holds much more than ``SHARD_KEYS`` keys. A key is a 128-bit digest of a line's text, stripped and lower-cased.
Nothing is taken away from the documents themselves, so deleting a document gives the others their lines back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: shorter keys are never dropped (code points)
MIN_KEY = 10
#: keys that one shard's filter is meant to hold, and shards at least
SHARD_KEYS, MIN_SHARDS = 250_000, 8
SLOTS, MAX_KICKS, MAX_LOAD = 4, 500, 0.9

# The white space stripped from both ends of a line.
_BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes | None:
    """Digest of the line's key, or None where the key is too short to count."""
    return _keys_of([line.encode().lower()])[0]


def _keys_of(lines: list[bytes]) -> list[bytes | None]:
    """The keys of lines in UTF-8 whose A-Z are small already, which ``bytes.lower`` does without touching other letters."""
    return [xxhash.xxh3_128_digest(key) if len(key) >= MIN_KEY and _long_enough(key) else None for key in [line.strip(_BLANK) for line in lines]]


def _long_enough(key: bytes) -> bool:
    # a character has four bytes at most
    return len(key) >= 4 * MIN_KEY or key.isascii() or len(key.decode(errors="replace")) >= MIN_KEY


def _bytes(text: pa.StringScalar) -> bytes:
    """The text in UTF-8, null as empty."""
    held = text.as_buffer()
    return held.to_pybytes() if held is not None else b""


class CuckooFilter:
    """Approximate membership of 128-bit keys with deletion: 16-bit marks in buckets of four, each key at home in two."""

    def __init__(self, buckets: int = 64, table: np.ndarray | None = None, n: int = 0):
        self.table = table if table is not None else np.zeros((buckets, SLOTS), dtype=np.uint16)
        self.n = n

    @classmethod
    def sized_for(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8))))))

    @classmethod
    def from_bytes(cls, data: bytes, n: int) -> CuckooFilter:
        return cls(table=np.frombuffer(data, dtype="<u2").reshape(-1, SLOTS).copy(), n=n)

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def homes(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both buckets and the mark of every key. The second bucket follows from the first and the mark alone."""
        raw = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
        mask = np.uint64(len(self.table) - 1)
        marks = (raw[:, 1] >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1
        first = raw[:, 0] & mask
        return first.astype(np.int64), ((first ^ self._jump(marks)) & mask).astype(np.int64), marks

    @staticmethod
    def _jump(marks: np.ndarray) -> np.ndarray:
        return marks.astype(np.uint64) * np.uint64(0x5BD1E995)

    def may_hold(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, dtype=bool)
        first, second, marks = self.homes(keys)
        return (self.table[first] == marks[:, None]).any(1) | (self.table[second] == marks[:, None]).any(1)

    def insert(self, keys: list[bytes]) -> bool:
        """False if there was no room; the filter must then be built anew, larger, from the exact table."""
        if not keys:
            return True
        if self.n + len(keys) > MAX_LOAD * self.table.size:
            return False
        table, mask = self.table, len(self.table) - 1
        for i, j, mark in zip(*(x.tolist() for x in self.homes(keys))):
            for kick in range(MAX_KICKS):
                for bucket in (i, j):
                    free = np.flatnonzero(table[bucket] == 0)
                    if len(free):
                        table[bucket, free[0]] = mark
                        break
                else:
                    slot = (mark + kick) % SLOTS
                    mark, table[j, slot] = int(table[j, slot]), mark
                    i = j
                    j = (i ^ (mark * 0x5BD1E995)) & mask
                    continue
                break
            else:
                return False
            self.n += 1
        return True

    def delete(self, keys: list[bytes]) -> None:
        """Takes out keys that were put in before."""
        if not keys:
            return
        for i, j, mark in zip(*(x.tolist() for x in self.homes(keys))):
            for bucket in (i, j):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    self.n -= 1
                    break


def built_filter(keys: list[bytes], room: int = 1) -> CuckooFilter:
    """A filter over distinct keys, grown until they fit."""
    while True:
        made = CuckooFilter.sized_for(max(16, room * len(keys)))
        if made.insert(keys):
            return made
        room *= 2


def _line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = set(_keys_of(_bytes(text).lower().split(b"\n")))
            own.discard(None)
            ids += [doc] * len(own)
            keys += own
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])


def line_keys(docs: DataFrame) -> DataFrame:
    """``(doc_id, key)``: the different keys of every row."""
    return docs.mapInArrow(_line_keys, "doc_id long, key binary")


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "n_lines", "n_dropped", "left"]
    for batch in batches:
        lines_of, dropped_of, kept_of = [], [], []
        for text, drop in zip(batch.column(1), batch.column(2)):
            whole, gone = _bytes(text), set(drop.as_py() or ())
            if not gone:
                lines_of.append(whole.count(b"\n") + 1)
                dropped_of.append(0)
                kept_of.append(whole)
                continue
            lines = whole.split(b"\n")
            left = [line for line, key in zip(lines, _keys_of(whole.lower().split(b"\n"))) if key not in gone]
            lines_of.append(len(lines))
            dropped_of.append(len(lines) - len(left))
            kept_of.append(b"\n".join(left))
        columns = [batch.column(0), pa.array(lines_of, pa.int64()), pa.array(dropped_of, pa.int64()), pa.array(kept_of, pa.binary()).view(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=names)


class LineIndex:
    """The index in a shared folder. One writer at a time; readers see whole batches only."""

    REFERENCES = "key binary, doc_id long, batch int"
    DOCUMENTS = "doc_id long, change int, batch int"
    COUNTS = "key binary, shard int, n_docs long, first_doc long, batch int"
    FILTERS = "shard int, n_shards int, since int, n long, marks binary, batch int"

    def __init__(self, spark: SparkSession, root: str, shard_keys: int = SHARD_KEYS):
        self.spark, self.root, self.shard_keys = spark, root.rstrip("/"), shard_keys
        tables = {"references": self.REFERENCES, "documents": self.DOCUMENTS, "counts": self.COUNTS, "filters": self.FILTERS}
        for name, schema in tables.items():
            spark.createDataFrame([], schema).write.mode("ignore").partitionBy("batch").parquet(f"{self.root}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _write(self, df: DataFrame, name: str, batch: int) -> DataFrame:
        # a batch that failed half-way is overwritten when it is run again
        path = f"{self.root}/{name}/batch={batch}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def batches(self) -> int:
        """Number of finished batches: the filters are written last."""
        last = self._read("filters", self.FILTERS).agg(F.max("batch").alias("last")).first()["last"]
        return 0 if last is None else last + 1

    def _layout(self, batch: int) -> tuple[int, int, int]:
        """Before a batch: the number of shards, the batch since which it is that, and the keys in all filters."""
        if not batch:
            return 0, 0, 0
        marker = self._read("filters", self.FILTERS).where((F.col("batch") == batch - 1) & (F.col("shard") == -1)).first()
        held = self._current_filters(batch, marker["since"]).agg(F.sum("n").alias("n")).first()["n"]
        return marker["n_shards"], marker["since"], held or 0

    def _latest(self, batch: int, since: int, shards: list[int] | None = None) -> DataFrame:
        """``(key, shard, n_docs, first_doc)`` before a batch, of all shards or some, keys without holders among them."""
        done = self._read("counts", self.COUNTS).where(F.col("batch").between(since, batch - 1))
        if shards is not None:
            done = done.where(F.col("shard").isin(shards))
        if since == batch - 1:
            return done.drop("batch")
        latest = F.max_by(F.struct("shard", "n_docs", "first_doc"), "batch").alias("now")
        return done.groupBy("key").agg(latest).select("key", "now.*")

    def counts(self) -> DataFrame:
        """``(key, n_docs, first_doc)`` after the last finished batch, keys without holders left out."""
        batch = self.batches()
        _, since, _ = self._layout(batch)
        return self._latest(batch, since).where("n_docs > 0").select("key", "n_docs", "first_doc")

    def _held(self, batch: int) -> DataFrame:
        """``(doc_id)`` of the documents held before a batch."""
        latest = F.max_by("change", "batch").alias("change")
        done = self._read("documents", self.DOCUMENTS).where(F.col("batch") < batch)
        return done.groupBy("doc_id").agg(latest).where("change = 1").select("doc_id")

    def holders(self) -> DataFrame:
        """``(key, doc_id)`` of the documents held now."""
        batch = self.batches()
        done = self._read("references", self.REFERENCES).where(F.col("batch") < batch)
        if batch <= 1:
            return done.select("key", "doc_id")
        # a document that went took along what earlier batches had brought of it
        went = self._read("documents", self.DOCUMENTS).where((F.col("batch") < batch) & (F.col("change") < 0))
        went = went.groupBy("doc_id").agg(F.max("batch").alias("went"))
        return done.alias("r").join(went.alias("w"), F.expr("r.doc_id = w.doc_id AND r.batch < w.went"), "left_anti").select("key", "doc_id")

    def insert(self, docs: DataFrame) -> None:
        """Takes in rows ``(doc_id, text)``. Documents that the index holds already change nothing; delete them first.

        Rows that repeat an id are one document with the lines of all of them; rows without an id are left out, since
        they could not be deleted. An empty batch changes nothing but the number of batches.
        """
        batch = self.batches()
        n_shards, since, n_held = self._layout(batch)
        rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
        ids, pairs = rows.select("doc_id").distinct(), line_keys(rows).distinct()
        if batch:
            ids = ids.join(self._held(batch), "doc_id", "left_anti")
        taken = self._write(ids.withColumn("change", F.lit(1)), "documents", batch)
        if batch:  # ids and digests meet, so no text is moved
            pairs = pairs.join(taken.select("doc_id"), "doc_id", "left_semi")
        added = self._write(pairs.select("key", "doc_id"), "references", batch)
        # folded per task before the shuffle: a line that many documents share sends one row per task
        touched = added.groupBy("key").agg(F.count(F.lit(1)).alias("more"), F.min("doc_id").alias("first"))
        # as many keys as the batch may have at most
        wanted = max(MIN_SHARDS, -(-(n_held + added.count()) // self.shard_keys))
        if not batch or wanted > 2 * n_shards:
            self._deal_out(batch, since, touched, wanted)
        else:
            self._ask(batch, n_shards, since, touched)

    def _deal_out(self, batch: int, since: int, touched: DataFrame, n_shards: int) -> None:
        """Counts of all keys and all filters anew, over a number of shards."""
        now = touched.select("key", F.col("more").alias("n_docs"), F.col("first").alias("first_doc"))
        if batch:
            earlier = self._latest(batch, since).where("n_docs > 0").select("key", "n_docs", "first_doc")
            now = now.union(earlier).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"))
        counts = self._write_counts(now.withColumn("shard", self._shard(n_shards)), batch)
        self._write_filters(self._built(counts), n_shards, batch, batch)

    def _ask(self, batch: int, n_shards: int, since: int, touched: DataFrame) -> None:
        """Counts of the batch's keys. The filters say which keys need a look at the exact table, and take in the others."""

        def ask(key: tuple, keys: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            own = list(keys["key"])
            held = CuckooFilter.from_bytes(state["marks"].iloc[0], int(state["n"].iloc[0])) if len(state) else CuckooFilter(16)
            maybe = held.may_hold(own)
            fits = held.insert([k for k, known in zip(own, maybe) if not known])
            # ids stay whole numbers beside the missing ones of the filter's row; as floats they would lose digits
            whole = {c: keys[c].astype("Int64") for c in ("more", "first")}
            rows = pd.DataFrame({"shard": key[0], "key": own, **whole, "maybe": maybe})
            mark = pd.DataFrame({"shard": [key[0]], "n": pd.array([held.n], "Int64"), "marks": [held.to_bytes()], "fits": [fits]})
            return pd.concat([rows, mark], ignore_index=True)[["shard", "key", "more", "first", "maybe", "n", "marks", "fits"]]

        fields = "shard int, key binary, more long, first long, maybe boolean, n long, marks binary, fits boolean"
        own = touched.select(self._shard(n_shards).alias("shard")).distinct()
        state = self._current_filters(batch, since).join(own, "shard", "left_semi").groupBy("shard")
        sharded = touched.withColumn("shard", self._shard(n_shards)).groupBy("shard")
        asked = self._write(sharded.cogroup(state).applyInPandas(ask, fields), "asked", batch)
        keys, states = asked.where("key IS NOT NULL"), asked.where("key IS NULL").select("shard", "n", "marks", "fits")
        maybe = keys.where("maybe")
        # numbers of shards only
        shards = [r["shard"] for r in maybe.select("shard").distinct().collect()]
        exact = self._latest(batch, since, shards).select("key", F.col("n_docs").alias("n_before"), "first_doc")
        known = maybe.join(exact, "key", "left").withColumn("n_before", F.coalesce("n_before", F.lit(0)))
        known = self._write(known.select("key", "shard", "more", "first", "n_before", "first_doc"), "looked", batch)
        grown = known.select("key", "shard", (F.col("more") + F.col("n_before")).alias("n_docs"), F.least("first", "first_doc").alias("first_doc"))
        new = keys.where("NOT maybe").select("key", "shard", F.col("more").alias("n_docs"), F.col("first").alias("first_doc"))
        self._write_counts(grown.union(new), batch)
        mistaken = known.where("n_before = 0").select("shard", "key", F.lit(True).alias("alive"))
        self._finish(batch, n_shards, since, states, mistaken)

    def delete(self, doc_ids: DataFrame) -> None:
        """Takes out the documents of a one-column frame of ids; unknown ids change nothing."""
        batch = self.batches()
        n_shards, since, _ = self._layout(batch)
        gone = doc_ids.toDF("doc_id").where("doc_id IS NOT NULL").distinct().join(self._held(batch), "doc_id", "left_semi") if batch else doc_ids.toDF("doc_id").limit(0)
        gone = self._write(gone.withColumn("change", F.lit(-1)), "documents", batch).select("doc_id")
        held = self.holders()
        lost = self._write(held.join(gone, "doc_id", "left_semi").select("key").distinct(), "lost", batch)
        left = held.join(gone, "doc_id", "left_anti").join(lost, "key", "left_semi")
        now = left.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
        n_shards = n_shards or MIN_SHARDS
        counts = lost.join(now, "key", "left").select(
            "key", self._shard(n_shards).alias("shard"), F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"), "first_doc"
        )
        dead = self._write_counts(counts, batch).where("n_docs = 0").select("shard", "key", F.lit(False).alias("alive"))
        states = self._current_filters(batch, since).join(dead.select("shard").distinct(), "shard", "left_semi")
        self._finish(batch, n_shards, since, states.select("shard", "n", "marks", F.lit(True).alias("fits")), dead)

    def _write_counts(self, counts: DataFrame, batch: int) -> DataFrame:
        rows = counts.select("key", "shard", F.col("n_docs").cast("long").alias("n_docs"), "first_doc")
        return self._write(rows.sortWithinPartitions("shard"), "counts", batch)

    def _current_filters(self, batch: int, since: int = 0) -> DataFrame:
        before = self._read("filters", self.FILTERS).where(F.col("batch").between(since, batch - 1) & (F.col("shard") >= 0))
        return before.groupBy("shard").agg(F.max_by(F.struct("n", "marks"), "batch").alias("now")).select("shard", "now.*")

    @staticmethod
    def _shard(n_shards: int):
        return F.pmod(F.xxhash64("key"), F.lit(n_shards)).cast("int")

    def _built(self, counts: DataFrame) -> DataFrame:
        """``(shard, n, marks)`` from the exact counts."""

        def build(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
            made = built_filter(list(keys["key"]), 2)
            return pd.DataFrame({"shard": [key[0]], "n": [made.n], "marks": [made.to_bytes()]})

        alive = counts.where("n_docs > 0").select("shard", "key")
        return alive.groupBy("shard").applyInPandas(build, "shard int, n long, marks binary")

    def _finish(self, batch: int, n_shards: int, since: int, states: DataFrame, changes: DataFrame) -> None:
        """New filters: ``states`` with keys ``(shard, key, alive)`` put in or taken out; those that overflow are built anew."""

        def change(key: tuple, state: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            made = CuckooFilter.from_bytes(state["marks"].iloc[0], int(state["n"].iloc[0]))
            alive = keys["alive"].astype(bool)
            made.delete(list(keys["key"][~alive]))
            fits = bool(state["fits"].iloc[0]) and made.insert(list(keys["key"][alive]))
            return pd.DataFrame({"shard": [key[0]], "n": [made.n], "marks": [made.to_bytes()], "fits": [fits]})

        if not changes.isEmpty():
            changed = states.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, "shard int, n long, marks binary, fits boolean")
            states = self._write(changed, "changed_filters", batch)
        kept = states.where("fits").drop("fits")
        # numbers of shards only
        full = [r["shard"] for r in states.where("NOT fits").select("shard").collect()]
        if full:
            kept = kept.union(self._built(self._latest(batch + 1, since, full)))
        self._write_filters(kept, n_shards, since, batch)

    def _write_filters(self, states: DataFrame, n_shards: int, since: int, batch: int) -> None:
        # one row more, so that a batch that touched no shard is finished, too
        marker = self.spark.createDataFrame([(-1, 0, b"")], "shard int, n long, marks binary")
        rows = states.select("shard", "n", "marks").union(marker)
        placed = rows.select("shard", F.lit(n_shards).alias("n_shards"), F.lit(since).alias("since"), "n", "marks")
        self._write(placed, "filters", batch)

    def clean(self, docs: DataFrame, counts: bool = True) -> DataFrame:
        """The rows ``(doc_id, text, ...)`` with the text that stays and, if ``counts``, ``n_lines`` and ``n_dropped``.

        A line goes if its key is held by at least two documents of the index of which another one has the smallest
        id. Null and empty texts have one empty line, which stays, and become empty. Rows without an id keep all their
        lines. Rows that repeat an id are cleaned alike. Columns that have the names of the counts are replaced by
        them; without the counts, all columns stay.
        """
        shared = self.counts().where("n_docs > 1").select("key", "first_doc")
        lost = self.holders().join(shared, "key").where("doc_id <> first_doc")
        # one list for each document, as long as its own lines at most
        drops = lost.groupBy("doc_id").agg(F.collect_list("key").alias("drop")).withColumnRenamed("doc_id", "of")
        added = ["n_lines", "n_dropped"] if counts else []
        kept = [c for c in docs.columns if c.lower() not in added]
        others = [F.col(f"`{c}`") for c in kept if c.lower() != "text"]
        rows = docs.select(F.struct(*others).alias("row"), F.col("text"), F.col("doc_id").alias("id"))
        joined = rows.join(drops, F.col("id") == F.col("of"), "left").select("row", "text", "drop")
        schema = StructType([rows.schema["row"]]).add("n_lines", "long").add("n_dropped", "long").add("left", "string")
        cleaned = joined.mapInArrow(_without_lines, schema)
        columns = [F.col("left").alias(c) if c.lower() == "text" else F.col(f"row.`{c}`") for c in kept]
        return cleaned.select(*columns, *added)
