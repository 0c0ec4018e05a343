"""WARC archives: a deterministic sharded writer and a reader.

Records are ordered by page, and running sums of payload bytes in that order cut them into shards, so the shards do not
depend on how Spark happens to partition. A shard is written by one task, record by record: headers and digests are
made anew, and a file is closed once its compressed size is reached. Files are written under temporary names that no
other attempt uses; Spark's committed manifest says which attempts count; their files are then renamed, and a second
manifest of final names is written last. A reader goes by that manifest alone, so it sees all of an archive or nothing.

Of records with equal payloads the first is a response and the others are revisits that refer to it. A revisit keeps
the HTTP header, which tells the payload's length, but not the payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmgrid.session import written

#: payload bytes of a shard, and compressed bytes after which a file is closed
SHARD_BYTES, FILE_BYTES = 64 << 20, 16 << 20
#: equal payloads of fewer bytes are all written as responses
REVISIT_BYTES = 0
# Names and versions of the format, and the date of every record, so that files repeat byte by byte.
WARC, REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_BEYOND = 2**63 - 1

MANIFEST = "shard long, file long, temporary string, name string, records long, bytes long, sha256 string"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark resolves it, for tasks that open files themselves."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(there).toString()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; ``file:/x`` is how Hadoop writes ``file:///x``."""
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    """A header value without line ends or characters that are no text."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_id(page_id: int | None, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id}/{ordinal}')}>"


def record(page_id: int | None, ordinal: int, url: str | None, size: int, digest: str, payload: bytes | None, refers_to: tuple | None) -> bytes:
    """One record: a response with its payload, or a revisit where ``payload`` is None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [
        WARC,
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, ordinal)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {_one_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if payload is None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(*refers_to)}"]
        if refers_to[0] is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to[0]}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _ShardFile:
    """A file under a temporary name; each record is a gzip member of its own."""

    def __init__(self, root: str, shard: int, number: int):
        self.name = f"part-{shard:08d}-{number:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        self.shard, self.number, self.records, self.bytes, self.seen = shard, number, 0, 0, hashlib.sha256()
        system, folder = opened(root)
        system.create_dir(f"{folder}/_temporary", recursive=True)
        self.stream = system.open_output_stream(f"{folder}/{self.temporary}", compression=None)

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, compresslevel=6, mtime=0)
        self.stream.write(member)
        self.seen.update(member)
        self.bytes += len(member)
        self.records += 1

    def closed(self) -> dict:
        self.stream.close()
        return {
            "shard": self.shard, "file": self.number, "temporary": self.temporary, "name": self.name,
            "records": self.records, "bytes": self.bytes, "sha256": self.seen.hexdigest(),
        }


def _write_shards(root: str, file_bytes: int):
    """Rows sorted by shard and page, each page's plan before its payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int64()), ("file", pa.int64()), ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
        current, plan, copy = None, None, 0
        for batch in batches:
            done = []
            columns = [batch.column(n) for n in ("shard", "page_id", "url", "digest", "payload", "ordinal", "size", "first_page", "first_ordinal")]
            for row in range(batch.num_rows):
                shard, page, url, digest, payload, ordinal, size, first_page, first_ordinal = (c[row].as_py() for c in columns)
                if ordinal is not None:
                    plan, copy = (ordinal, size, first_page, first_ordinal), 0
                    continue
                ordinal, size, first_page, first_ordinal = plan
                own, copy = ordinal + copy, copy + 1
                if current is None or current.shard != shard or current.bytes >= file_bytes:
                    number = current.number + 1 if current is not None and current.shard == shard else 0
                    if current is not None:
                        done.append(current.closed())
                    current = _ShardFile(root, shard, number)
                is_first = first_ordinal is None or own == first_ordinal
                if is_first and payload is None:
                    raise ValueError("a response without its payload")
                base32 = base64.b32encode(digest).decode()
                if is_first and payload_digest(payload.encode()) != base32:
                    raise ValueError("payload and digest disagree")
                current.add(record(page, own, url, size, base32, payload.encode() if is_first else None, None if is_first else (first_page, first_ordinal)))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.closed()], schema=schema)

    return run


def _renamed(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = opened(root)
        for batch in batches:
            for row in batch.to_pylist():
                before, after = f"{folder}/{row['temporary']}", f"{folder}/{row['name']}"
                # a retried task finds its work done
                if system.get_file_info(before).type != fs.FileType.NotFound:
                    system.move(before, after)
            yield batch

    return run


def located(pages: DataFrame) -> DataFrame:
    """``(page_id, url, digest, size, copies, ordinal, bytes_before)`` for each different row, in page order.

    The order is (page, url, digest), pages without an id last. Running sums are taken inside Spark's range partitions
    and over the partitions' totals; the result is the same for any partitioning.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.unhex(F.sha1(payload.cast("binary"))).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    rows = rows.groupBy("page_id", "url", "digest").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("copies"))
    order = [F.col("page_id").asc_nulls_last(), F.col("url").asc_nulls_first(), F.col("digest")]
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    kept = written(ranged, "warc-order")
    totals = kept.groupBy("part").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.col("size")).alias("bytes"))
    # one short row for each partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("part_bytes")
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = kept.withColumns(
        {
            "local": F.coalesce(F.sum("copies").over(inside), F.lit(0)),
            "local_bytes": F.coalesce(F.sum(F.col("copies") * F.col("size")).over(inside), F.lit(0)),
        }
    )
    return local.join(before, "part").select(
        "page_id", "url", "digest", "size", "copies", (F.col("n_before") + F.col("local")).alias("ordinal"), (F.col("part_bytes") + F.col("local_bytes")).alias("bytes_before")
    )


def _shard_of(page: Column, starts: list[int]) -> Column:
    """The last shard that starts at or before a page; pages without an id are in the last one."""
    bounds = np.array(starts, dtype=np.int64)

    @F.pandas_udf("long")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), "right") - 1)

    return find(F.coalesce(page.cast("long"), F.lit(_BEYOND)))


def write_archive(pages: DataFrame, root: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Writes a record for every row of ``pages (page_id, url, html)`` below ``root`` and returns the manifest.

    Payloads are the html in UTF-8, null ones are empty. Of records with equal payloads of at least ``revisit_bytes``
    the first in page order is the response; rows without an id come last. Rows that repeat in full are a record each.
    An empty table gives an empty manifest. Other columns are not looked at. Line ends in urls are percent-encoded.
    """
    spark = pages.sparkSession
    root = qualified(spark, root.rstrip("/"))
    order = written(located(pages), "warc-located")
    # only payloads that occur again need their first record looked up
    repeated = order.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(
        F.sum("copies").alias("n"), F.min(F.struct("ordinal", "page_id")).alias("first")
    )
    repeated = repeated.where("n > 1").select("digest", F.col("first.ordinal").alias("first_ordinal"), F.col("first.page_id").alias("first_page"))
    begins = order.withColumn("shard", F.floor(F.col("bytes_before") / shard_bytes)).groupBy("shard")
    # one number for each shard; a page that repeats across a border stays with the earlier shard
    starts = [r["page"] for r in begins.agg(F.min(F.coalesce("page_id", F.lit(_BEYOND))).alias("page")).orderBy("page").collect()]
    if starts:
        starts[0] = -(2**63)

    plans = order.join(repeated, "digest", "left").select(
        "page_id", "url", "digest", F.lit(None).cast("string").alias("payload"), "ordinal", "size", "first_page", "first_ordinal"
    )
    payload = F.coalesce(F.col("html"), F.lit(""))
    nothing = F.lit(None).cast("long")
    records = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.unhex(F.sha1(payload.cast("binary"))).alias("digest"), payload.alias("payload"),
        nothing.alias("ordinal"), nothing.alias("size"), nothing.alias("first_page"), nothing.alias("first_ordinal"),
    )
    rows = plans.union(records).withColumn("shard", _shard_of(F.col("page_id"), starts))
    ordered = rows.repartition(max(1, len(starts)), "shard").sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_last(), F.col("url").asc_nulls_first(), "digest", F.col("ordinal").asc_nulls_last()
    )
    fields = ordered.select("shard", "page_id", "url", "digest", "payload", "ordinal", "size", "first_page", "first_ordinal")
    made = f"{root}/_manifest_of_temporary_files"
    fields.mapInArrow(_write_shards(root, file_bytes), MANIFEST).write.mode("overwrite").parquet(made)
    attempts = spark.read.schema(MANIFEST).parquet(made)
    renamed = attempts.repartition(max(1, len(starts)), "name").mapInArrow(_renamed(root), MANIFEST)
    renamed.drop("temporary").write.mode("overwrite").parquet(f"{root}/manifest")
    system, folder = opened(root)
    if system.get_file_info(f"{folder}/_temporary").type != fs.FileType.NotFound:
        system.delete_dir(f"{folder}/_temporary")  # attempts that did not count
    return manifest(spark, root)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files of a finished archive."""
    return spark.read.schema("shard long, file long, name string, records long, bytes long, sha256 string").parquet(f"{root.rstrip('/')}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    engine, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(engine.decompress(chunk))
            chunk = engine.unused_data
            if engine.eof:
                yield b"".join(parts)
                engine, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("a file ends inside a record")


def parsed(data: bytes) -> dict:
    """Headers and payload of a record; checks lengths and digests."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != WARC:
        raise ValueError("not a record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError("a damaged record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("a damaged payload")
    return {"fields": fields, "payload": payload, "size": size, "digest": digest}


def _read_files(root: str):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = opened(root)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        r = parsed(data)
                        f = r["fields"]
                        number = lambda key: int(f[key]) if key in f else None
                        is_response = f["WARC-Type"] == "response"
                        rows.append((number("X-Page-ID"), f.get("WARC-Target-URI"), r["size"], r["digest"], f["WARC-Type"], number("X-Refers-To-Page-ID"), r["payload"].decode() if is_response else None))
                        held += len(r["payload"])
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, html)`` of every record of a finished archive.

    The html of a revisit is null; it is that of the record it refers to. Lengths and digests are checked.
    """
    root = qualified(spark, root.rstrip("/"))
    files = manifest(spark, root).select("name")
    n = max(1, files.count())
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
    return files.repartition(n, "name").mapInArrow(_read_files(root), schema)
