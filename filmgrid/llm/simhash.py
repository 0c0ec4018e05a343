"""Near-duplicates by SimHash, found by multi-index hashing.

A fingerprint has 64 bits; the bits are cut into segments and every segment gets a table. Two fingerprints with at
most ``distance`` differing bits have a segment in which they differ little (pigeonhole), so each fingerprint looks up
a small Hamming ball around each of its segments, and whole distances are checked for what the tables hold there.

Equal fingerprints are folded first. Dense groups of near copies are folded next: each fingerprint goes to the points
of the radius-one ball around it, where at most 65 different ones can meet and all are linked to the smallest.
The lookups then only pair fingerprints of different folds, and table entries of one fold that crowd a bucket are left
out for lookups of the same fold, so that a large group of copies does not meet itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from filmgrid.llm.common import LOWER, UPPER, with_id
from filmgrid.llm.components import components
from filmgrid.session import written

BITS, SEED = 64, 42
SHINGLE, DISTANCE = 4, 4
#: three segments of 22, 21 and 21 bits; far more documents want two of 32, with larger balls and fewer strangers in a bucket
SEGMENTS, CHOICES = 3, (2, 3)
#: entries of one fold in one bucket from which lookups of the same fold pass them by
CROWDED = 64
#: hashes that are counted at a time
CHUNK = 65_536

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(UPPER, LOWER)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each is 1 if set in over half of the shingle hashes; 0 for a text without words."""
    word = _WORD.findall((text or "").translate(_LOWER))
    if not word:
        return 0
    n = max(1, len(word) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, CHUNK):
        hashes = [digest(" ".join(word[i : i + shingle]), SEED) for i in range(start, min(n, start + CHUNK))]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # as signed numbers, the only ones Spark has; the bits are the same
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint)``, a row per row; null texts count as empty."""
    read, kind = with_id(docs, doc_id, F.col(text).alias("text"))
    return read.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, fingerprint long")


def segment_plan(distance: int, segments: int = SEGMENTS) -> list[tuple[int, int, int]]:
    """``(lowest bit, bits, radius)`` of each segment.

    With ``distance = radius * segments + rest``, two near fingerprints differ by at most ``radius`` bits in one of
    the first ``rest + 1`` segments, or else by less than ``radius`` in one of the others.
    """
    radius, rest = divmod(distance, segments)
    plan, low = [], 0
    for i in range(segments):
        bits = BITS // segments + (i < BITS % segments)
        own = radius if i <= rest else radius - 1
        if own >= 0:
            plan.append((low, bits, own))
        low += bits
    return plan


def lookup_cost(prints: int, distance: int, segments: int) -> float:
    """Lookups of one fingerprint and the entries they fetch, if ``prints`` fingerprints spread evenly."""
    balls = [(bits, sum(math.comb(bits, i) for i in range(radius + 1))) for _, bits, radius in segment_plan(distance, segments)]
    return sum(ball * (1 + prints / 2**bits) for bits, ball in balls)


def segments_for(prints: int, distance: int) -> int:
    """The cheaper number of segments. Any number finds the same links."""
    return min(CHOICES, key=lambda n: lookup_cost(prints, distance, n))


def _ball(bits: int, radius: int) -> list[int]:
    """All masks with at most ``radius`` of ``bits`` bits set."""
    masks = {0}
    for _ in range(radius):
        masks |= {m | (1 << b) for m in masks for b in range(bits)}
    return sorted(masks)


def _segment(value: Column, low: int, bits: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << bits) - 1))


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _held(prints: DataFrame, plan: list[tuple[int, int, int]], *columns: str) -> DataFrame:
    """The tables: every fingerprint under its segments, ``(*columns, segment, key)``."""
    entries = [F.struct(F.lit(i).alias("segment"), _segment(F.col("fp"), low, bits).alias("key")) for i, (low, bits, _) in enumerate(plan)]
    return prints.select(*columns, F.explode(F.array(*entries)).alias("at")).select(*columns, "at.segment", "at.key")


def dense_links(prints: DataFrame, distance: int, segments: int = SEGMENTS) -> DataFrame:
    """``(a, b)``: fingerprints of crowded buckets that meet in a point at most one bit from either.

    Only fingerprints whose bucket holds more than ``CROWDED`` are looked at; the others are left to the lookups.
    """
    held = _held(prints, segment_plan(distance, segments), "fp")
    buckets = held.groupBy("segment", "key").count().where(F.col("count") > CROWDED)
    dense = written(held.join(buckets, ["segment", "key"], "left_semi").select("fp").distinct(), "simhash-dense")
    one = F.lit([0] + [(1 << b) - (1 << BITS if b == BITS - 1 else 0) for b in range(BITS)]).cast("array<long>")

    def around(point: str) -> Column:
        return F.explode(F.transform(one, lambda m: F.col(point).bitwiseXOR(m)))

    points = dense.select("fp", around("fp").alias("point"))
    meet = points.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return meet.select("a", around("point").alias("fp")).join(dense, "fp").where("a <> fp").select("a", F.col("fp").alias("b"))


def near_links(folded: DataFrame, distance: int, segments: int = SEGMENTS) -> DataFrame:
    """``(a, b)``: folds that hold fingerprints at most ``distance`` bits apart, from distinct ``(fp, fold)`` rows."""
    plan = segment_plan(distance, segments)
    held = _held(folded, plan, "fp", "fold")
    def ball(number: int, low: int, bits: int, radius: int) -> Column:
        masks = F.lit(_ball(bits, radius)).cast("array<long>")
        own = _segment(F.col("fp"), low, bits)
        return F.transform(masks, lambda m: F.struct(F.lit(number).alias("segment"), own.bitwiseXOR(m).alias("key")))

    balls = F.concat(*[ball(i, *segment) for i, segment in enumerate(plan)])
    asked = folded.select(F.col("fp").alias("ask"), F.col("fold").alias("ask_fold"), F.explode(balls).alias("at"))
    asked = asked.select("ask", "ask_fold", "at.segment", "at.key")

    crowds = held.groupBy("segment", "key", "fold").count().where(F.col("count") > CROWDED).drop("count")
    crowds = written(crowds, "simhash-crowds")
    near = (F.col("fold") != F.col("ask_fold")) & _near("fp", "ask", distance)
    links = asked.join(held.join(crowds, ["segment", "key", "fold"], "left_anti"), ["segment", "key"]).where(near)
    links = links.select("ask_fold", "fold")
    if not crowds.isEmpty():
        strangers = asked.join(crowds, ["segment", "key"]).where("fold <> ask_fold")
        crowded = held.join(crowds, ["segment", "key", "fold"], "left_semi")
        links = links.union(strangers.join(crowded, ["segment", "key", "fold"]).where(_near("fp", "ask", distance)).select("ask_fold", "fold"))
    return links.select(F.least("ask_fold", "fold").alias("a"), F.greatest("ask_fold", "fold").alias("b")).distinct()


def _composed(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(fp, fold)`` with the folds merged along the links; a fold is named by its smallest document."""
    merged = components(links).select(F.col("node").alias("fold"), "component")
    return members.join(merged, "fold", "left").select("fp", F.coalesce("component", "fold").alias("fold"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, segments: int | None = None
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row per row of ``docs``.

    Documents are linked if their fingerprints differ by at most ``distance`` bits; the component is named by its
    smallest ``doc_id``. ``segments`` changes no result; it follows from the number of fingerprints unless it is given.
    Texts without words (null ones too) have fingerprint zero and are linked like any other.
    Repeated rows get the same component. Rows without an id count with the smallest number there is, so that their
    component shows it; an empty table gives an empty result. Other columns of ``docs`` are not looked at.
    An id may be a struct without nulls, for rows that one number does not tell apart; the smallest is that of its fields.
    """
    all_prints = written(fingerprints(docs, doc_id, text, shingle), "simhash-prints")
    number = all_prints.schema["doc_id"].dataType == LongType()
    lowest = F.coalesce("doc_id", F.lit(-(2**63)).cast("long")) if number else F.col("doc_id")
    # a fold is named by its smallest document; different fingerprints never share that unless an id is repeated
    distinct = written(all_prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(lowest).alias("first")), "simhash-distinct")
    segments = segments or segments_for(distinct.count(), distance)
    members = distinct.select("fp", F.col("fp").alias("fold"))
    if distance >= 2:
        members = written(_composed(members, dense_links(distinct, distance, segments)), "simhash-folds")
    members = _composed(members, near_links(members, distance, segments))
    named = members.join(distinct, "fp")
    smallest = named.groupBy("fold").agg(F.min("first").alias("component_id"))
    classes = members.join(smallest, "fold").select(F.col("fp").alias("fingerprint"), "component_id")
    return all_prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")
