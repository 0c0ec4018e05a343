"""Benchmark decontamination by greedy string tiling.

A document is contaminated by a benchmark item if tiles, runs of at least five tokens that both share and that do not
overlap on either side, cover enough of the item. The order of the tiles does not matter, so reordered passages count.

1. Every run of five tokens of an item is a seed. A bitmap of fixed size over the seeds' hashes tells which runs of a
   document may be seeds; all others are gone before anything is shuffled.
2. Candidates: an item whose tiles cover ``k`` tokens shares at least ``k / longest run`` seeds; counting tiles of five
   tokens as the worst case, it shares at least ``ceil(k / 5)`` of its seed places. So of each item the commonest
   ``ceil(k / 5) - 1`` places can be left out of the candidate join without losing an item, which keeps a passage that
   half of the benchmark shares from pairing every document with every item.
3. Tiling: documents and items are rows of seed places. A run of ``n`` consecutive shared seeds is a shared run of
   ``n + 4`` tokens, so the tiles are found on the seeds alone: Karp-Rabin hashes of runs, longest first.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmgrid.llm.common import with_id
from filmgrid.session import written

#: tokens of the shortest tile, and the share of an item's tokens that tiles must cover
MIN_TILE, MIN_COVERAGE = 5, 0.8
#: bits of the map of seeds; the map is all that is sent to every executor, whatever the benchmark's size
MAP_BITS = 1 << 26
# Odd multipliers of the polynomial hash.
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, as an array; empty for null."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(found, lambda t: t != ""), lambda t: F.xxhash64(t))


def seed_hashes(token: np.ndarray, size: int = MIN_TILE) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` tokens, in order; empty if there are fewer."""
    n = len(token) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    value, found = token.view(np.uint64), np.zeros(n, dtype=np.uint64)
    for i in range(size):
        found = found * np.uint64(_BASE) + value[i : i + n]
    found ^= found >> np.uint64(29)
    found *= np.uint64(_MIX)
    return found ^ (found >> np.uint64(32))


def _ends(goes_on: np.ndarray) -> np.ndarray:
    """For every place the first place after it that does not go on from the one before; ``goes_on`` begins with place 1."""
    stops = np.append(np.flatnonzero(~goes_on) + 1, len(goes_on) + 1)
    return stops[np.searchsorted(stops, np.arange(len(goes_on) + 1), "right")]


def _item_seeds(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [seed_hashes(row.values.to_numpy(zero_copy_only=False), size).view(np.int64) for row in batch.column(1)]
            lengths = pa.array([len(row) for row in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), lengths, pa.array(found, pa.list_(pa.int64()))], names=["item_id", "n_tokens", "seeds"])

    return run


def _hits(size: int, bitmap: np.ndarray):
    mask = np.uint64(len(bitmap) * 8 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            offsets, flat = column.offsets.to_numpy(), column.flatten().to_numpy(zero_copy_only=False)
            offsets = offsets - offsets[0]
            # all rows at once: a run that starts in one row and ends in the next is left out below
            seeds = seed_hashes(flat, size)
            at = seeds & mask
            bits = bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
            places = np.flatnonzero(bits & 1)
            row = np.searchsorted(offsets, places, "right") - 1
            inside = places + size <= offsets[row + 1]
            places, row = places[inside], row[inside]
            rows, first = np.unique(row, return_index=True)
            bounds = np.append(first, len(row)).astype(np.int32)
            doc = batch.column(0).take(pa.array(rows))
            at_token = pa.array((places - offsets[row]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.ListArray.from_arrays(bounds, at_token), pa.ListArray.from_arrays(bounds, pa.array(seeds[places].view(np.int64)))],
                names=["doc_id", "places", "seeds"],
            )

    return run


def seed_map(seeds: DataFrame, bits: int = MAP_BITS) -> np.ndarray:
    """Bitmap of the seeds' lowest hash bits. Built in parts of 4 KB where the seeds are; the driver puts them together."""
    at = F.col("seed").bitwiseAND(F.lit(bits - 1)) + 1  # Spark numbers places from 1
    parts = seeds.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    found = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        part = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        start = (row["part"] - 1) * len(part)
        found[start : start + len(part)] = part[: len(found) - start]
    return found


class _Runs:
    """Karp-Rabin hashes of all runs of a sequence: sums of ``value * base ** -place``, shifted back to place 0."""

    def __init__(self, values: np.ndarray):
        inverse = pow(_BASE, -1, 1 << 64)

        def powers(base: int) -> np.ndarray:
            steps = np.full(len(values) + 1, base, dtype=np.uint64)
            steps[0] = 1
            return np.cumprod(steps)

        self.up = powers(_BASE)
        sums = np.cumsum(values * powers(inverse)[:-1], dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), sums])

    def of(self, n: int) -> np.ndarray:
        return (self.sums[n:] - self.sums[:-n]) * self.up[: len(self.sums) - n]


def _clear(taken: np.ndarray, n: int) -> np.ndarray:
    """For every place, whether the ``n`` tokens from there are unmarked."""
    total = np.concatenate([[0], np.cumsum(taken)])
    return total[n:] == total[:-n]


def tiles(doc_places: np.ndarray, doc_seeds: np.ndarray, item_seeds: np.ndarray, size: int = MIN_TILE, first: int = 16) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(place in the document, place in the item, tokens)`` of each tile.

    ``doc_places`` ascend and say at which token each seed of the document starts; the item's seeds start at 0, 1, and
    so on. A round looks for runs of ``n`` unmarked seeds with equal Karp-Rabin hashes, compares and extends them. If
    one is more than twice as long, the round starts again with its length; otherwise the runs are marked, longest
    first (then leftmost in the document, then in the item), what marks have cut short goes back in line, and ``n`` is
    halved until single seeds are done. Places are matched only where a run begins, so a repetitive text costs a step
    for each of its runs, not for each pair of places in them.
    """
    shared = np.isin(doc_seeds, item_seeds)
    places, seeds = doc_places[shared].astype(np.int64), doc_seeds[shared].view(np.uint64)
    own = item_seeds.view(np.uint64)
    found: list[tuple[int, int, int]] = []
    if not len(places):
        return found
    places = places - (base := int(places[0]))
    doc_taken = np.zeros(int(places[-1]) + size, dtype=bool)
    item_taken = np.zeros(len(own) + size - 1, dtype=bool)
    doc_runs, item_runs = _Runs(seeds), _Runs(own)

    def scan(n: int) -> list[tuple[int, int, int]]:
        """Runs of ``n`` seeds and more that cannot begin earlier, each with its whole length."""
        if n > min(len(places), len(own)):
            return []
        next_to = places[1:] == places[:-1] + 1
        # where a run must end: at a gap, or before the seed that reaches into a marked token
        doc_end = _ends(next_to & ~doc_taken[places[1:] + size - 1])
        item_end = _ends(~item_taken[size:])
        # whether a run could go on to the left
        doc_open = np.concatenate([[False], next_to & ~doc_taken[places[1:] - 1]])
        item_open = np.concatenate([[False], ~item_taken[: len(own) - 1]])
        item_free = np.flatnonzero(_clear(item_taken, n + size - 1))
        item_hashes = item_runs.of(n)[item_free]
        # by hash, then by the seed before: places with the same seed before are parts of a run that begins earlier
        at: dict[int, dict[int | None, list[int]]] = defaultdict(lambda: defaultdict(list))
        for h, i in zip(item_hashes.tolist(), item_free.tolist()):
            at[h][int(own[i - 1]) if item_open[i] else None].append(i)
        whole = places[n - 1 :] == places[: len(places) - n + 1] + n - 1
        doc_free = np.flatnonzero(whole & _clear(doc_taken, n + size - 1)[np.minimum(places[: len(whole)], len(doc_taken) - n - size + 1)])
        doc_hashes = doc_runs.of(n)[doc_free]
        matching = np.isin(doc_hashes, item_hashes)
        runs = []
        for j, h in zip(doc_free[matching].tolist(), doc_hashes[matching].tolist()):
            before = int(seeds[j - 1]) if doc_open[j] else None
            for other, starts in at[h].items():
                if before is not None and before == other:
                    continue
                for i in starts:
                    # hashes find, the seeds decide
                    most = min(doc_end[j] - j, item_end[i] - i)
                    unlike = seeds[j : j + most] != own[i : i + most]
                    length = int(unlike.argmax()) if unlike.any() else int(most)
                    if length >= n:
                        runs.append((-length, int(places[j]), i))
        return runs

    n = min(first, len(own))
    while True:
        runs = scan(n)
        longest = max((-r[0] for r in runs), default=0)
        if longest > 2 * n:
            n = longest
            continue
        heapq.heapify(runs)
        while runs:
            length, p, i = heapq.heappop(runs)
            span = -length + size - 1
            marked = doc_taken[p : p + span] | item_taken[i : i + span]
            if not marked.any():
                doc_taken[p : p + span] = item_taken[i : i + span] = True
                found.append((p + base, i, span))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[1], marked.astype(np.int8), [1]])))
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if end - start >= n + size - 1:
                    heapq.heappush(runs, (-(end - start - size + 1), p + start, i + start))
        if n == 1:
            return found
        n = max(1, n // 2)


def _tiled(size: int):
    names = ["doc_id", "item_id", "n_tokens", "covered", "n_tiles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in ("places", "seeds", "item_seeds")]
            covered, n_tiles = [], []
            for row in range(batch.num_rows):
                made = tiles(*[c[row].values.to_numpy(zero_copy_only=False) for c in columns], size)
                covered.append(sum(t[2] for t in made))
                n_tiles.append(len(made))
            kept = [batch.column(n) for n in names[:3]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(covered, pa.int64()), pa.array(n_tiles, pa.int64())], names=names)

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = MIN_TILE,
    coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """``(doc_id, item_id, n_tokens, covered, n_tiles, coverage)`` of every document and item ``(item_id, text)`` that share enough.

    Null and empty texts, and items of fewer than ``size`` tokens, share nothing. Rows without an id are left out. An
    id that repeats is reported once for an item, with the row that covers most; an item id that repeats likewise. An
    empty table on either side gives an empty result. Other columns are not looked at. An id may be a struct.
    """
    read = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long"), tokens(F.col("text")).alias("t"))
    items = written(read.mapInArrow(_item_seeds(size), "item_id long, n_tokens long, seeds array<long>").where(F.size("seeds") > 0), "benchmark-seeds")
    # items that repeat an id are told apart by their seeds
    items = items.select(F.xxhash64("item_id", "seeds").alias("item"), "item_id", "n_tokens", F.col("seeds").alias("item_seeds"))
    bitmap = seed_map(items.select(F.explode("item_seeds").alias("seed")).distinct())

    texts, kind = with_id(docs.where(F.col(doc_id).isNotNull()), doc_id, tokens(F.col(text)).alias("t"))
    found = texts.mapInArrow(_hits(size, bitmap), f"doc_id {kind}, places array<int>, seeds array<long>")
    # rows that share an id are told apart by their seeds, so that items meet their own rows only
    hits = written(found.withColumn("row", F.xxhash64("places", "seeds")), "decontamination-hits")
    hits = hits.groupBy("doc_id", "row").agg(F.max(F.struct("places", "seeds")).alias("hit")).select("doc_id", "row", "hit.*")
    seen = hits.select("doc_id", "row", F.explode(F.array_distinct("seeds")).alias("seed"))
    frequency = seen.groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    places = items.select("item", "n_tokens", F.explode("item_seeds").alias("seed")).join(frequency, "seed")
    spare = F.ceil(F.ceil(F.col("n_tokens") * coverage - 1e-9) / size) - 1
    by_frequency = Window.partitionBy("item").orderBy(F.desc("n"), "seed")
    rare = places.withColumn("rank", F.row_number().over(by_frequency)).where(F.col("rank") > spare).select("seed", "item").distinct()
    pairs = seen.join(rare, "seed").select("doc_id", "row", "item").distinct()
    rows = pairs.join(hits, ["doc_id", "row"]).join(items.distinct(), "item").select("doc_id", "item_id", "n_tokens", "places", "seeds", "item_seeds")
    tiled = rows.mapInArrow(_tiled(size), f"doc_id {kind}, item_id long, n_tokens long, covered long, n_tiles long")
    enough = tiled.withColumn("coverage", F.col("covered") / F.col("n_tokens")).where(F.col("covered") >= F.col("n_tokens") * coverage - 1e-9)
    best = F.max(F.struct("coverage", "covered", "n_tokens", "n_tiles")).alias("best")
    return enough.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.n_tokens", "best.covered", "best.n_tiles", "best.coverage"
    )
