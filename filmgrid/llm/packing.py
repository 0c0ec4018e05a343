"""Packing of tokenized documents into sequences: a configuration linear program over the histogram of lengths.

Pieces matter by length only, so the program has one row per length, at most as many as a sequence has tokens, however
many documents there are. Its columns are the patterns of lengths that fit into a sequence. Multiplicative weights
solve it: a length's weight falls as its demand is covered, a knapsack by dynamic programming finds the heaviest
pattern, and a share of the demand goes to that pattern. The weights also bound from below how many sequences any
packing needs. The solution is rounded down to whole sequences of real pieces; what remains, a few pieces for each
pattern, is the next program, until nothing is left. The driver holds the histogram and the patterns. Pieces then find
their places by their rank among pieces of equal length, each for itself.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filmgrid.llm.common import ranked
from filmgrid.session import written

CAPACITY = 1024
END_OF_TEXT = 2
#: of the weights method: how near to the bound a solution shall be, how fast a covered length's weight falls, and the passes:
#: the share of a length's demand that one use of a column may cover, and how much more than their length long pieces weigh
EPSILON, RATE, PASSES = 0.001, 0.5, ((1.0, 0.5), (0.5, 0.5), (1.0, 2.0))
#: pieces that are ranked together
BUCKET_ROWS = 50_000


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _fast_tokenizer(path: str) -> tiktoken.Encoding | None:
    """The same vocabulary and merges in a faster library, if the file is plain byte-level BPE; checked by the tests.

    A pair's rank is its place among the merges, as ids are in that order; special tokens are found in texts, as the
    other library does by default.
    """
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not spec.get("normalizer")
    plain = plain and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not model.get("dropout")
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    strict = all(t.get("special") and not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")) for t in spec.get("added_tokens", ()))
    if not plain or not strict:
        return None
    # byte-level files write bytes as printable characters: the printable ones as themselves, the rest from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable}
    shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    ranks = {bytes(shown[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    # Fixed value: the pattern by which byte-level BPE cuts texts into words.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


#: runs that the faster library's pattern search is not asked to take on
_LONG_RUN = re.compile(r"\s{10000}|\S{100000}")


def token_ids(text: str, path: str) -> np.ndarray:
    """Token ids as the tokenizer file gives them, without added special tokens."""
    fast = _fast_tokenizer(path)
    if fast is not None and not _LONG_RUN.search(text):
        return fast.encode_to_numpy(text, allowed_special="all")
    return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all full but the first, which takes what is over."""
    first = n % capacity or min(n, capacity)
    bounds = [(0, first)]
    return bounds + [(start, capacity) for start in range(first, n, capacity)]


def _pieces(path: str, capacity: int, end: int):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(token_ids(text.as_py() or "", path), end).astype("<u4")
                for i, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    for column, value in zip(out, (doc, i, start, length, crc)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

    return run


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_OF_TEXT) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``; null texts are empty and still have the closing id."""
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(_pieces(tokenizer, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long")


def price_pattern(gain: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[Counter, float]:
    """Knapsack by dynamic programming: the heaviest multiset of lengths that fits, and its weight.

    ``gain`` and ``counts`` belong to ``lengths``; no length is taken more often than its count. Counts are split into
    powers of two, so a length costs a few passes over the rooms.
    """
    value, steps = np.zeros(capacity + 1), []
    for length, weight, count in zip(lengths.tolist(), gain.tolist(), counts.tolist()):
        left, together = min(count, capacity // length), 1
        while left > 0:
            n = min(together, left)
            found = value[: capacity + 1 - length * n] + weight * n
            steps.append((length, n, found > value[length * n :]))
            np.maximum(value[length * n :], found, out=value[length * n :])
            left, together = left - n, together * 2
    pattern, room = Counter(), capacity
    for length, n, taken in reversed(steps):
        if room >= length * n and taken[room - length * n]:
            pattern[length] += n
            room -= length * n
    return pattern, float(value[capacity])


class Program(NamedTuple):
    """A fractional solution, how many sequences it uses, and how many any solution must use."""

    used: dict[tuple[tuple[int, int], ...], float]
    value: float
    bound: float


def _covered(demand: np.ndarray, capacity: int, step: float, rate: float, skew: float) -> Program:
    size = np.arange(capacity + 1, dtype=float)
    scale = size * (1 + skew * size / capacity)
    left, whole = demand.astype(float), float((demand * size).sum())
    used: dict[tuple, float] = {}
    bound = whole / capacity
    while len(lengths := np.flatnonzero(left > demand * 1e-12)):
        # how far a length's coverage runs ahead of the coverage of all tokens
        lead = float((left * size).sum()) / whole - left[lengths] / demand[lengths]
        weight = scale[lengths] * np.exp(-rate * lead)
        pattern, heaviest = price_pattern(weight, lengths, np.ceil(left[lengths]).astype(np.int64), capacity)
        if not used:
            # weights over the heaviest pattern's weight are a solution of the dual program
            bound = max(bound, float((weight * demand[lengths]).sum()) / heaviest)
        amount = min(min(max(step * demand[l], 1.0), left[l]) / n for l, n in pattern.items())
        for l, n in pattern.items():
            left[l] = max(0.0, left[l] - amount * n)
        items = tuple(sorted(pattern.items(), reverse=True))
        used[items] = used.get(items, 0.0) + amount
    return Program(used, sum(used.values()), bound)


def fractional_patterns(demand: np.ndarray, capacity: int, epsilon: float = EPSILON, passes: tuple = PASSES) -> Program:
    """Multiplicative weights on the configuration program: how often to use which pattern, in fractions.

    The weight of a length starts a little above the length itself, since long pieces are hard to place, and is
    multiplied by ``exp(-RATE * lead)``, where lead is how far the covered share of its demand runs ahead of the share
    of all tokens. Every column is priced by a knapsack of its own under the weights of the moment, and used until the
    first of its lengths has moved on by a step. The weights also give a bound from the dual program. The passes have
    ever smaller steps, until one is within ``epsilon`` of the bound; the best of them is kept.
    """
    best = None
    for step, skew in passes:
        made = _covered(demand, capacity, step, RATE, skew)
        bound = max(made.bound, best.bound if best else 0.0)
        best = (made if best is None or made.value < best.value else best)._replace(bound=bound)
        if best.value <= (1 + epsilon) * bound:
            break
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ``((length, pieces), ...)`` and how many sequences use each; together they hold every piece once.

    The fractional solution is rounded down, and the pieces left over are a smaller program of the same kind. The first
    pattern of a program takes no length more often than there are pieces, so it is used once at least and the
    programs come to an end; patterns that do not fill a sequence are kept like all others.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    total: Counter = Counter()
    total[((capacity, 1),)] += int(left[capacity])
    left[capacity] = 0
    passes = PASSES
    while left.any():
        made = fractional_patterns(left, capacity, passes=passes)
        passes = PASSES[:1]  # what is left over is small, and few pieces are apart from whole numbers
        for items, amount in sorted(made.used.items(), key=lambda x: (-x[1], x[0])):
            n = min(int(amount + 1e-9), *(int(left[l]) // k for l, k in items))
            if n > 0:
                total[items] += n
                for l, k in items:
                    left[l] -= n * k
    return sorted((p, n) for p, n in total.items() if n)


class _Places:
    """Where the r-th piece of a length goes: arrays as long as the patterns have entries."""

    def __init__(self, patterns: list[tuple[tuple[tuple[int, int], ...], int]]):
        first_sequence = 0
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for items, n in patterns:
            offset = 0
            for length, each in items:
                rows.setdefault(length, []).append((n * each, each, first_sequence, offset))
                offset += length * each
            first_sequence += n
        self.by_length = {}
        for length, entries in rows.items():
            counts, each, base, offset = (np.array(x, dtype=np.int64) for x in zip(*entries))
            self.by_length[length] = (np.cumsum(counts) - counts, each, base, offset)

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, each, base, offset = self.by_length[length]
        at = np.searchsorted(start, rank, "right") - 1
        inside = rank - start[at]
        return base[at] + inside // each[at], offset[at] + inside % each[at] * length


def _placed(places: _Places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for l in np.unique(length).tolist():
                own = length == l
                sequence[own], offset[own] = places.place(l, rank[own])
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    return run


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_OF_TEXT) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, a row per piece of every row of ``docs``.

    Texts longer than ``capacity`` tokens (closing id included) are cut into full pieces, of which the first may be
    shorter. Null and empty texts are a piece of one id. Rows that repeat, and rows without an id, are packed like any
    others, each with a place of its own. An empty table gives an empty result. Other columns are not looked at.
    """
    cut = written(pieces(docs, tokenizer, doc_id, text, capacity, end), "packing-pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    places = _Places(plan(histogram, capacity))
    buckets = max(1, -(-sum(histogram.values()) // BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    numbered = ranked(cut, ["length"], bucket, [F.col("doc_id"), F.col("piece")], "rank")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(_placed(places), schema)
