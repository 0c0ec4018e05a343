"""A uniform shuffle of rows into shards of exact size, through a random communication matrix.

Rows lie in blocks. How many rows block i sends to shard j is drawn first, for all i and j, from the multivariate
hypergeometric distribution with the block sizes and the shard sizes as margins: the distribution that a uniform
permutation of all rows would give. Each block is then permuted by itself and cut by its row of the matrix, the rows
are exchanged, and each shard is permuted again. Shard sizes are exact by construction, at most one row apart.

The law is ``rows``: counts, not bytes, are balanced, and equal texts are not kept together, since a group of copies
larger than a shard could not be.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.llm.common import ranked
from filmgrid.session import written

#: blocks of the matrix; the matrix (blocks x shards counts) is all that the driver holds
BLOCKS = 1024
#: rows that are sorted together when the final places are handed out
BUCKET_ROWS = 50_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good items among ``draws`` drawn without replacement, for populations of any size.

    The weights around the mode follow from the ratio of neighbouring probabilities, so no factorials are needed; 12
    standard deviations on either side hold all but 1e-30 of the mass.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = (draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1)) ** 0.5
    reach = int(12 * spread) + 40
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    left = k[:-1]
    steps = np.log(good - left) + np.log(draws - left) - np.log(left + 1) - np.log(bad - draws + left + 1)
    weights = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(weights - weights.max())
    return int(rng.choice(k, p=weights / weights.sum()))


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Counts with the given row sums and column sums, as a uniform permutation of the rows would give them."""
    rng = np.random.default_rng(seed)
    room = list(shard_sizes)
    matrix = np.zeros((len(block_sizes), len(shard_sizes)), dtype=np.int64)
    for i, size in enumerate(block_sizes):
        left, others = size, sum(room)
        for j in range(len(room)):
            others -= room[j]
            matrix[i, j] = hypergeometric(rng, room[j], others, left)
            left -= int(matrix[i, j])
        room = [r - int(m) for r, m in zip(room, matrix[i])]
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def into_shards(df: DataFrame, keys: list[str], shards: int, seed: int = 42, blocks: int = BLOCKS) -> DataFrame:
    """The rows with ``shard`` and ``slot``, the place in the shard, gapless from 0.

    ``keys`` tell rows apart and seed the permutations, so that a recomputed task gives the same places. Rows that
    agree in all keys are interchangeable: each gets a place of its own. Null keys are values like any other. An empty
    frame gives an empty frame. Columns named ``shard`` or ``slot`` are replaced; others keep their values.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = df.sparkSession
    rest = [c for c in df.columns if c.lower() not in ("shard", "slot")]

    def draw(label: str) -> Column:
        return F.xxhash64(F.lit(f"{seed}/{label}"), *[F.isnull(F.col(f"`{k}`")) for k in keys], *[F.col(f"`{k}`") for k in keys])

    # counted, ranked and exchanged from one written copy: what computed the rows runs once and cannot come out otherwise
    placed = written(df.select(*[F.col(f"`{c}`") for c in rest], F.pmod(draw("block"), F.lit(blocks)).cast("int").alias("_block")), "sharding-rows")
    counted = {r["_block"]: r["count"] for r in placed.groupBy("_block").count().collect()}
    sizes = [counted.get(i, 0) for i in range(blocks)]
    rows = sum(sizes)
    cuts = np.cumsum(communication_matrix(sizes, shard_sizes(rows, shards), seed), axis=1)
    matrix = spark.createDataFrame([(i, [int(x) for x in row]) for i, row in enumerate(cuts)], "_block int, _cuts array<long>")

    def bucket(value: Column, buckets: int) -> Column:
        # the top bits of the draw choose the bucket, so the buckets follow the order of the draw
        return F.floor((F.shiftrightunsigned(value, 33) * buckets) / F.lit(2**31)).cast("int")

    first, second = draw("first"), draw("second")
    others = [F.col(f"`{k}`") for k in keys]
    buckets = max(1, -(-rows // (blocks * BUCKET_ROWS)))
    inside = ranked(placed, ["_block"], bucket(first, buckets), [F.shiftrightunsigned(first, 1), first, *others], "_place")
    # the matrix has as many rows as there are blocks, whatever the data
    sent = inside.join(F.broadcast(matrix), "_block").withColumn(
        "shard", F.size(F.filter("_cuts", lambda cut: cut <= F.col("_place"))).cast("int")
    )
    buckets = max(1, -(-rows // (shards * BUCKET_ROWS)))
    kept = written(sent.select(*[F.col(f"`{c}`") for c in rest], "shard"), "sharding-sent")
    return ranked(kept, ["shard"], bucket(second, buckets), [F.shiftrightunsigned(second, 1), first, *others], "slot")
