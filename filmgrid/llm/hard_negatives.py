"""Hard negatives: inner-product search in score windows over STR-packed R-trees.

Rows are sorted into tiles: Spark's range partitions by label and widest coordinate are the outer slabs; inside, slabs by
the second and runs by the third widest coordinate make leaves (sort-tile-recursive packing). A leaf keeps its rows and
their minimum bounding box, a tree the leaves of a few thousand rows of one label. For an anchor, each coordinate of a
box gives an interval of its product; their sum bounds the scores of all rows in the box. The best-first queue takes the
box with the highest bound that any waiting anchor has; for an anchor, a box is passed over if its interval lies outside
the anchor's score windows or strictly below the score that is k-th so far.

All anchors meet all trees in blocks: (chunk of anchors, slice of trees). Both are of bounded size, and a group's
results are at most k rows an anchor and window, so labels and chunks may be as large as they like.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmgrid.llm.code_trees import of_width, scaled, usable
from filmgrid.session import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: a negative's score in hundredths of the positive's
LOW, HIGH = 50, 95
#: rows of a tree and of a leaf
TREE_ROWS, LEAF_ROWS = 4096, 128
#: rows whose trees one task holds at a time, anchors that meet them there, and those of them that wait at one queue
SLICE_ROWS, CHUNK, BATCH = 65_536, 16_384, 1024
#: scaled components are cut off here, so that scores are exact as doubles in up to 131,072 dimensions
LARGEST = 1 << 18
#: stands for a missing id where ids are compared
NO_ID = np.iinfo(np.int64).max

_TREE = "label long, keys binary, ids binary, vectors binary, ends binary, low binary, high binary"


def _runs(n: int, size: int) -> Iterator[tuple[int, int]]:
    return ((i, min(n, i + size)) for i in range(0, n, size))


def pack(vectors: np.ndarray, axes: list[int], leaf: int = LEAF_ROWS) -> tuple[np.ndarray, list[int]]:
    """Order of the rows and ends of the leaves: slabs by the first axis, cut into runs by the next, and so on."""

    def tiled(rows: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
        leaves = -(-len(rows) // leaf)
        if len(axes) == 1 or leaves == 1:
            return [rows[s:e] for s, e in _runs(len(rows), leaf)]
        slabs = math.ceil(leaves ** (1 / len(axes)))
        size = leaf * -(-leaves // slabs)
        return [tile for s, e in _runs(len(rows), size) for tile in tiled(rows[s:e], axes[1:])]

    tiles = tiled(np.arange(len(vectors)), axes)
    return np.concatenate(tiles), np.cumsum([len(t) for t in tiles]).tolist()


def _trees(width: int, axes: list[int], tree_rows: int):
    def made(label: int, rows: pa.Table) -> pa.RecordBatch:
        vectors = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int32)
        order, ends = pack(vectors, axes)
        vectors = vectors[order]
        edges = list(zip([0, *ends[:-1]], ends))
        low = np.array([vectors[s:e].min(axis=0) for s, e in edges])
        high = np.array([vectors[s:e].max(axis=0) for s, e in edges])
        keys = rows.column("key").combine_chunks().to_numpy()[order]
        ids = rows.column("vec_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)[order]
        packed = [keys, ids, vectors, np.array(ends, dtype=np.int64), low, high]
        arrays = [pa.array([label], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in packed]]
        return pa.RecordBatch.from_arrays(arrays, names=["label", "keys", "ids", "vectors", "ends", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, n = [], None, 0
        for batch in batches:
            labels = batch.column("label").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
            for start, end in zip(cuts, cuts[1:]):
                while start < end:
                    if n and (labels[start] != now or n == tree_rows):
                        yield made(now, pa.concat_tables(held))
                        held, n = [], 0
                    now = int(labels[start])
                    taken = min(end - start, tree_rows - n)
                    held.append(pa.Table.from_batches([batch.slice(start, taken)]))
                    start, n = start + taken, n + taken
        if n:
            yield made(now, pa.concat_tables(held))

    return run


class _Forest:
    """The leaves of several trees."""

    def __init__(self, trees: pa.Table, width: int):
        read = lambda name, kind: [np.frombuffer(x.as_py(), dtype=kind) for x in trees.column(name)]
        keys, ids, vectors, ends = read("keys", np.int64), read("ids", np.int64), read("vectors", np.int32), read("ends", np.int64)
        self.low = np.concatenate(read("low", np.int32)).reshape(-1, width).astype(np.float64)
        self.high = np.concatenate(read("high", np.int32)).reshape(-1, width).astype(np.float64)
        self.leaves, labels = [], []
        for k, i, v, e, label in zip(keys, ids, vectors, ends, trees.column("label").to_pylist()):
            v = v.reshape(-1, width)
            for start, end in zip([0, *e[:-1]], e):
                self.leaves.append((k[start:end], i[start:end], v[start:end]))
                labels.append(label)
        self.labels = np.array(labels, dtype=np.int64)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible score of every anchor in every box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


class _Best:
    """The ``k`` first rows of each (anchor, window): higher score, then smaller id, then smaller key."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.kept = np.zeros((*low.shape, k, 3), dtype=np.int64)
        self.n = np.zeros(low.shape, dtype=np.int64)
        self.floor = low.copy()

    def add(self, anchor: np.ndarray, window: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        windows = self.low.shape[1]
        group = anchor * windows + window
        touched = np.unique(group)
        old_group = np.repeat(touched, self.n.reshape(-1)[touched])
        old = np.concatenate([self.kept.reshape(-1, self.k, 3)[g, : self.n.reshape(-1)[g]] for g in touched])
        group = np.concatenate([old_group, group])
        rows = np.concatenate([old, np.stack([score, ids, keys], axis=1)])
        order = np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0], group))
        group, rows = group[order], rows[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        rank = np.arange(len(group)) - np.repeat(starts, np.diff([*starts, len(group)]))
        first = rank < self.k
        group, rank, rows = group[first], rank[first], rows[first]
        self.kept.reshape(-1, self.k, 3)[group, rank] = rows
        np.maximum.at(self.n.reshape(-1), group, rank + 1)
        full = touched[self.n.reshape(-1)[touched] == self.k]
        flat = self.floor.reshape(-1)
        flat[full] = np.maximum(self.low.reshape(-1)[full], self.kept.reshape(-1, self.k, 3)[full, -1, 0])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, window, and (score, id, key) of all that is kept."""
        anchor, window, place = np.nonzero(np.arange(self.k)[None, None, :] < self.n[:, :, None])
        return anchor, window, self.kept[anchor, window, place]


def search(forest: _Forest, keys: np.ndarray, vectors: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[_Best, int]:
    """The first ``k`` rows with a score from ``low`` to ``high`` for each anchor and window, and how many scores it took.

    ``allowed`` says which anchors may look into which box; a row is never a match for itself.
    """
    anchors = vectors.astype(np.float64)
    least, most = forest.intervals(anchors)
    best, scored = _Best(low, high, k), 0
    waiting = [(-bound, box) for box, bound in enumerate(np.where(allowed, most, -np.inf).max(axis=0, initial=-np.inf)) if bound > -np.inf]
    heapq.heapify(waiting)
    while waiting:
        _, box = heapq.heappop(waiting)
        in_window = (least[:, box, None] <= high) & (most[:, box, None] >= best.floor)
        asks = np.flatnonzero(in_window.any(axis=1) & allowed[:, box])
        if not len(asks):
            continue
        box_keys, box_ids, box_rows = forest.leaves[box]
        scores = (anchors[asks] @ box_rows.T.astype(np.float64)).astype(np.int64)
        scored += scores.size
        for window in range(low.shape[1]):
            hit = (scores >= best.floor[asks, window, None]) & (scores <= high[asks, window, None])
            a, r = np.nonzero(hit)
            other = box_keys[r] != keys[asks[a]]
            a, r = a[other], r[other]
            if len(a):
                best.add(asks[a], np.full(len(a), window), scores[a, r], box_ids[r], box_keys[r])
    return best, scored


def _searched(width: int, k: int, same: bool):
    """Group function: a chunk of anchors with their windows against a slice of trees."""

    def run(anchors: pa.Table, trees: pa.Table) -> pa.Table:
        names, found = ["anchor", "window", "score", "id", "key"], []
        if anchors.num_rows and trees.num_rows:
            forest = _Forest(trees, width)
            for start, end in _runs(anchors.num_rows, BATCH):
                part = anchors.slice(start, end - start)
                keys, labels = part.column("key").to_numpy(), part.column("label").to_numpy()
                vectors = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                low, high = [np.array(part.column(c).to_pylist(), dtype=np.int64) for c in ("low", "high")]
                equal = labels[:, None] == forest.labels[None, :]
                best, _ = search(forest, keys, vectors, equal if same else ~equal, low, high, k)
                anchor, window, rows = best.rows()
                found.append(np.column_stack([keys[anchor], window, rows]))
        rows = np.concatenate(found) if found else np.zeros((0, 5), dtype=np.int64)
        return pa.table([pa.array(rows[:, i], pa.int64()) for i in range(5)], names=names)

    return run


def _met(anchors: DataFrame, trees: DataFrame, keys: list[str], width: int, k: int, same: bool) -> DataFrame:
    """The first ``k`` rows ``(anchor, window, score, id, key)`` over all groups of anchors and trees."""
    met = anchors.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(_searched(width, k, same), "anchor long, window long, score long, id long, key long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "key")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: str,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    tree_rows: int = TREE_ROWS,
    slice_rows: int = SLICE_ROWS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``, ranks from 1 for each anchor and positive.

    ``anchors`` is a condition on the rows, in SQL. Scores are integer inner products of ``floor(SCALE * x)``; higher ones
    come first, ties by smaller id. An anchor's positives are its first other rows of the same label, their negatives the
    first rows of other labels that score from ``low`` to ``high`` hundredths of the positive's score. Rows with a null
    label, a null vector, or a component that is null or not finite take no part. Rows that repeat an id are rows of their
    own, also as anchors; a null id is no anchor unless the condition says so, and comes last among ties. Shorter vectors
    count as filled up with zeros, scaled components beyond ``LARGEST`` as that. A positive without negatives, and an empty
    table, give no rows. Other columns are not looked at.
    """
    read = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    numbered = read.where(usable(F.col("v")) & F.col("label").isNotNull()).withColumn("key", F.monotonically_increasing_id())
    kept = written(numbered.withColumn("v", scaled(F.col("v"), SCALE, LARGEST)), "negatives-rows")
    size = kept.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    width = max(1, size["width"] or 1)
    filled = kept.withColumn("v", of_width(F.col("v"), width))
    spread = filled.agg(*[F.var_pop(F.get("v", F.lit(i)).cast("double")).alias(f"c{i}") for i in range(width)]).first()
    axes = sorted(range(width), key=lambda i: -(spread[i] or 0.0))[:3]
    slabs = max(1, -(-size["n"] // tree_rows))
    sort = ["label", F.get("v", F.lit(axes[0])), "key"]
    tiles = filled.repartitionByRange(slabs, *sort).sortWithinPartitions(*sort).select("key", "vec_id", "label", "v")
    # the first axis made the slabs; inside, the other two make the leaves
    trees = written(tiles.mapInArrow(_trees(width, axes[1:] or axes, tree_rows), _TREE), "negatives-trees")
    trees = trees.withColumn("tree", F.xxhash64("keys"))
    asking = written(filled.where(F.expr(anchors)), "negatives-anchors")

    # a label's anchors meet the label's trees
    per_label = asking.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"))
    tree_n = F.octet_length("keys") / 8
    slices = trees.groupBy("label").agg(F.ceil(F.sum(tree_n) / slice_rows).alias("slices"))
    dealt = written(per_label.join(slices, "label"), "negatives-labels")
    all_scores = lambda bound: F.array(F.lit(bound)).cast("array<long>")
    own = asking.join(dealt, "label").select(
        "label", F.pmod(F.xxhash64("key"), "chunks").alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
        "key", "v", all_scores(-(1 << 62)).alias("low"), all_scores(1 << 62).alias("high"),
    )
    own_trees = trees.join(dealt, "label").select(
        *trees.columns, F.pmod("tree", "slices").alias("slice"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    )
    found = _met(own, own_trees, ["label", "chunk", "slice"], width, positives, same=True)
    liked = written(found.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive"), "score"), "negatives-positives")

    # every anchor that has positives meets all trees; the group function passes over boxes of its own label
    scores = liked.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("scores"))
    filled_up = lambda c: F.concat(c, F.array_repeat(F.lit(None).cast("long"), F.lit(positives) - F.size(c)))
    # no window where there is no positive: its low end lies above its high end
    lower = lambda s: F.coalesce(F.ceil(s * low / F.lit(100)).cast("long"), F.lit(1).cast("long"))
    upper = lambda s: F.coalesce(F.floor(s * high / F.lit(100)).cast("long"), F.lit(0).cast("long"))
    windows = scores.select("anchor", F.transform(filled_up(F.col("scores")), lower).alias("low"), F.transform(filled_up(F.col("scores")), upper).alias("high"))
    n_anchors = windows.count()
    chunks, n_slices = max(1, -(-n_anchors // chunk)), max(1, -(-size["n"] // slice_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = asking.join(windows, asking["key"] == windows["anchor"]).select(
        F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int").alias("chunk"), every(n_slices).alias("slice"), "key", "label", "v", "low", "high"
    )
    all_trees = trees.select(*trees.columns, F.pmod("tree", F.lit(n_slices)).cast("int").alias("slice"), every(chunks).alias("chunk"))
    hard = _met(asked, all_trees, ["chunk", "slice"], width, negatives, same=False)
    hard = hard.select("anchor", (F.col("window") + 1).alias("place"), "rank", F.col("id").alias("negative"), F.col("score").alias("negative_score"))
    real = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c))
    named = asking.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return hard.join(liked, ["anchor", "place"]).join(named, "anchor").select(
        "anchor_id", real("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), real("negative").alias("negative_id"),
        F.col("score").alias("positive_score"), "negative_score",
    )
