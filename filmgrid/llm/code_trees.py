"""Vector codes: product codebooks refined over metric trees that are built once.

Every vector is cut into equal parts. The parts at one position, a block of vectors at a time, go into a metric tree
made middle-out: anchors are picked and steal the points that are nearer to them, their balls are merged upwards into
one and divided downwards in the same way. A ball caches the sum and the count of its points. A round walks every tree
with the list of codebook entries that may still be nearest; a child inherits its parent's list, and entries that are
beaten everywhere in the ball by another one go. A ball with one entry left is wholly owned and adds its cached sum and
count without a look at its points; only leaves with several entries left compare points. All numbers are integers, so
the sums do not depend on the order in which tasks add them, and a round's codebook is exact.

The trees are written once to the shared folder and read in every round. What reaches the driver is one sum a codebook
entry and part. The result of a round does not depend on how vectors fall into blocks.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.session import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: vectors in a block, whose parts make a tree each
BLOCK = 2048
#: a ball with so many points is not divided further
LEAF = 32
#: scaled components are cut off here, so that squared distances fit into a long in up to 16,384 dimensions a part
LARGEST = 1 << 23


@dataclass
class Ball:
    """Points ``start`` to ``end`` of the tree's order; ``left`` and ``right`` are nodes, -1 for a leaf."""

    points: np.ndarray
    left: Ball | None = None
    right: Ball | None = None


def _anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Points by the anchor that owns them, at most ``wanted`` groups, as indexes.

    Each owner keeps its points by falling distance. A new anchor is the point farthest from its owner; it can only
    steal points that are at least half as far from their owner as the two anchors are from each other.
    """

    def distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.sqrt(((points[rows] - to) ** 2).sum(axis=1))

    everything = np.arange(len(points))
    far = distances(everything, points[0])
    order = np.argsort(-far, kind="stable")
    pivots, owned, reach = [points[0]], [order], [far[order]]
    while len(pivots) < wanted:
        widest = max(range(len(pivots)), key=lambda i: reach[i][0])
        if reach[widest][0] == 0:
            break
        pivot = points[owned[widest][0]]
        gained, gained_reach = [], []
        for i, other in enumerate(pivots):
            half = math.sqrt(((other - pivot) ** 2).sum()) / 2
            looked = int(np.searchsorted(-reach[i], -half, side="right"))
            if not looked:
                continue
            closer = distances(owned[i][:looked], pivot)
            taken = closer < reach[i][:looked]
            if taken.any():
                stays = np.concatenate([~taken, np.ones(len(owned[i]) - looked, dtype=bool)])
                gained.append(owned[i][:looked][taken])
                gained_reach.append(closer[taken])
                owned[i], reach[i] = owned[i][stays], reach[i][stays]
        rows, far = np.concatenate(gained), np.concatenate(gained_reach)
        order = np.argsort(-far, kind="stable")
        pivots.append(pivot)
        owned.append(rows[order])
        reach.append(far[order])
    return owned


def _merged(balls: list[Ball], points: np.ndarray) -> Ball:
    """One ball over all, by merging again and again the two whose common ball is smallest."""
    centers = np.array([points[b.points].mean(axis=0) for b in balls])
    radii = np.array([math.sqrt(((points[b.points] - c) ** 2).sum(axis=1).max()) for b, c in zip(balls, centers)])
    apart = np.sqrt(((centers[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2))
    cost = (apart + radii[:, None] + radii[None, :]) / 2
    np.fill_diagonal(cost, np.inf)
    left = list(balls)
    for _ in range(len(balls) - 1):
        i, j = divmod(int(np.argmin(cost)), len(left))
        joined = Ball(np.concatenate([left[i].points, left[j].points]), left[i], left[j])
        left[i] = joined
        centers[i] = points[joined.points].mean(axis=0)
        radii[i] = math.sqrt(((points[joined.points] - centers[i]) ** 2).sum(axis=1).max())
        cost[j, :] = cost[:, j] = radii[j] = np.inf
        row = (np.sqrt(((centers - centers[i]) ** 2).sum(axis=1)) + radii + radii[i]) / 2
        row[np.isinf(radii)] = np.inf
        row[i] = np.inf
        cost[i, :] = cost[:, i] = row
    return left[i] if len(balls) > 1 else balls[0]


def _grown(points: np.ndarray, rows: np.ndarray) -> Ball:
    if len(rows) <= LEAF:
        return Ball(rows)
    groups = _anchors(points[rows], math.isqrt(len(rows) - 1) + 1)
    if len(groups) == 1:  # all points are equal
        return Ball(rows)
    return _merged([_grown(points, rows[group]) for group in groups], points)


def plant(points: np.ndarray) -> dict[str, np.ndarray]:
    """The tree over the integer ``points`` as arrays; parents come before their children, a ball's points are adjacent."""
    top = _grown(points.astype(np.float64), np.arange(len(points)))
    order: list[np.ndarray] = []
    nodes: list[list[int]] = []  # left, right, start, end
    open_balls = [(top, -1, 0)]
    placed = 0
    while open_balls:
        ball, parent, side = open_balls.pop()
        number = len(nodes)
        if parent >= 0:
            nodes[parent][side] = number
        nodes.append([-1, -1, placed, placed + len(ball.points)])
        if ball.left is None:
            order.append(ball.points)
            placed += len(ball.points)
        else:
            open_balls += [(ball.right, number, 1), (ball.left, number, 0)]
    rows = np.concatenate(order)
    table = np.array(nodes, dtype=np.int64)
    laid = points[rows].astype(np.int64)
    sums = np.array([laid[s:e].sum(axis=0) for s, e in table[:, 2:]])
    centers = sums / (table[:, 3] - table[:, 2])[:, None]
    radii = np.array([math.sqrt(((laid[s:e] - c) ** 2).sum(axis=1).max()) for (s, e), c in zip(table[:, 2:], centers)])
    return {"points": laid.astype(np.int32), "rows": rows.astype(np.int32), "nodes": table.astype(np.int32), "sums": sums, "centers": centers, "radii": radii}


class Codebook:
    """Entries of one part position, with what every tree needs of them: distinct ones, lengths and mutual distances."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        # of equal entries only the first can be chosen
        _, first = np.unique(entries, axis=0, return_index=True)
        self.index = np.sort(first)
        self.distinct = entries[self.index].astype(np.int64)
        self.lengths = (self.distinct**2).sum(axis=1)
        floats = self.distinct.astype(np.float64)
        square = self.lengths[:, None] + self.lengths[None, :] - 2 * (floats @ floats.T)
        self.apart = np.sqrt(np.maximum(square, 0))


def _nearest(points: np.ndarray, book: Codebook, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position in ``left`` of the nearest entry, and the squared distance; the first of equally near ones."""
    entries = book.distinct[left]
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    # sums of products below 2^53 are exact as doubles, too, and multiply faster
    exact = float(largest) ** 2 * points.shape[1] * 4 < 2**53
    products = (points.astype(np.float64) @ entries.T.astype(np.float64)) if exact else points @ entries.T
    squares = (points**2).sum(axis=1)[:, None] - 2 * products.astype(np.int64) + book.lengths[left][None, :]
    best = squares.argmin(axis=1)
    return best, squares[np.arange(len(points)), best]


def owners(tree: dict[str, np.ndarray], book: Codebook) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """``(node, entry, ...)`` of every ball that one entry owns, and ``(node, -1, ..)`` with entries left for open leaves.

    Yields ``(node, entry, count, entries)``; ``entries`` is None for an owned ball.
    """
    nodes, centers, radii = tree["nodes"], tree["centers"], tree["radii"]
    reach = (centers**2).sum(axis=1)[:, None] - 2 * (centers @ book.distinct.T) + book.lengths[None, :]
    # rounding never drops an entry: what might be lost in the last digits is added to the ball
    slack = 1e-11 * (1 + np.abs(reach).max())
    inherited = [(0, np.arange(len(book.distinct)))]
    while inherited:
        node, entries = inherited.pop()
        left, right, start, end = nodes[node]
        there = reach[node, entries]
        best = entries[int(there.argmin())]
        # beaten in the whole ball: even the point of the ball that lies farthest towards the entry is nearer to the best
        stays = there - reach[node, best] <= 2 * radii[node] * book.apart[best, entries] * (1 + 1e-9) + slack
        entries = entries[stays]
        if len(entries) == 1:
            yield node, int(entries[0]), int(end - start), None
        elif left < 0:
            yield node, -1, int(end - start), entries
        else:
            inherited += [(int(left), entries), (int(right), entries)]


def _sums_of(tree: dict[str, np.ndarray], book: Codebook, sums: np.ndarray, counts: np.ndarray) -> None:
    """Adds the tree's points to their entries."""
    for node, entry, count, entries in owners(tree, book):
        if entries is None:
            sums[book.index[entry]] += tree["sums"][node]
            counts[book.index[entry]] += count
            continue
        points = tree["points"][slice(*tree["nodes"][node, 2:])].astype(np.int64)
        chosen = book.index[entries[_nearest(points, book, entries)[0]]]
        np.add.at(sums, chosen, points)
        np.add.at(counts, chosen, 1)


def _codes_of(tree: dict[str, np.ndarray], book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every row of the block."""
    codes, squares = np.empty(len(tree["rows"]), dtype=np.int64), np.empty(len(tree["rows"]), dtype=np.int64)
    for node, entry, _, entries in owners(tree, book):
        span = slice(*tree["nodes"][node, 2:])
        left = np.array([entry]) if entries is None else entries
        chosen, found = _nearest(tree["points"][span].astype(np.int64), book, left)
        codes[tree["rows"][span]], squares[tree["rows"][span]] = book.index[left[chosen]], found
    return codes, squares


def _packed(tree: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **tree)
    return out.getvalue()


def _unpacked(data: pa.Scalar) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data.as_buffer()), allow_pickle=False) as found:
        return {name: found[name] for name in found.files}


def _blocks(width: int, parts: int, block: int):
    def made(ids: pa.Array, labels: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
        trees = [_packed(plant(part)) for part in np.split(vectors, parts, axis=1)]
        lists = [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([labels.to_pylist()], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.binary()))], names=["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            n += batch.num_rows
            while n >= block:
                rows = pa.concat_tables(held).combine_chunks()
                yield take(rows.slice(0, block))
                held, n = [rows.slice(block)], n - block
        if n:
            yield take(pa.concat_tables(held).combine_chunks())

    def take(rows: pa.Table) -> pa.RecordBatch:
        ids, labels, vectors = (rows.column(c).combine_chunks() for c in ("id", "label", "v"))
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), width)
        return made(ids, labels, flat)

    return run


def _partial_sums(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(book) for book in books]
        sums, counts = [np.zeros_like(book) for book in books], [np.zeros(len(book), dtype=np.int64) for book in books]
        for batch in batches:
            for trees in batch.column("trees"):
                for part, tree in enumerate(trees):
                    _sums_of(_unpacked(tree), known[part], sums[part], counts[part])
        for part, count in enumerate(counts):
            used = np.flatnonzero(count)
            columns = [np.full(len(used), part), used, count[used]]
            arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(sums[part][used].tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "n", "sums"])

    return run


def _assigned(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(book) for book in books]
        for batch in batches:
            for ids, labels, trees in zip(*[batch.column(c) for c in ("ids", "labels", "trees")]):
                found = [_codes_of(_unpacked(tree), known[part]) for part, tree in enumerate(trees)]
                codes = np.stack([codes for codes, _ in found], axis=1).tolist()
                error = sum(squares for _, squares in found)
                arrays = [ids.values, labels.values, pa.array(["".join(f"{c:02x}" for c in row) for row in codes]), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "code", "error"])

    return run


def scaled(vector: Column, factor: int, largest: int) -> Column:
    """Every component as ``floor(factor * x)``, cut off at ``largest``."""
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * factor, F.lit(float(largest))), F.lit(float(-largest))))
    return F.transform(vector, lambda x: whole(x).cast("int"))


def usable(vector: Column) -> Column:
    """True if the vector is there and all its components are finite numbers."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def of_width(vector: Column, width: int) -> Column:
    """The array filled up with zeros to ``width``."""
    return F.concat(vector, F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size(vector), F.lit(0))))


def compress(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    block: int = BLOCK,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(vec_id, label, code, error)`` of every usable row, and the final codebook of each part.

    Rows whose vector is null or holds a null or a component that is not finite are dropped; rows that repeat are all
    kept and count each time; an id may be null, and such rows come last where ids are compared. Codebooks start as the
    rows of the smallest ids (ties: the smaller vector), so with fewer rows than ``entries`` they are as short as that.
    Vectors that are shorter than the longest, or whose length ``parts`` does not divide, are filled up with zeros.
    Scaled components beyond ``LARGEST`` are cut off there. At most 256 entries, as a code has two hex digits a part. An
    empty table gives no rows and empty codebooks. Labels are compared as text; other columns are not looked at.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part, so a codebook has 256 entries at most")
    read = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    kept = read.where(usable(F.col("v"))).withColumn("v", scaled(F.col("v"), SCALE, LARGEST))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    width = parts * -(-(longest or 1) // parts)
    filled = kept.withColumn("v", of_width(F.col("v"), width))
    made = filled.mapInArrow(_blocks(width, parts, block), "ids array<long>, labels array<string>, trees array<binary>")
    trees = written(made, "code-trees")
    first = filled.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), width)
    books = [np.ascontiguousarray(part) for part in np.split(start, parts, axis=1)]
    places = width // parts
    for _ in range(rounds if first else 0):
        partial = trees.select("trees").mapInArrow(_partial_sums(books), "part long, entry long, n long, sums array<long>")
        total = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(places)]
        for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():
            books[row["part"]][row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(places)]
    coded = trees.mapInArrow(_assigned(books), "id long, label string, code string, error long")
    return coded.withColumnRenamed("id", "vec_id"), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Digest of all entries' components, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book.tolist() for x in entry).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over the rows of the same label; rows without one belong together."""
    kept = written(coded, "codes")
    sums = kept.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "same")
    return kept.join(sums, F.col("label").eqNullSafe(F.col("same"))).drop("same")
