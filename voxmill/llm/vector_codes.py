"""Product codes of vectors by Lloyd's rounds on two trees.

Components become whole numbers, vectors are cut into equal parts, and each part position has a codebook that is
improved in rounds: every part is assigned to the nearest entry, every entry becomes the (floored) mean of its parts.

A block of some thousand vectors keeps, for each part position, a tree over its parts: halved along the widest side, with each
node's box and the cached sum of its parts. In a round a second tree is laid over the entries, and pairs of nodes go
down both trees together. Of a pair, the boxes bound all distances from below and above. Entries whose lower bound is
above the smallest upper bound of a node are out. When one entry is left for a node, the whole node is assigned by its cached sum. Leaves
that stay uncertain compute distances to the entries left, in whole numbers. All bounds are whole numbers too, so ties stay ties and
go to the lower index.

Blocks with their trees are written once; a round is a scan of them and a sum of counts and sums per entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import exactly, written

SCALE = 1024
BLOCK, LEAF = 4096, 32
#: Components from 2^24 on (in whole numbers) would not leave room for sums of squares in 64 bits.
LARGEST = 2**24
#: Labels that hold at least this share of the rows are joined by a broadcast (so there are at most as many).
FREQUENT = 2000


@dataclass
class Tree:
    """Halves of an ordered list of points. Node i of level d covers i * n >> d up to (i + 1) * n >> d."""

    points: np.ndarray  # in the order of the tree
    order: np.ndarray  # their places before
    low: list[np.ndarray]  # per level: boxes of the nodes
    high: list[np.ndarray]
    total: list[np.ndarray]  # and sums of their points

    def edges(self, level: int) -> np.ndarray:
        return np.arange((1 << level) + 1) * len(self.points) >> level


def levels(n: int, leaf: int) -> int:
    return max(0, -(-n // leaf) - 1).bit_length()


def grow(points: np.ndarray, leaf: int) -> Tree:
    """Tree over whole-number ``points``, with leaves of at most ``leaf``; halves may be empty when there are few."""
    n, order = len(points), np.arange(len(points))
    depth = levels(n, leaf)
    for level in range(depth):
        edges = np.arange((2 << level) + 1) * n >> (level + 1)
        for i in range(0, 2 << level, 2):
            a, middle, b = edges[i : i + 3].tolist()
            if b - a > 1:
                some = points[order[a:b]]
                side = int((some.max(axis=0) - some.min(axis=0)).argmax())
                order[a:b] = order[a:b][np.argsort(some[:, side], kind="stable")]
    sorted_points = points[order]
    low, high, total = [], [], []
    for level in range(depth + 1):
        edges = np.arange((1 << level) + 1) * n >> level
        filled = np.flatnonzero(edges[1:] > edges[:-1])
        shape = (1 << level, points.shape[1])
        # The box of an empty node is as far as can be from everything; nothing is assigned to it.
        box = np.full(shape, 4 * LARGEST, np.int64), np.full(shape, 4 * LARGEST, np.int64), np.zeros(shape, np.int64)
        for table, f in zip(box, (np.minimum, np.maximum, np.add), strict=True):
            if len(filled):
                table[filled] = f.reduceat(sorted_points, edges[filled], axis=0)
        low.append(box[0])
        high.append(box[1])
        total.append(box[2])
    return Tree(sorted_points, order, low, high, total)


def pack(tree: Tree) -> list[bytes]:
    return [tree.points.astype("<i4").tobytes(), tree.order.astype("<i4").tobytes(), *(np.concatenate(t).astype("<i8").tobytes() for t in (tree.low, tree.high, tree.total))]


def unpack(stored: list[bytes], n: int) -> Tree:
    order = np.frombuffer(stored[1], "<i4")
    points = np.frombuffer(stored[0], "<i4").reshape(n, -1).astype(np.int64)
    cuts = np.cumsum([1 << d for d in range(levels(n, LEAF) + 1)])[:-1]
    boxes = (np.split(np.frombuffer(s, "<i8").reshape(-1, points.shape[1]), cuts) for s in stored[2:])
    return Tree(points, order, *boxes)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number points, exact: in doubles where all sums fit in 53 bits."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    kind = np.float64 if 4 * most * most * a.shape[1] < 2**53 else np.int64
    a, b = a.astype(kind), b.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)


def bounds(data: Tree, q_level: int, q: np.ndarray, book: Tree, r_level: int, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest squared distance between the boxes of pairs of nodes."""
    ql, qh, rl, rh = data.low[q_level][q], data.high[q_level][q], book.low[r_level][r], book.high[r_level][r]
    gap = np.maximum(0, np.maximum(rl - qh, ql - rh))
    span = np.maximum(qh - rl, rh - ql)
    return (gap * gap).sum(axis=1), (span * span).sum(axis=1)


def assign(data: Tree, book: Tree) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Nearest entry of all points: whole nodes (level, nodes, entries), and the points of uncertain leaves with theirs.

    ``book``: a tree with one entry per leaf. Points are numbered in the order of ``data``, entries as they were given.
    """
    q_last, r_last = len(data.low) - 1, len(book.low) - 1
    r_edges = book.edges(r_last)
    whole = []
    q, r, q_level, r_level = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while True:
        low, high = bounds(data, q_level, q, book, r_level, r)
        upper = np.full(1 << q_level, np.iinfo(np.int64).max)
        np.minimum.at(upper, q, high)
        kept = low <= upper[q]
        if r_level == r_last:
            kept &= r_edges[r + 1] > r_edges[r]
        q, r = q[kept], r[kept]
        if r_level == r_last:
            single = np.bincount(q, minlength=1 << q_level)[q] == 1
            whole.append((q_level, q[single], book.order[r_edges[r[single]]]))
            q, r = q[~single], r[~single]
            if q_level == q_last or not len(q):
                break
        # Down in both trees, or in the one that is left.
        if q_level < q_last:
            q, r, q_level = np.concatenate((2 * q, 2 * q + 1)), np.concatenate((r, r)), q_level + 1
        if r_level < r_last:
            q, r, r_level = np.concatenate((q, q)), np.concatenate((2 * r, 2 * r + 1)), r_level + 1
    points, entries = [], []
    edges = data.edges(q_last)
    order = np.lexsort((book.order[r_edges[r]] if len(r) else r, q))
    q, r = q[order], r[order]
    first = np.flatnonzero(np.diff(q, prepend=-1))
    for node, begin, end in zip(q[first].tolist(), first.tolist(), np.append(first, len(q))[1:].tolist(), strict=True):
        places = r_edges[r[begin:end]]  # in the order of entries, so that the first of equal distances is the lowest
        a, b = edges[node], edges[node + 1]
        nearest = distances(data.points[a:b], book.points[places]).argmin(axis=1)
        points.append(np.arange(a, b))
        entries.append(book.order[places[nearest]])
    return whole, *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (points, entries))


def owners(data: Tree, book: Tree) -> np.ndarray:
    """Nearest entry of each point of ``data``, in its order."""
    whole, points, entries = assign(data, book)
    out = np.zeros(len(data.points), np.int64)
    for level, nodes, entry in whole:
        edges = data.edges(level)
        for a, b, e in zip(edges[nodes].tolist(), edges[nodes + 1].tolist(), entry.tolist(), strict=True):
            out[a:b] = e
    out[points] = entries
    return out


def sums(data: Tree, book: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: how many points are nearest to it, and their sum."""
    k, width = book.points.shape
    count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
    whole, points, entries = assign(data, book)
    for level, nodes, entry in whole:
        edges = data.edges(level)
        np.add.at(count, entry, edges[nodes + 1] - edges[nodes])
        np.add.at(total, entry, data.total[level][nodes])
    np.add.at(count, entries, 1)
    np.add.at(total, entries, data.points[points])
    return count, total


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _blocks(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """n, ids, labels and per part the tree: blocks of up to BLOCK vectors of a partition."""
    label = kept.schema["label"].dataType
    kinds = {"ids": pa.list_(pa.int64()), "labels": pa.list_(to_arrow_type(label)), "trees": pa.list_(pa.list_(pa.binary()))}

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        # Products with 1024 are exact, and so are the floors.
        numbers = np.floor(_lists(batch.column("embedding"), width) * float(SCALE)).astype(np.int64)
        step = width // parts
        trees = [pack(grow(numbers[:, p * step : (p + 1) * step], LEAF)) for p in range(parts)]
        columns = [pa.array([v], kinds[c]) for c, v in (("ids", batch.column("vec_id").to_pylist()), ("labels", batch.column("label").to_pylist()), ("trees", trees))]
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), *columns], ["n", *kinds])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK - n)
                waiting.append(part)
                n, at = n + part.num_rows, at + part.num_rows
                if n == BLOCK:
                    yield block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting, n = [], 0
        if n:
            yield block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    return kept.select("vec_id", "label", "embedding").mapInArrow(build, f"n int, ids array<long>, labels array<{label.simpleString()}>, trees array<array<binary>>")


def _first_entries(kept: DataFrame, entries: int, width: int) -> np.ndarray:
    """Whole-number vectors of the smallest ids (null ids last, equal ids by their components)."""
    ids = kept.select("vec_id").filter("vec_id is not null").orderBy("vec_id").limit(entries).collect()  # ids only, at most ``entries`` a task
    few = kept.filter(F.col("vec_id") <= ids[-1].vec_id) if len(ids) == entries else kept
    rows = few.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    return np.floor(np.array([r.embedding for r in rows], np.float64).reshape(-1, width) * float(SCALE)).astype(np.int64)


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks (part, entry, component) after one round."""
    parts, k, width = books.shape
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [grow(book, 1) for book in shared.value]
        out = np.zeros((parts, k, width + 1), np.int64)
        for batch in batches:
            for n, stored in zip(batch.column("n").to_pylist(), batch.column("trees"), strict=True):
                for p, tree in enumerate(stored.as_py()):
                    count, total = sums(unpack(tree, n), trees[p])
                    out[p, :, 0] += count
                    out[p, :, 1:] += total
        slots = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(out.reshape(-1)[slots])], ["slot", "total"])

    summed = blocks.select("n", "trees").mapInArrow(gather, "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total"))
    total = np.zeros(parts * k * (width + 1), np.int64)
    for r in summed.collect():  # as many numbers as the codebooks have, and one count per entry
        total[r.slot] = r.total
    total = total.reshape(parts, k, width + 1)
    used = total[:, :, 0] > 0
    out = books.copy()
    out[used] = total[used][:, 1:] // total[used][:, :1]  # floors, also below zero
    return out


def _coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error: one row per vector."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    label = blocks.schema["labels"].dataType.elementType
    arrow_label = to_arrow_type(label)
    digits = max(2, len(f"{books.shape[1] - 1:x}"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        trees = [grow(book, 1) for book in books]
        for batch in batches:
            for i, n in enumerate(batch.column("n").to_pylist()):
                entry, error = np.zeros((n, len(books)), np.int64), np.zeros(n, np.int64)
                for p, stored in enumerate(batch.column("trees")[i].as_py()):
                    tree = unpack(stored, n)
                    nearest = owners(tree, trees[p])
                    entry[tree.order, p] = nearest
                    error[tree.order] += ((tree.points - books[p][nearest]) ** 2).sum(axis=1)
                codes = ["".join(f"{e:0{digits}x}" for e in row) for row in entry.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values.cast(pa.int64()), batch.column("labels")[i].values.cast(arrow_label), pa.array(codes), pa.array(error)],
                    ["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(code, f"vec_id long, label {label.simpleString()}, code string, error long")


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error, one row per kept vector; and the codebooks (part, entry, component).

    ``vectors`` needs vec_id (a whole number), label and embedding (array of numbers); other columns are ignored, whatever their names. Vectors that are null,
    empty, or hold null or non-finite components are dropped, and so are those with a component from 16,384 on in size (squared, they would not
    fit in 64 bits), and those whose length is not the most frequent of those that ``parts`` divides (the larger of equally frequent ones).

    A component x becomes floor(1024 x). The codebook of a part starts with that part of the ``entries`` smallest vec_ids (null ids
    last; equal ids by their components); fewer vectors give fewer entries. Each round assigns every part to its nearest entry, ties to the lower index,
    and replaces entries by their parts' floored means; unused ones stay. Then parts are assigned once more. ``code`` has the indexes in hexadecimal,
    two digits each (more beyond 256 entries); ``error`` is the sum of the squared distances. Repeated rows are vectors of their own. An empty table
    gives no rows and empty codebooks.
    """
    rows = exactly(vectors, "vec_id", "label", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    fits = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST // SCALE)
    rows = rows.filter((F.size("embedding") > 0) & (F.size("embedding") % parts == 0) & F.forall("embedding", fits))
    best = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    width = best[0].width if best else parts
    kept = rows.filter(F.size("embedding") == width)
    blocks = written(_blocks(kept, width, parts))
    first = _first_entries(kept, entries, width)
    books = np.stack(np.split(first, parts, axis=1))
    for _ in range(rounds if len(first) else 0):
        books = _round(blocks, books)
    return _coded(blocks, books), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the sum of ``error`` over rows of equal labels, nulls together; null where it does not fit a long.

    Frequent labels are joined by a broadcast, so no label is gathered in one task.
    """
    coded = written(coded)
    total = written(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"), F.count(F.lit(1)).alias("n")))
    least = coded.count() // FREQUENT
    frequent = total.filter(F.col("n") > least).select(F.struct("label").alias("_label"), "label_error")
    rare = total.filter(F.col("n") <= least).select(F.struct("label").alias("_label"), "label_error")
    keyed = coded.withColumn("_label", F.struct("label"))
    near = keyed.join(F.broadcast(frequent), "_label")
    far = keyed.join(F.broadcast(frequent), "_label", "left_anti").join(rare, "_label")
    return near.unionByName(far).drop("_label")
