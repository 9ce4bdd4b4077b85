"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its ``nearest`` closest reference points (pivots), taken from the data. Near
vectors see the pivots in nearly the same order, so they share most of them. Vectors that share at
least ``shared`` pivots share two among the first nearest - shared + 2 of each in the order of
pivot numbers: the inverted lists are kept by such pairs of pivots, inside a label. A pair of
vectors is looked at in one list only, that of its two smallest common pivots.

First only descriptions meet; vectors without a partner of enough common pivots drop out. Those
that have one meet again with their vectors, and cosines are computed in double precision. Long lists
are cut into blocks that meet in pairs. Equal vectors are one entry with a weight. Of the links only the number per
vector and a forest leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exactly, written
from .components import components

STEP_PAIRS = 500_000


def unit(rows: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of numbers of one length, as double precision vectors of length 1."""
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    x = np.stack([np.asarray(v, np.float64) for v in rows.to_pylist()])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spread_out(x: np.ndarray, most: int, close: float = 0.9, enough: int = 16) -> np.ndarray:
    """Up to ``most`` of some vectors, each the farthest from those before it.

    So a crowd of near copies gives one pivot, not many that its members cannot tell apart. Beyond
    ``enough``, none is taken that is ``close`` to another.
    """
    taken, nearest = [0], x @ x[0]
    while len(taken) < min(most, len(x)):
        far = int(nearest.argmin())
        if nearest[far] >= (close if len(taken) >= enough else 1 - 1e-9):
            break
        taken.append(far)
        nearest = np.maximum(nearest, x @ x[far])
    return x[taken]


def permutations(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Numbers of the closest pivots of each vector, rising."""
    near = np.argpartition(-(x @ pivots.T), nearest - 1, axis=1)[:, :nearest]
    return np.sort(near, axis=1).astype(np.int16)


def common_pivots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of descriptions: how many pivots they share, and the two smallest of those."""
    same = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a >= 0)
    count = same.sum(axis=1)
    first = same.argmax(axis=1)
    rest = same.copy()
    rest[np.arange(len(same)), first] = False
    second = rest.argmax(axis=1)
    at = np.arange(len(same))
    return count, a[at, first], a[at, second]


def pairs_in_lists(lists: np.ndarray, block: np.ndarray, cut: np.ndarray, described: np.ndarray, key: np.ndarray, need: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs to look at in sorted ``lists``: enough common pivots, and this list is theirs.

    ``need``: how many common pivots are enough for each; a list holds descriptions of one length. Negative numbers fill up
    short descriptions and are no pivots. In the list of two different blocks (``cut``) only pairs across them count.
    """
    at, step = np.arange(len(lists)), 1
    while True:
        at = at[at + step < len(lists)]
        at = at[lists[at] == lists[at + step]]
        if not len(at):
            return
        for begin in range(0, len(at), STEP_PAIRS):
            i = at[begin : begin + STEP_PAIRS]
            i = i[~cut[i] | (block[i] != block[i + step])]
            count, p, q = common_pivots(described[i], described[i + step])
            mine = (count >= need[i]) & (key[i] == pair_key(p, q))
            yield i[mine], i[mine] + step
        step += 1


def pair_key(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return p.astype(np.int64) << 16 | q.astype(np.int64)


def near_links(vectors: DataFrame, least: float, pivots: int, nearest: int, shared: int, block: int) -> tuple[DataFrame, DataFrame]:
    """``vectors``: cid, weight, label, embedding, all valid. Links per cid, and pairs that span the components."""
    spark = vectors.sparkSession
    by_length: dict[int, list] = {}
    # Reference points: the most spread out of a sample of fixed size, the same in every run.
    # About twice as many rows pass the hash as are taken, so that no task sends more than a few.
    hashed = vectors.withColumn("_h", F.xxhash64("embedding", F.lit("pivot")))
    bound = min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, (8 * pivots + 1000) / max(1, vectors.count()))))
    for r in hashed.filter(F.col("_h") <= bound).orderBy("_h", "cid").limit(4 * pivots).select("embedding").collect():
        by_length.setdefault(len(r.embedding), []).append(r.embedding)
    points = spark.sparkContext.broadcast({d: spread_out(unit(pa.array(rows)), pivots) for d, rows in by_length.items()})

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column("embedding")])
            for d in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == d)))
                known = points.value.get(int(d))
                x = unit(part.column("embedding"))
                if known is None or len(known) < 2:  # a length that the sample missed: one list, nothing shared
                    codes = np.tile(np.array([0, 1], np.int16), (len(x), 1))
                else:
                    codes = permutations(x, known, min(nearest, len(known)))
                first = max(2, min(codes.shape[1], codes.shape[1] - min(shared, codes.shape[1]) + 2))
                keys = np.stack([pair_key(codes[:, i], codes[:, j]) for i, j in combinations(range(first), 2)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid"), part.column("label"), pa.array([int(d)] * len(x), pa.int32()), pa.array(list(keys), pa.list_(pa.int64())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([v.tobytes() for v in x], pa.binary())],
                    ["cid", "label", "dims", "keys", "codes", "x"],
                )

    kind = vectors.schema["label"].dataType.simpleString()
    described = written(vectors.select("cid", "label", "embedding").mapInArrow(describe, f"cid long, label {kind}, dims int, keys array<long>, codes binary, x binary"))
    posted = described.select("cid", "label", "dims", "codes", F.explode("keys").alias("key")).withColumn("list", F.xxhash64("label", "dims", "key"))
    long = posted.groupBy("list").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    cut = (
        posted.join(long.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).drop("n"), "list", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
        .withColumn("list", F.when(F.col("blocks") == 1, F.col("list")).otherwise(F.xxhash64("list", "i", "j")))
        .select("cid", "list", "key", "codes", "mine", (F.col("i") != F.col("j")).alias("cut"))
    )
    buckets = max(1, described.count() // 3000)
    in_buckets = cut.withColumn("bucket", F.when(F.col("cut"), F.col("list")).otherwise(F.pmod("list", F.lit(buckets))))

    def lists_of(table: pa.Table) -> tuple:
        lists = table.column("list").to_numpy()
        order = np.argsort(lists, kind="stable")
        codes = table.column("codes").to_pylist()
        width = max(len(c) for c in codes) // 2
        matrix = np.full((len(codes), width), -1, np.int16)
        for k, o in enumerate(order.tolist()):
            c = np.frombuffer(codes[o], np.int16)
            matrix[k, : len(c)] = c
        take = lambda c: table.column(c).to_numpy()[order]
        return order, lists[order], take("mine"), take("cut"), matrix, take("key")

    def need(matrix: np.ndarray) -> np.ndarray:
        return np.minimum(shared, (matrix >= 0).sum(axis=1))

    def retrieve(table: pa.Table) -> pa.Table:
        order, lists, mine, cuts, matrix, key = lists_of(table)
        found = np.zeros(len(order), bool)
        for i, j in pairs_in_lists(lists, mine, cuts, matrix, key, need(matrix)):
            found[i] = True
            found[j] = True
        return table.drop_columns(["bucket"]).take(pa.array(order[found]))

    kept = in_buckets.groupBy("bucket").applyInArrow(retrieve, "cid long, list long, key long, codes binary, mine int, cut boolean")
    again = (
        written(kept).join(described.select("cid", "x"), "cid").join(vectors.select("cid", "weight"), "cid")
        .withColumn("bucket", F.when(F.col("cut"), F.col("list")).otherwise(F.pmod("list", F.lit(buckets))))
    )

    def verify(table: pa.Table) -> pa.Table:
        order, lists, mine, cuts, matrix, key = lists_of(table)
        cid, weight = table.column("cid").to_numpy()[order], table.column("weight").to_numpy()[order]
        stored = table.column("x").to_pylist()
        x = [np.frombuffer(stored[o], np.float64) for o in order.tolist()]
        width = max(map(len, x))
        matrix_x = np.zeros((len(x), width))
        for k, v in enumerate(x):
            matrix_x[k, : len(v)] = v
        links = np.zeros(len(cid), np.int64)
        linked_i, linked_j = [], []
        for i, j in pairs_in_lists(lists, mine, cuts, matrix, key, need(matrix)):
            near = np.einsum("ij,ij->i", matrix_x[i], matrix_x[j]) >= least
            i, j = i[near], j[near]
            links += np.bincount(i, weight[j], len(cid)).astype(np.int64) + np.bincount(j, weight[i], len(cid)).astype(np.int64)
            linked_i.append(i)
            linked_j.append(j)
        i, j = (np.concatenate(a) if a else np.zeros(0, np.int64) for a in (linked_i, linked_j))
        label = np.arange(len(cid))
        while len(i):  # smallest position each one is connected with
            low = np.minimum(label[i], label[j])
            new = label.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        who, at = np.unique(cid, return_inverse=True)
        total = np.bincount(at, links, len(who)).astype(np.int64)
        some = total > 0
        tree = label != np.arange(len(cid))
        nothing = np.full(int(tree.sum()), -1, np.int64)
        return pa.table({"a": np.concatenate((who[some], cid[tree])), "b": np.concatenate((np.zeros(int(some.sum()), np.int64), cid[label[tree]])), "n": np.concatenate((total[some], nothing))})

    out = written(again.groupBy("bucket").applyInArrow(verify, "a long, b long, n long"))
    links = out.filter("n >= 0").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    return links, out.filter("n < 0").select("a", "b")


def near_duplicates(vectors: DataFrame, least: float = 0.98, pivots: int | None = None, nearest: int = 8, shared: int = 3, block: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    ``vectors`` needs vec_id (a whole number), embedding (array of numbers) and label; other columns are ignored, whatever their
    names. Vectors link if their labels are equal and not null, their lengths are equal and their cosine is at least
    ``least``. Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows
    with a null id (null component, not kept). Repeated rows are vectors of their own, linked with each other.
    No pair below ``least`` is linked; a pair above it is missed if it shares fewer than ``shared`` of
    ``nearest`` pivots (tests measure the share found). Every vector is indexed; ``pivots`` bounds the
    reference points, which come from a sample of four times as many; by default they grow with the root of the largest label, from 512 to 32,000, so that lists stay short. An empty table gives no rows.
    """
    rows = written(
        exactly(vectors, "vec_id", "label", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
        .withColumn("_h1", F.xxhash64("embedding")).withColumn("_h2", F.hash("embedding", F.lit(7)))
    )
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    valid = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0)
    )
    classes = written(
        rows.filter(F.coalesce(valid, F.lit(False))).groupBy("label", "_h1", "_h2")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"), F.first("embedding").alias("embedding"))
        .withColumn("cid", F.monotonically_increasing_id())  # rows of one vec_id may be of several classes
    )
    if pivots is None:
        most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        pivots = int(min(32_000, max(512, 4 * most**0.5)))
    links, pairs = near_links(classes.select("cid", "weight", "label", "embedding"), least, pivots, nearest, shared, block)
    roots = written(components(pairs))
    smallest = roots.join(classes.select("cid", "first_id"), F.col("node") == F.col("cid")).groupBy("root").agg(F.min("first_id").alias("smallest"))
    of_node = roots.join(smallest, "root").select("node", "smallest")
    of_class = (
        classes.select("label", "_h1", "_h2", "cid", "first_id", "weight").join(links, "cid", "left").join(of_node, F.col("cid") == F.col("node"), "left")
        .select("label", "_h1", "_h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("smallest", "first_id").alias("component_id"))
    )
    joined = rows.withColumn("_valid", F.coalesce(valid, F.lit(False))).drop("embedding").join(of_class.withColumn("_valid", F.lit(True)), ["label", "_h1", "_h2", "_valid"], "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
