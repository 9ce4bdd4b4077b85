"""Connected components of a graph given as pairs, by star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

# Most different edges that one task contracts, 16 bytes each. Those of more are contracted in rounds, of which each costs the driver three plans.
TASK_EDGES = 2_000_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of ``a`` and ``b``, sorted, and for each the smallest it is connected with by the pairs."""
    ids, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    rank = np.random.default_rng(0).permutation(len(ids))  # in any order of ids half of the trees join another in a round, as expected
    x, y = rank[x], rank[y]
    root = np.arange(len(ids))
    while len(x):
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
    root = root[rank]
    least = np.full(len(ids), len(ids))
    np.minimum.at(least, root, np.arange(len(ids)))
    return ids, ids[least[root]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if held:
        node, root = roots_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """node, root: for each whole number in ``a`` or ``b``, the smallest one it is connected with.

    Nulls and loops are left out. Up to ``task_edges`` different edges are contracted by one task. Of more, each round points every node
    at the smallest of its neighbours, alternately for larger neighbours and for smaller ones, until only stars are
    left (a logarithmic number of rounds). Groups are never gathered: a node's smallest
    neighbour is an aggregate, joined back, and AQE splits a node with very many.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct()
    edges, before = written(edges), None
    while (now := _state(edges)) != before:
        if now[0] <= task_edges:
            return edges.coalesce(1).mapInArrow(_contracted, "node long, root long")
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.filter("m < a").select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        large = written(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
