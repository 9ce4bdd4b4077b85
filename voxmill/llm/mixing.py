"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Documents are cut into blocks of at most ``block`` words. Every source's blocks are put in
   a random order that depends on ids and the seed only: by hash, ranked inside slots of the
   hash so that a large source is ranked by many tasks.
2. A source's quota, in blocks, is what its target needs: whole passes over the source, then
   a head of its order.
3. The quotas of all sources are split over the output shards by a binary tree. Each node draws
   how many blocks of each source go left (multivariate hypergeometric, seeded by the
   node), so shards of equal size hold random shares that add up exactly. The upper levels are
   drawn once, the subtrees by tasks.
4. A leaf's counts are a stretch of each source's order, disjoint from all other leaves. Inside
   a shard, blocks are shuffled.
"""

from __future__ import annotations

import re
from math import e, lgamma, log, log1p, sqrt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, place_of, written

SLOT = 4096
SUBTREES = 256
#: numpy draws from up to this many; beyond it ``large_draw`` draws from the same law.
EXACT = 500_000_000


def source_targets(names: Sequence[str | None], sizes: Sequence[int], weights: Sequence[float], max_ratio: float) -> list[float]:
    """Targets by weight that add up to all sizes; none is above ``max_ratio`` times its source.

    Sources are numbered by code point, null last, and take ``weights`` in turn. What the
    stopped ones leave is shared by the others by weight until none is above.
    """
    order = sorted(range(len(names)), key=lambda i: (names[i] is None, names[i] or ""))
    weight = {i: weights[k % len(weights)] for k, i in enumerate(order)}
    targets, free, left = [0.0] * len(names), set(order), float(sum(sizes))
    while free:
        shares = sum(weight[i] for i in free)
        over = [i for i in free if left * weight[i] / shares > max_ratio * sizes[i]]
        if not over:
            for i in free:
                targets[i] = left * weight[i] / shares
            break
        for i in over:
            targets[i] = float(max_ratio * sizes[i])
        left -= sum(targets[i] for i in over)
        free -= set(over)
    return targets


def log_factorial_step(m: int, d: int) -> float:
    """ln((m + d)! / m!) without the loss that a difference of two large logarithms has."""
    if min(m, m + d) < 1000:
        return lgamma(m + d + 1) - lgamma(m + 1)
    x, y = m + 1.0, m + d + 1.0
    tail = lambda v: 1 / (12 * v) - 1 / (360 * v**3)  # noqa: E731  Stirling's series
    return (x - 0.5) * log1p(d / x) + d * log(y) - d + tail(y) - tail(x)


def large_draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """One hypergeometric draw from an urn of any size, by the ratio of uniforms around the mode.

    Points of a box around the curve of the (log-concave) probabilities are tried until one is below it. Probabilities are compared with that of
    the mode through factorial steps, so they are right to about 1e-8 however large the urn is.
    """
    total = good + bad
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    mean = sample * good / total
    variance = mean * (bad / total) * ((total - sample) / max(1, total - 1))
    mode = min(high, max(low, (sample + 1) * (good + 1) // (total + 2)))
    width = 2 * sqrt(2 / e) * sqrt(variance + 0.5) + 3 - 2 * sqrt(3 / e)
    while True:
        u, v = 1 - rng.random(), rng.random()
        at = mean + 0.5 + width * (v - 0.5) / u
        if not low <= at < high + 1:
            continue
        k = int(at)
        d = k - mode
        ratio = -(log_factorial_step(mode, d) + log_factorial_step(good - mode, -d) + log_factorial_step(sample - mode, -d) + log_factorial_step(bad - sample + mode, d))
        if 2 * log(u) <= ratio:
            return k


def split_counts(counts: np.ndarray, left: int, seed: Sequence[int]) -> np.ndarray:
    """How many of each colour are among ``left`` drawn without replacement."""
    rng = np.random.Generator(np.random.PCG64(np.random.SeedSequence(list(seed))))
    out, total = np.zeros_like(counts), int(counts.sum())
    for i, n in enumerate(map(int, counts)):  # one marginal after the other
        rest = total - n
        if left == 0:
            break
        if rest == 0:
            k = left
        elif n < EXACT and rest < EXACT:
            k = int(rng.hypergeometric(n, rest, left)) if n else 0
        else:
            k = large_draw(rng, n, rest, left)
        out[i], left, total = k, left - k, rest
    return out


def _walk(first: int, last: int, offsets: np.ndarray, counts: np.ndarray, per_shard: int, seed: int, leaf: int) -> Iterator[tuple]:
    """Nodes of at most ``leaf`` shards below [first, last): (first, last, offsets, counts), in order."""
    if last - first <= leaf:
        yield first, last, offsets, counts
        return
    middle = (first + last) // 2
    left = split_counts(counts, min((middle - first) * per_shard, int(counts.sum())), (seed, first, last))
    yield from _walk(first, middle, offsets, left, per_shard, seed, leaf)
    yield from _walk(middle, last, offsets + left, counts - left, per_shard, seed, leaf)


def mix_blocks(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_ratio: float = 3, block: int = 256, shard_blocks: int = 4096, seed: int = 17,
    carry: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Documents, and the blocks that the mix takes of them.

    ``docs`` needs doc_id, text and source; other columns are ignored, whatever their names.
    First frame: doc_id, size (words; null text: 0), source_size, target, _row, a key of the
    row. Second: _row, doc_id, pass, start, words, shard, position: ``words`` words of the document from
    word ``start`` on, at a place in a shard; each block once per pass, at most ``max_ratio``
    passes. Null sources are one source, the last. Repeated rows and ids count each on their
    own. Sources without words have a target of 0. An empty table gives no rows. The driver
    and the tree's nodes hold a few numbers per source, never rows. With ``carry`` all columns of ``docs`` are
    in the first frame as _carried_0 and so on.
    """
    spark = docs.sparkSession
    flat = docs.toDF(*(f"_carried_{i}" for i in range(len(docs.columns))))
    doc_id, text, source = (F.col(f"_carried_{place_of(docs, c)}") for c in ("doc_id", "text", "source"))
    sized = written(
        flat.select(
            doc_id.alias("doc_id"), source.cast("string").alias("source"),
            F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            *(flat.columns if carry else []),
        )
    ).withColumn("_row", F.monotonically_increasing_id())  # of the written files: the same wherever it is read
    stats = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("size"), F.sum(F.ceil(F.col("size") / block)).cast("long").alias("blocks"))
        .orderBy(F.col("source").asc_nulls_last()).collect()
    )
    targets = source_targets([s.source for s in stats], [s["size"] for s in stats], weights, max_ratio)
    passes = [min(int(t // s["size"]), int(max_ratio)) if s["size"] else 0 for s, t in zip(stats, targets, strict=True)]
    rest = [max(t - p * s["size"], 0.0) for s, t, p in zip(stats, targets, passes, strict=True)]
    numbered = spark.createDataFrame(
        [(s.source, i, s["size"], t, p, r, s.blocks, s.blocks // SLOT + 1) for i, (s, t, p, r) in enumerate(zip(stats, targets, passes, rest, strict=True))],
        "source string, no int, source_size long, target double, passes int, rest double, blocks long, slots long",
    )
    # One small row per source: broadcast while that is so, else an ordinary join.
    known = F.broadcast(numbered) if len(stats) <= 100_000 else numbered
    marked = sized.join(known, sized.source.eqNullSafe(numbered.source)).drop(numbered.source)

    hashed = F.xxhash64(F.lit(seed), "doc_id", "start")
    blocks = (
        marked.filter("size > 0")
        .select("_row", "doc_id", "size", "no", "rest", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block).cast("long"))).alias("start"))
        .withColumn("words", F.least(F.lit(block).cast("long"), F.col("size") - F.col("start")))
        .withColumn("h", hashed)
        .withColumn("slot", F.floor((F.shiftrightunsigned("h", 12) / F.lit(float(1 << 52))) * F.col("slots")).cast("long"))
    )
    # The slot grows with the order: order by slot, then by hash inside it.
    in_slot = Window.partitionBy("no", "slot").orderBy("h", "doc_id", "size", "_row")
    before = Window.partitionBy("no").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy("no", "slot").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w")).select(
        "no", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("words0")
    )
    ranked = written(
        blocks.withColumn("r", F.row_number().over(in_slot) - 1)
        .withColumn("w", F.sum("words").over(in_slot.rowsBetween(Window.unboundedPreceding, 0)))
        .join(offsets, ["no", "slot"])
        .select(
            "_row", "doc_id", "no", "start", "words", (F.col("r") + F.col("rank0")).alias("rank"),
            ((F.col("w") + F.col("words0") - F.col("words") / 2) <= F.col("rest")).alias("partly"),
        )
    )
    heads = {r.no: r.n for r in ranked.filter("partly").groupBy("no").agg(F.count(F.lit(1)).alias("n")).collect()}
    quotas = np.array([p * s.blocks + heads.get(i, 0) for i, (s, p) in enumerate(zip(stats, passes, strict=True))], dtype=np.int64)

    taken = (
        ranked.join(known.select("no", "passes", "blocks"), "no")
        .withColumn("times", F.col("passes") + F.col("partly").cast("int"))
        .filter("times > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("pass"))
        .withColumn("place", F.col("pass") * F.col("blocks") + F.col("rank"))  # in the source's quota
        .withColumn("stretch", F.floor(F.col("place") / SLOT))
        .select("_row", "doc_id", "no", "pass", "start", "words", "place", "stretch")
    )
    shards = max(1, -(-int(quotas.sum()) // shard_blocks))
    nodes = [
        (first, last, begin.tolist(), counts.tolist())
        for first, last, begin, counts in _walk(0, shards, np.zeros_like(quotas), quotas, shard_blocks, seed, max(1, shards // SUBTREES))
    ]

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node in batch.to_pylist():
                found = _walk(node["first"], node["last"], np.array(node["begin"], np.int64), np.array(node["counts"], np.int64), shard_blocks, seed, 1)
                rows = [(no, int(b), int(b + n), shard) for shard, _, begin, counts in found for no, (b, n) in enumerate(zip(begin, counts, strict=True)) if n]
                no, b, e, shard = zip(*rows, strict=True) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(no, pa.int32()), pa.array(b, pa.int64()), pa.array(e, pa.int64()), pa.array(shard, pa.int64())], ["no", "from", "to", "shard"])

    tree = (
        spark.createDataFrame(nodes, "first long, last long, begin array<long>, counts array<long>")
        .repartition(min(len(nodes), 64), "first").mapInArrow(leaves, "no int, from long, to long, shard long")
        .select("*", F.explode(F.sequence(F.floor(F.col("from") / SLOT), F.floor((F.col("to") - 1) / SLOT))).alias("stretch"))
    )
    dealt = taken.join(tree, ["no", "stretch"]).filter("place >= from and place < to")
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "pass", "start"), "doc_id", "pass", "start", "place")
    placed = dealt.select("_row", "doc_id", "pass", "start", "words", "shard", "place").withColumn("position", F.row_number().over(in_shard) - 1).drop("place")
    return marked.select("doc_id", "size", "source_size", "target", "_row", *(flat.columns if carry else [])), placed


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of ``docs``; see ``mix_blocks``.

    ``taken`` is the number of words the mix takes of the document, repeats counted.
    """
    rows, placed = mix_blocks(docs, **options)
    words = placed.groupBy("_row").agg(F.sum("words").alias("taken"))
    return rows.join(words, "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


_WORD = re.compile(WORD)


def cut_words(text: str, stretches: list[tuple[int, int]]) -> str:
    """Words [start, start + n) of a text for each stretch, with the white space between them; stretches that touch stay one."""
    joined: list[list[int]] = []
    for start, n in sorted(stretches):
        if joined and joined[-1][1] == start:
            joined[-1][1] = start + n
        else:
            joined.append([start, start + n])
    places = [m.span() for m in _WORD.finditer(text)]
    return "\n".join(text[places[a][0] : places[b - 1][1]] for a, b in joined)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: the columns of ``docs``, a row per document and pass, ``text`` being what that pass takes of it.

    See ``mix_blocks``. Documents of which nothing is taken are left out; a document taken whole keeps its text as it is.
    """
    rows, placed = mix_blocks(docs, carry=True, **options)
    taken = placed.groupBy("_row", "pass").agg(F.collect_list(F.struct("start", "words")).alias("_blocks"), F.sum("words").alias("_words"))
    at = place_of(docs, "text")

    @F.pandas_udf("string")
    def cut(text, blocks):
        import pandas as pd

        return pd.Series([cut_words(t, [(b["start"], b["words"]) for b in bs]) for t, bs in zip(text, blocks, strict=True)], dtype=object)

    joined = rows.join(taken, "_row")
    whole = joined.filter(F.col("_words") == F.col("size"))
    part = joined.filter(F.col("_words") < F.col("size")).withColumn(f"_carried_{at}", cut(F.col(f"_carried_{at}").cast("string"), "_blocks"))
    columns = [F.col(f"_carried_{i}").alias(c) for i, c in enumerate(docs.columns)]
    return whole.select(*columns).unionByName(part.select(*columns))
