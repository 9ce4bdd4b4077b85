"""Ranked lexical search by scanning documents with an Aho-Corasick automaton of all item terms.

There is no index of the documents. The terms of the items, each between two boundary marks, make one automaton, which every
task builds from a broadcast list. A document is normalised to terms between single boundary bytes, so what the
automaton finds are whole terms; its outputs are term numbers, and those map to the items that hold them.

The text is scanned twice: once for the statistics of the whole collection (documents, terms, and how many documents
hold each item term), then for the scores. A task keeps the best of each item only, so no list grows with
the documents.

Items are dealt into groups of a bounded number of term bytes; each group has its own automaton and its own scans.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, exactly, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM_BYTE = [b >= 0x80 or chr(b).isalnum() for b in range(256)]
#: A-Z become small, everything that is in no term becomes the boundary.
TO_TERMS = bytes(ord(chr(b).lower()) if t and b < 0x80 else b if t else 0x20 for b, t in enumerate(_TERM_BYTE))
SCAN = 4_000_000
LAST_ID = 2**63 - 1


class Terms:
    """The automaton of some terms, and the counts of its hits in texts."""

    def __init__(self, terms: list[str]):
        self.n = len(terms)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(terms):
            self.automaton.add_word(f" {term.encode().decode('latin-1')} ", number)
        if terms:
            self.automaton.make_automaton()

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text; and text, term, occurrences of what was found, ordered by text and term."""
        hay = b" ".join([b"", *texts, b""]).translate(TO_TERMS)
        ends = np.cumsum([1 + len(t) for t in texts])  # the boundary before each text belongs to it
        mark = np.frombuffer(hay, np.uint8) != 0x20
        begins = np.flatnonzero(mark[1:] & ~mark[:-1])
        length = np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(texts))
        found, at = [], 0
        while at < len(hay) - 1 and self.n:  # pieces end at a boundary, which the next one starts with
            stop = hay.find(b" ", min(at + SCAN, len(hay) - 1))
            hits = np.fromiter(chain.from_iterable(self.automaton.iter(hay[at : stop + 1].decode("latin-1"))), np.int64).reshape(-1, 2)
            text = np.searchsorted(ends, hits[:, 0] + at - 1, side="right")
            found.append(np.unique(text * self.n + hits[:, 1], return_counts=True))
            at = stop
        if len(found) > 1:
            keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            times = np.zeros(len(keys), np.int64)
            np.add.at(times, back, np.concatenate([c for _, c in found]))
        else:
            keys, times = found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return length, keys // max(self.n, 1), keys % max(self.n, 1), times


class Best:
    """The ``k`` best (score, then smallest id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least, self.last = np.zeros(items, np.int64), np.full(items, LAST_ID)  # what a full list ends with

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores``: documents by items."""
        row, item = np.nonzero((scores > self.least) | ((scores == self.least) & (scores > 0) & (docs[:, None] < self.last)))
        if not len(row):
            return
        item = np.concatenate((self.item, item))
        score, doc = np.concatenate((self.score, scores[row, item[len(self.item) :]])), np.concatenate((self.doc, docs[row]))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.k
        self.item, self.score, self.doc, rank = item[kept], score[kept], doc[kept], rank[kept]
        full = rank == self.k - 1
        self.least[self.item[full]], self.last[self.item[full]] = self.score[full], self.doc[full]


def term_scores(text: np.ndarray, weight: np.ndarray, times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * norm[text]))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches_of(batches, SCAN):
        yield batch, [t or b"" for t in batch.column("text").to_pylist()]


def _group_search(rows: DataFrame, held: list, item_type: str, k: int) -> DataFrame:
    """``held``: (item, its terms) of one group. The best rows of every task: item_id, doc_id, score."""
    terms = sorted({t for _, ts in held for t in ts})
    number = {t: i for i, t in enumerate(terms)}
    session = rows.sparkSession
    known = session.sparkContext.broadcast(terms)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Terms(known.value)
        holders, documents, words = np.zeros(scanner.n, np.int64), 0, 0
        for _, texts in _texts(batches):
            length, _, term, _ = scanner.counts(texts)
            holders += np.bincount(term, minlength=scanner.n)
            documents += int((length > 0).sum())
            words += int(length.sum())
        some = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((some, [-1, -2]))), pa.array(np.concatenate((holders[some], [documents, words])))], ["term", "n"])

    counted = rows.select("text").mapInArrow(gather, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = {r.term: r.n for r in counted.collect()}  # one row per item term of the group
    documents, words = total.get(-1, 0), total.get(-2, 0)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * total.get(i, 0) + 1))) for i in range(len(terms))], np.int64)
    posted = sorted((number[t], item) for item, (_, ts) in enumerate(held) for t in ts)
    post_item = np.array([i for _, i in posted], np.int64)
    post_from = np.searchsorted(np.array([t for t, _ in posted], np.int64), np.arange(len(terms) + 1))
    shared = session.sparkContext.broadcast((terms, weight, post_item, post_from, [i for i, _ in held]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weight, post_item, post_from, names = shared.value
        scanner, best = Terms(terms), Best(len(names), k)
        step = max(1, 2_000_000 // max(1, len(names)))
        for batch, texts in _texts(batches):
            ids = batch.column("doc_id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)
            length, text, term, times = scanner.counts(texts)
            norm = np.array([50 + 50 * n * documents // max(words, 1) for n in length.tolist()], np.int64)
            part = term_scores(text, weight[term], times, norm)
            for begin in range(0, len(texts), step):
                a, b = np.searchsorted(text, (begin, begin + step))
                n_items = post_from[term[a:b] + 1] - post_from[term[a:b]]
                entry = np.repeat(np.arange(a, b), n_items)
                place = np.arange(len(entry)) - np.repeat(np.cumsum(n_items) - n_items, n_items)
                items = post_item[post_from[term[entry]] + place]
                scores = np.zeros((min(step, len(texts) - begin), len(names)), np.int64)
                np.add.at(scores, (text[entry] - begin, items), part[entry])
                best.add(scores, ids[begin : begin + step])
        last = best.doc == LAST_ID
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc, mask=last), pa.array(best.score)], ["item", "doc_id", "score"]
        )

    found = rows.mapInArrow(search, "item long, doc_id long, score long")
    names = session.createDataFrame([(i, name) for i, (name, _) in enumerate(held)], f"item long, item_id {item_type}")
    return found.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")


def deal_items(items: DataFrame, most: int) -> DataFrame:
    """item, term, part: parts of at most ``most`` bytes of terms, or of one item."""
    size = items.groupBy("item").agg(F.sum(F.octet_length("term") + 2).alias("size"))
    parts = 1
    while True:
        dealt = size.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
        largest = dealt.groupBy("part").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.max("size")).first()[0]
        if (largest or 0) <= most:
            return items.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
        parts *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 50, group_bytes: int = 2_000_000) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0, best first.

    ``docs`` needs doc_id (a whole number) and text, ``items`` item_id and text; other columns are ignored, whatever their
    names. A term is a run of letters, digits and all beyond ASCII, A-Z lower-cased. With N documents that hold a term, L terms in
    all, n in the document, df documents that hold a term: it weighs floor(1000 ln((2N + 2) / (2 df + 1))), and scores weight *
    (10^9 tf div (1000 tf + 20 m)) with m = 50 + (50 n N div L). An item's terms count once each.

    Equal scores go by ascending doc_id, null ids last. Null and empty texts hold no terms: as documents they are found by nothing, as
    items they find nothing (no rows). Repeated document rows are documents of their own; rows with equal item_id (null too) are one item with
    the terms of all. Empty tables give no rows. Texts of any length are scanned whole, in pieces.
    """
    rows = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    asked = exactly(items, "item_id", "text")
    item_type = asked.schema["item_id"].dataType.simpleString()
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    terms = asked.select(F.struct("item_id").alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), 0)).alias("term")).distinct()
    dealt = written(deal_items(written(terms), group_bytes))
    parts = []
    for (part,) in dealt.select("part").distinct().orderBy("part").collect():  # one number per group
        held = dealt.filter(F.col("part") == part).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        held.sort(key=lambda r: str(r.item.item_id))
        parts.append(_group_search(rows, [(r.item.item_id, r.terms) for r in held], item_type, k))
    if not parts:
        return rows.sparkSession.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    # Every task has sent its best of each item: first the best of some tasks, then the best of all.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item_id", "salt").orderBy(*order)
    first = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(16))).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
