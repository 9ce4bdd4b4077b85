"""Passages of benchmark items in documents: a prefix-filtered set join of word shingles.

1. Each item is cut into windows of ``window`` consecutive words, and a window is a set of shingles (``shingle`` words each, with their
   places in the window).
2. Shingles are ordered by rarity: how often each stands in all documents, counted in a first scan.
3. A window that shares at least ``least`` percent of its k shingles with a stretch of a document shares one of its
   k - need + 1 rarest (its prefix). Only those are joined with the documents' shingles.
4. A match says where the window would lie. Length and place must fit: it neither begins before the text nor ends after it.
5. What is left is verified over the stretch of the window's size: at least ``need`` shingles at their places, and for
   ``least=100`` every word byte by byte.

The items are the bounded side: they are dealt into groups of a bounded number of words, whose windows every task gets from a
broadcast. Documents are scanned and never shuffled; only with several groups are the finds of a document put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .common import batches_of, exactly, written
from .lexical_search import LOWER, TO_TERMS, UPPER, deal_items
from .shingles import MIX, STEP, U64, buffers, mix, words

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TO_WORDS = np.frombuffer(TO_TERMS, np.uint8)
BATCH = 4_000_000
#: Bits of a hash that choose one of a few million marks: most shingles of documents are told apart from all of the items by them alone.
MARKS = 22


def grams(word: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on, also across texts; shorter than ``word`` by n - 1."""
    h = np.zeros(max(len(word) - n + 1, 0), U64)
    for j in range(n):
        h = h * STEP + word[j : j + len(h)]
    return mix(h + np.array(n, U64) * MIX)


class Lookup:
    """Numbers of 64-bit keys, with a bit table in front."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.marks = np.zeros(1 << MARKS, bool)
        self.marks[keys >> U64(64 - MARKS)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` that hold a key, and the key's number."""
        at = np.flatnonzero(self.marks[h >> U64(64 - MARKS)])
        number = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[number] == h[at]
        return at[same], number[same]


@dataclass
class Windows:
    """Distinct windows of a group of items: stretches of ``word``, with the items that hold each."""

    word: np.ndarray  # hashes of all item words, one after the other
    data: bytes  # their bytes
    word_from: np.ndarray  # where each begins in ``data``; one more at the end
    begin: np.ndarray  # per window: its first word
    length: np.ndarray
    item: np.ndarray  # items of window i: item[item_from[i] : item_from[i + 1]]
    item_from: np.ndarray
    shingle: int

    def sizes(self) -> list[int]:
        """Words per shingle that occur: short windows are one shingle of all their words."""
        return sorted(set(np.minimum(self.length, self.shingle).tolist()))

    def of_size(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows with shingles of ``size`` words, and their shingles' hashes by first word."""
        return np.flatnonzero(np.minimum(self.length, self.shingle) == size), grams(self.word, size)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, place in it and hash of all shingles of ``size`` words."""
        which, h = self.of_size(size)
        place, of = repeat(np.zeros(len(which), np.int64), self.length[which] - size + 1)
        return which[of], place, h[self.begin[which[of]] + place]


def cut_windows(held: list[tuple[int, list[str]]], window: int, shingle: int) -> Windows:
    """``held``: (item number, its words); an item may come several times."""
    texts = [" ".join(ws).encode() for _, ws in held]
    ends = np.cumsum([0, *map(len, texts)])
    whole = b"".join(texts)
    word, text = words(np.frombuffer(whole, np.uint8), ends, lower=False)
    data = [w.encode() for _, ws in held for w in ws]
    count = np.bincount(text, minlength=len(held))
    first = np.cumsum(count) - count
    begin, length, item = [], [], []
    for (number, ws), f in zip(held, first.tolist(), strict=True):
        n = max(1, len(ws) - window + 1) if ws else 0
        begin.append(f + np.arange(n))
        length.append(np.full(n, min(window, len(ws))))
        item.append(np.full(n, number))
    begin, length, item = (np.concatenate(a).astype(np.int64) if a else np.zeros(0, np.int64) for a in (begin, length, item))
    if not len(begin):
        return Windows(word, b"", np.zeros(1, np.int64), begin, length, item, np.zeros(1, np.int64), shingle)
    # Equal windows are one: told apart by two hashes of all their words.
    key = np.zeros((len(begin), 2), U64)
    for size in np.unique(length).tolist():
        these = length == size
        key[these, 0] = grams(word, size)[begin[these]]
        key[these, 1] = grams(mix(word ^ MIX), size)[begin[these]]
    _, keep, of = np.unique(key, axis=0, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([of.reshape(-1), item]), axis=1)
    return Windows(
        word, b"".join(data), np.cumsum([0, *map(len, data)]), begin[keep], length[keep],
        pairs[1], np.searchsorted(pairs[0], np.arange(len(keep) + 1)), shingle,
    )


def prefixes(windows: Windows, size: int, common: dict[int, np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, window and place of each prefix shingle, ordered by key. ``common``: per size (sorted keys, occurrences)."""
    keys, times = common[size]
    number, place, key = windows.shingles(size)
    order = np.lexsort((place, key, times[np.searchsorted(keys, key)], number))
    number, place, key = number[order], place[order], key[order]
    rank = np.arange(len(number)) - np.searchsorted(number, number)
    k = windows.length[number] - size + 1
    kept = rank <= k - needed(k, least)
    number, place, key = number[kept], place[kept], key[kept]
    order = np.argsort(key, kind="stable")
    return key[order], number[order], place[order]


def needed(shingles: np.ndarray, least: int) -> np.ndarray:
    """How many of a window's shingles are at least ``least`` percent."""
    return np.maximum(1, -(-shingles * least // 100))


class Texts:
    """Words of a batch of texts."""

    def __init__(self, column: pa.Array):
        data, ends = buffers(column)
        self.data = _TO_WORDS[data]
        self.ends = ends
        self.word, self.text = words(self.data, ends, lower=False)
        self.count = np.bincount(self.text, minlength=len(column))
        self.first = np.cumsum(self.count) - self.count

    def grams(self, size: int) -> np.ndarray:
        """By first word; 0 where the text ends before."""
        h = grams(self.word, size)
        inside = self.text[: len(h)] == self.text[size - 1 :]
        return np.where(inside, h, U64(0))

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and length of each word."""
        mark = np.zeros(len(self.data) + 2, bool)
        mark[1:-1] = self.data != 0x20
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.ends] = True
        start = np.flatnonzero(mark[1:-1] & (~mark[:-2] | edge[:-1]))
        stop = np.flatnonzero(mark[1:-1] & (~mark[2:] | edge[1:])) + 1
        return start, stop - start


def repeat(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range each is of."""
    of = np.repeat(np.arange(len(begin)), length)
    return np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length) + begin[of], of


def same_words(texts: Texts, at: np.ndarray, windows: Windows, word: np.ndarray) -> np.ndarray:
    """Whether the words ``at`` of the texts are, byte by byte, those numbered ``word`` of the items."""
    start, length = texts.places()
    begin = windows.word_from[word]
    same = length[at] == windows.word_from[word + 1] - begin
    some = np.flatnonzero(same)
    if len(some):
        left, of = repeat(start[at[some]], length[at[some]])
        right = left - start[at[some]][of] + begin[some][of]
        equal = texts.data[left] == np.frombuffer(windows.data, np.uint8)[right]
        same[some] = np.logical_and.reduceat(equal, np.cumsum(length[at[some]]) - length[at[some]])
    return same


def occurrences(texts: Texts, windows: Windows, joins: dict[int, tuple], least: int) -> tuple[np.ndarray, np.ndarray]:
    """First words (of the batch) and windows that occur there. ``joins``: per size of shingles, the prefixes and all of the items' shingles."""
    found_at, found = [], []
    for size, (lookup, key_from, number, place, own) in joins.items():
        h = texts.grams(size)
        at, key = lookup.find(h)
        of, hit = repeat(key_from[key], key_from[key + 1] - key_from[key])
        window, start = number[of], at[hit] - place[of]
        # Length and place: the stretch lies inside the text of the match.
        text = texts.text[at[hit]]
        fits = (start >= texts.first[text]) & (start + windows.length[window] <= texts.first[text] + texts.count[text])
        window, start = window[fits], start[fits]
        if least < 100:  # several prefix shingles may have found the same
            window, start = np.unique(np.stack([window, start]), axis=1)
        k = windows.length[window] - size + 1
        shared = np.zeros(len(window), np.int64)
        for j in range(int(k.max()) if len(k) else 0):
            here = np.flatnonzero(k > j)
            shared[here] += h[start[here] + j] == own[windows.begin[window[here]] + j]
        enough = shared >= needed(k, least)
        window, start = window[enough], start[enough]
        if least == 100 and len(window):
            at, of = repeat(start, windows.length[window])
            pairs, back = np.unique(np.stack([at, at - start[of] + windows.begin[window[of]]]), axis=1, return_inverse=True)
            same = same_words(texts, pairs[0], windows, pairs[1])[back.reshape(-1)]
            whole = np.logical_and.reduceat(same, np.cumsum(windows.length[window]) - windows.length[window])
            window, start = window[whole], start[whole]
        found_at.append(start)
        found.append(window)
    return (np.concatenate(a) if a else np.zeros(0, np.int64) for a in (found_at, found))


def _list(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)


def _find(rows: DataFrame, held: list, names: list, item_type: DataType, window: int, shingle: int, least: int, only_hits: bool) -> DataFrame:
    """Columns of ``rows`` without the text, and n_words, spans, items, for one group of items."""
    session = rows.sparkSession
    windows = cut_windows(held, window, shingle)
    sizes = windows.sizes()
    own = {s: np.unique(windows.shingles(s)[2]) for s in sizes}
    known = session.sparkContext.broadcast(own)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {s: Lookup(keys) for s, keys in known.value.items()}
        times = {s: np.zeros(len(keys), np.int64) for s, keys in known.value.items()}
        for batch in batches_of(batches, BATCH):
            texts = Texts(batch.column("text"))
            for s, lookup in lookups.items():
                times[s] += np.bincount(lookup.find(texts.grams(s))[1], minlength=len(times[s]))
        for s, n in times.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), s, np.int32)), pa.array(some), pa.array(n[some])], ["size", "number", "n"])

    rarity = {s: (keys, np.zeros(len(keys), np.int64)) for s, keys in own.items()}
    if sizes:
        for r in rows.select("text").mapInArrow(gather, "size int, number long, n long").groupBy("size", "number").agg(F.sum("n").alias("n")).collect():
            rarity[r["size"]][1][r["number"]] = r["n"]  # one row per shingle of the group
    joins = {s: prefixes(windows, s, rarity, least) for s in sizes}
    shared = session.sparkContext.broadcast((windows, joins, names))
    arrow_type = to_arrow_type(item_type)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, prefix, names = shared.value
        joins = {}
        for s, (key, number, place) in prefix.items():
            keys = np.unique(key)
            joins[s] = (Lookup(keys), np.append(np.searchsorted(key, keys), len(key)), number, place, windows.of_size(s)[1])
        labels = pa.array(names, arrow_type)
        for batch in batches_of(batches, BATCH):
            texts = Texts(batch.column("text"))
            at, found = occurrences(texts, windows, joins, least)
            step = np.zeros(len(texts.word) + 1, np.int32)
            np.add.at(step, at, 1)
            np.add.at(step, at + windows.length[found], -1)
            hit = np.cumsum(step[:-1]) > 0
            new_text = np.ones(len(hit), bool)
            new_text[1:] = texts.text[1:] != texts.text[:-1]
            first = np.flatnonzero(hit & (new_text | ~np.append(False, hit[:-1])))
            last = np.flatnonzero(hit & (np.append(new_text[1:], True) | ~np.append(hit[1:], False)))
            of = texts.text[first]
            span = pa.StructArray.from_arrays([pa.array(first - texts.first[of]), pa.array(last + 1 - texts.first[of])], ["first", "end"])
            item, which = repeat(windows.item_from[found], windows.item_from[found + 1] - windows.item_from[found])
            pairs = np.unique(np.stack([texts.text[at[which]], windows.item[item]]), axis=1) if len(item) else np.zeros((2, 0), np.int64)
            kept = batch.drop_columns(["text"])
            n_spans, n_items = (np.bincount(t, minlength=batch.num_rows) for t in (of, pairs[0]))
            out = pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(texts.count), _list(span, n_spans), _list(labels.take(pa.array(pairs[1])), n_items)],
                [*kept.schema.names, "n_words", "spans", "items"],
            )
            yield out.filter(pa.array(n_spans > 0)) if only_hits else out

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("text").schema.fields)
    return rows.mapInArrow(find, f"{kept}, n_words long, spans array<struct<first: long, end: long>>, items array<{item_type.simpleString()}>")


def merged(spans: F.Column) -> F.Column:
    """Sorted spans, with those that overlap or touch made one."""
    def add(acc: F.Column, s: F.Column) -> F.Column:
        last = F.element_at(acc, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end"))
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))
        return F.when((F.size(acc) > 0) & (last["end"] >= s["first"]), grown).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<first: bigint, end: bigint>>"), add)


def find_passages(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3, least: int = 100, group_bytes: int = 8_000_000) -> DataFrame:
    """doc_id, n_words, spans, items: one row per row of ``docs``.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored, whatever their names. Words are runs of letters, digits
    and all beyond ASCII, A-Z lower-cased. ``spans`` are the stretches of words (first, end) that lie in any occurrence of an item's
    window, ``items`` the distinct item_ids whose windows occur. A window is ``window`` consecutive words of an item; an item of
    fewer words, but not none, is one window. With ``least`` below 100, a stretch of the window's length counts if at least that
    percentage of the window's shingles stand at their places in it.

    Null and empty texts have no words: as documents they are hit by nothing, as items they have no window. Repeated document
    rows give a row each; rows with equal item_id (null too) are one item with the windows of all. Empty tables: no documents, no
    rows; no items, no hits. Whole texts are scanned, of any length.
    """
    rows = exactly(docs, "doc_id", "text").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    asked = exactly(items, "item_id", "text")
    item_type = asked.schema["item_id"].dataType
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    cut = asked.select(F.struct("item_id").alias("item"), F.regexp_extract_all(lowered, F.lit(WORD), 0).alias("words")).filter("size(words) > 0")
    dealt = written(deal_items(cut.withColumn("term", F.array_join("words", " ")), group_bytes))
    groups = [r.part for r in dealt.select("part").distinct().orderBy("part").collect()]  # one number per group
    several = len(groups) > 1
    if several:  # equal rows have equal finds, so one of them stands for all
        rows = rows.withColumn("_id", F.struct("doc_id")).withColumn("_h1", F.xxhash64("text")).withColumn("_h2", F.sha1("text"))
    found = []
    for part in groups or [0]:
        of_group = sorted(dealt.filter(F.col("part") == part).select("item", "words").collect(), key=lambda r: (str(r.item.item_id), r.words))
        names = list(dict.fromkeys(r.item.item_id for r in of_group))
        number = {name: i for i, name in enumerate(names)}
        found.append(_find(rows, [(number[r.item.item_id], r.words) for r in of_group], names, item_type, window, shingle, least, only_hits=several))
    if not several:
        return found[0]
    key = ["_id", "_h1", "_h2"]
    parts = found[0]
    for more in found[1:]:
        parts = parts.unionByName(more)
    parts = written(parts.select(*key, "spans", "items"))
    together = parts.dropDuplicates([*key, "spans", "items"]).groupBy(*key).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    no_spans, no_items = (F.array().cast(parts.schema[c].dataType) for c in ("spans", "items"))
    counted = _find(rows, [], [], item_type, window, shingle, least, only_hits=False).drop("spans", "items")
    return counted.join(together, key, "left").select(
        "doc_id", "n_words", F.coalesce(merged(F.col("spans")), no_spans).alias("spans"), F.coalesce("items", no_items).alias("items")
    )


def contamination(found: DataFrame) -> DataFrame:
    """Digest of ``find_passages``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["first"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
