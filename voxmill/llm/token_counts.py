"""Token counts: pieces are counted once per distinct pre-token.

1. Every task splits its texts into pre-tokens and counts them; one row per distinct
   pre-token and task is shuffled. The distinct ones are cut into pieces once.
2. Texts are split again. The ``frequent`` most common pre-tokens are known to every task
   (a bounded table), so a text is left with its rare ones, which are joined to their piece
   counts by an ordinary shuffle. A rare pre-token holds at most 1/frequent of all occurrences.

No list of token ids of a text is ever built.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exactly, whole_text, written

# Fixed value: the split pattern of byte-level BPE with use_regex, as published with the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Distinct pre-tokens a task holds before it hands its counts on.
FLUSH = 300_000


def latin_class(pattern: str) -> str:
    """The characters below U+0250 of a class, to stand in brackets. They are the same in every Unicode version."""
    return "".join(re.escape(c) for c in map(chr, range(0x250)) if regex.fullmatch(pattern, c))


def _latin_split() -> re.Pattern:
    """``SPLIT`` for texts of Latin letters."""
    letter, digit, space = latin_class(r"\p{L}"), latin_class(r"\p{N}"), latin_class(r"\p{White_Space}")
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


_OTHER = re.compile(r"[^\x00-ɏ]")


# Byte-level alphabet, by its rule: visible Latin-1 characters stand for themselves, the other bytes follow from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
ALPHABET = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


def is_latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Splitter:
    """Pre-tokens of a text exactly as the tokenizer file defines them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content: 1 for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.model = self.tokenizer.model
        self.latin = _latin_split()
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens in order, and the number of added tokens that stand in the text."""
        if self.cut is None or "<" not in text and not self.cut.search(text):
            return self._split(text), 0
        found, start, added = [], 0, 0
        for match in self.cut.finditer(text):
            found += self._split(text[start : match.start()])
            start, added = match.end(), added + 1
        return found + self._split(text[start:]), added

    def _split(self, text: str) -> list[str]:
        if is_latin_1(text) or not _OTHER.search(text):
            return self.latin.findall(text)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in pieces]

    def pieces(self, pre_token: str) -> int:
        mapped = pre_token.encode().decode("latin-1").translate(ALPHABET)
        return len(self.model.tokenize(mapped))


@lru_cache(maxsize=4)
def splitter(name: str) -> Splitter:
    """``name``: a file of the public tokenizers, or a path that every executor has."""
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Splitter(name)


def check_kind(name: str) -> None:
    """Counting by pre-token needs byte-level BPE whose pre-tokens are cut by the published pattern."""
    import json

    tokenizer = json.loads(splitter(name).tokenizer.to_str())
    cut = tokenizer["pre_tokenizer"] or {}
    if tokenizer["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space"):
        raise ValueError(f"{name}: only byte-level BPE without normalizer and prefix space is supported")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokenizer["added_tokens"]):
        raise ValueError(f"{name}: added tokens that take the space around them are not supported")


def pre_token_totals(texts: DataFrame, tokenizer: str) -> DataFrame:
    """pre_token, occurrences: over all whole ``text`` values."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, totals = splitter(tokenizer).pre_tokens, Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], ["pre_token", "occurrences"])

        for batch in batches:
            for text in batch.column(0):
                totals.update(split(text.as_py())[0])
                if len(totals) > FLUSH:
                    yield out()
                    totals.clear()
        if totals:
            yield out()

    return texts.mapInArrow(count, "pre_token string, occurrences long").groupBy("pre_token").agg(F.sum("occurrences").alias("occurrences"))


def with_pieces(totals: DataFrame, tokenizer: str) -> DataFrame:
    """Adds ``pieces``, the number of tokens of each distinct pre-token."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = splitter(tokenizer).pieces
        for batch in batches:
            yield batch.append_column("pieces", pa.array([pieces(p) for p in batch.column(0).to_pylist()], pa.int32()))

    return totals.mapInArrow(cut, "pre_token string, occurrences long, pieces int")


def least_occurrences(vocabulary: DataFrame, most: int) -> int:
    """The smallest count that at most ``most`` pre-tokens reach, on a scale of eight steps for each doubling: a histogram, nothing is sorted."""
    step = F.floor(F.log2("occurrences") * 8).cast("int").alias("step")
    held = 0
    steps = vocabulary.groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min("occurrences").alias("least")).collect()  # some hundred at most
    least = 2**62
    for s in sorted(steps, key=lambda s: -s.step):
        held += s.n
        if held > most:
            break
        least = s.least
    return least


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, frequent: int = 262_144) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. Null and
    empty texts have 0 bytes and 0 tokens. Repeated rows and repeated or null ids give one row
    each. Added tokens that stand in a text count as one token each, as by the library's default.
    ``frequent`` bounds the table known to every task; it changes the plan, never the counts.
    """
    check_kind(tokenizer)
    rows = exactly(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    vocabulary = written(with_pieces(pre_token_totals(rows.select("text"), tokenizer), tokenizer))
    least = least_occurrences(vocabulary, frequent)
    common = {r.pre_token: r.pieces for r in vocabulary.filter(F.col("occurrences") >= least).select("pre_token", "pieces").toLocalIterator()}
    known = docs.sparkSession.sparkContext.broadcast(common)

    def sum_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces = splitter(tokenizer).pre_tokens, known.value.get
        for batch in batches:
            tokens, rare, times, offsets = [], [], [], [0]
            for text in batch.column("text"):
                found, total = split(text.as_py())
                for pre_token, n in Counter(found).items():
                    if (k := pieces(pre_token)) is None:
                        rare.append(pre_token)
                        times.append(n)
                    else:
                        total += k * n
                tokens.append(total)
                offsets.append(len(rare))
            entries = pa.StructArray.from_arrays([pa.array(rare, pa.string()), pa.array(times, pa.int64())], ["pre_token", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(pc.binary_length(batch.column("text")), pa.int64()), pa.array(tokens, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)],
                ["doc_id", "n_bytes", "known", "rare"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    per_doc = written(rows.mapInArrow(sum_known, f"doc_id {kind}, n_bytes long, known long, rare array<struct<pre_token string, times long>>"))
    per_doc = per_doc.withColumn("_row", F.monotonically_increasing_id())  # of the written files: the same in both branches
    missing = (
        per_doc.select("_row", F.inline("rare"))
        .join(vocabulary.select("pre_token", "pieces"), "pre_token")
        .select("_row", (F.col("times") * F.col("pieces")).alias("known"))
    )
    whole = per_doc.select("_row", "known", F.struct("doc_id", "n_bytes").alias("_doc"))
    parts = whole.unionByName(missing.withColumn("_doc", F.lit(None).cast(whole.schema["_doc"].dataType)))
    return (
        parts.groupBy("_row").agg(F.first("_doc", ignorenulls=True).alias("_doc"), F.sum("known").alias("n_tokens"))
        .select("_doc.doc_id", "_doc.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
