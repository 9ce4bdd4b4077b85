"""Packing documents into windows of token ids by best-fit decreasing.

A document's ids are first cut into full windows; the rest (shorter than a window) is packed
with other rests: longest first, each into the open window with the least room that still
holds it, found by a segment tree over the remaining room. Every task packs what it has read,
in groups of bounded size, so nothing is shuffled; only the pieces of windows left with more
than ``slack`` free ids are dealt anew and packed a second time. What is loose even then is
poured into full windows, and its last rest is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exactly, whole_text, written
from .token_counts import ALPHABET, is_latin_1, latin_class

GROUP_PIECES = 16_384
GROUP_BYTES = 48_000_000
CACHE = 200_000
_BEYOND = re.compile("[İɐ-\U0010ffff]")


class _Cache(dict):
    """Ids of one pre-token as little-endian unsigned 32-bit bytes, found once."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHE:
            self.clear()
        ids = pack_ids([t.id for t in self.encode(word.encode().decode("latin-1").translate(ALPHABET))])
        self[word] = ids
        return ids


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Ids:
    """All ids of a text, equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letter, digit, space = latin_class(r"\p{L}"), latin_class(r"\p{N}"), latin_class(r"\p{White_Space}")
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^{space}{letter}{digit}]+")
        self.cache = _Cache(self.tokenizer.model.tokenize)
        # The short way holds for this kind of file only: lower-cased, white space dropped, cut by the pattern above.
        probe = "It's  A1 12\tß don'T ?!x² ÀÉ <|x"
        self.short = self._short(probe) == self._long(probe)

    def _short(self, text: str) -> bytes | None:
        """Pre-tokens of a Latin text are looked up one by one; None if it holds anything else."""
        low = text.lower()
        if not is_latin_1(text) and (_BEYOND.search(text) or _BEYOND.search(low)):
            return None
        return b"".join(map(self.cache.__getitem__, self.words.findall(low)))

    def _long(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        if self.short and not ("<" in text and any(s in text for s in self.special)):
            if (ids := self._short(text)) is not None:
                return ids
        return self._long(text)


@lru_cache(maxsize=4)
def ids_of(name: str) -> Ids:
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Ids(name)


class RoomTree:
    """Segment tree over 0..window: which amounts of room some open window has."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``least``; it leaves the tree."""
        node = least + self.size
        while not self.count[node]:  # up, until something lies to the right
            while node & 1:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.size:  # down to the leftmost
            node *= 2
            if not self.count[node]:
                node += 1
        room = node - self.size
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of positions in ``lengths`` (each 1..window)."""
    tree, windows = RoomTree(window), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if (found := tree.take(lengths[i])) is None:
            room, w = window, len(windows)
            windows.append([])
        else:
            room, w = found
        windows[w].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], w)
    return windows


# A piece: (doc_id, start, doc_tokens, ids).
Piece = tuple[object, int, int, bytes]


def pour(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """Pieces one after the other into full windows; the last rest into windows of 2^k ids."""
    total = sum(len(p[3]) // 4 for p in pieces)
    rest = total % window
    sizes = [window] * (total // window) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    queue, out = list(reversed(pieces)), []
    for size in sizes:
        filled: list[Piece] = []
        while size:
            doc_id, start, tokens, ids = queue.pop()
            n = min(size, len(ids) // 4)
            filled.append((doc_id, start, tokens, ids[: 4 * n]))
            if 4 * n < len(ids):
                queue.append((doc_id, start + n, tokens, ids[4 * n :]))
            size -= n
        out.append(filled)
    return out


class _Writer:
    """Rows of packed windows, in batches of bounded size."""

    def __init__(self, kind: pa.DataType, window: int, first: int):
        self.kind, self.window, self.next, self.rows, self.bytes = kind, window, first, [], 0

    def put(self, pieces: list[Piece], settled: bool) -> None:
        used = sum(len(p[3]) // 4 for p in pieces)
        length = used if used & (used - 1) == 0 else self.window
        offset = 0
        for doc_id, start, tokens, ids in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, tokens, self.next, offset, length, settled, ids))
            self.bytes += len(ids)
            offset += n
        self.next += 1

    def ready(self) -> bool:
        return self.bytes > 4_000_000

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[]] * 9
        self.rows, self.bytes = [], 0
        kinds = [self.kind, *[pa.int64()] * 6, pa.bool_(), pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "padded_to", "settled", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _close(group: list[Piece], out: _Writer, slack: int, last: bool) -> None:
    """Pack a group of rests. Loose windows stay unsettled, or are poured if this is the last pass."""
    loose: list[Piece] = []
    for members in best_fit_decreasing([len(p[3]) // 4 for p in group], out.window):
        pieces = [group[i] for i in members]
        used = sum(len(p[3]) // 4 for p in pieces)
        fits = out.window - used <= slack or used & (used - 1) == 0
        if last and not fits:
            loose += pieces
        else:
            out.put(pieces, fits)
    for pieces in pour(loose, out.window):
        out.put(pieces, True)
    group.clear()


def pack(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", window: int = 2048, end_id: int = 1, slack: int = 16
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, padded_to, ids.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. A document
    is its ids and ``end_id``; null and empty texts are ``end_id`` alone. Repeated rows and
    ids are packed each on their own. ``ids`` holds little-endian unsigned 32-bit ids.
    ``padded_to`` is the length of the sequence with padding: ``window``, or what it holds if that
    is a power of two. An empty table gives no rows.
    """
    rows = exactly(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, padded_to long, settled boolean, ids binary"
    )
    end = pack_ids([end_id])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, group, size, out = ids_of(tokenizer), [], 0, None
        for batch in batches:
            out = out or _Writer(batch.schema.field("doc_id").type, window, TaskContext.get().partitionId() << 32)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                full = n - n % window
                for at in range(0, full, window):
                    out.put([(doc_id, at, n, ids[4 * at : 4 * (at + window)])], True)
                if full < n:
                    group.append((doc_id, full, n, ids[4 * full :]))
                    size += 4 * (n - full)
                if len(group) >= GROUP_PIECES or size > GROUP_BYTES:
                    _close(group, out, slack, last=False)
                    size = 0
                if out.ready():
                    yield out.batch()
        if out:
            _close(group, out, slack, last=False)
            encode.cache.clear()  # workers live on for other tasks
            yield out.batch()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size, out = [], 0, None
        for batch in batches:
            out = out or _Writer(batch.schema.field("doc_id").type, window, 1 << 62 | TaskContext.get().partitionId() << 32)
            for piece in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                group.append(piece)
                size += len(piece[3])
                if len(group) >= GROUP_PIECES or size > GROUP_BYTES:
                    _close(group, out, slack, last=True)
                    size = 0
            if out.ready():
                yield out.batch()
        if out:
            _close(group, out, slack, last=True)
            yield out.batch()

    packed = written(rows.mapInArrow(first, schema))
    loose = packed.filter(~F.col("settled"))
    held = loose.agg(F.count(F.lit(1)), F.sum("length")).first()
    parts = max(1, -(-held[0] // GROUP_PIECES), -(-4 * (held[1] or 0) // GROUP_BYTES))
    again = loose.repartition(parts, "sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(second, schema)
    return packed.filter("settled").unionByName(again).drop("settled")
