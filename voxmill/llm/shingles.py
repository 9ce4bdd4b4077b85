"""Word n-gram sets of texts as sorted arrays of 64-bit hashes, computed on whole batches of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)
MIX = U64(0xD6E8FEB86659FD93)
_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_SPACE = np.isin(_BYTE, [0x20, *range(0x09, 0x0E)])
PIECE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> U64(32)
    h = h * MIX
    h ^= h >> U64(29)
    h *= STEP
    return h ^ h >> U64(32)


_EXACT = np.where(_SPACE, U64(0), mix(_BYTE.astype(U64) + U64(1)))
_VALUES = _EXACT[_LOWER]


def _powers(n: int) -> np.ndarray:
    out = np.full(n, STEP, U64)
    out[0] = 1
    return np.cumprod(out)


def words(data: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word; texts are ``data`` between neighbouring ``ends``."""
    values = _VALUES if lower else _EXACT
    if not len(data):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    start = ~space
    start[1:] &= space[:-1] | edge[1:-1]
    stop = ~space
    stop[:-1] &= space[1:] | edge[1:-1]
    start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
    length = stop - start
    out = np.empty(len(start), U64)
    at = 0
    while at < len(start):  # pieces end where a word begins, so memory stays bounded for long texts
        upto = max(at + 1, int(np.searchsorted(start, start[at] + PIECE)))
        begin = start[at:upto] - start[at]
        piece = data[start[at] : stop[upto - 1]]
        power = _powers(int(length[at:upto].max()))
        place = np.arange(len(piece)) - np.repeat(begin, np.diff(begin, append=len(piece)))
        out[at:upto] = np.add.reduceat(values[piece] * power[np.minimum(place, len(power) - 1)], begin)
        at = upto
    return mix(out + length.astype(U64) * MIX), np.searchsorted(ends, start, side="right") - 1


def shingle_sets(data: np.ndarray, ends: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Distinct ``n``-word shingles of each text, sorted; of a shorter text its whole sequence; empty without words."""
    word, text = words(data, ends)
    count = np.bincount(text, minlength=len(ends) - 1)
    begin = np.cumsum(count) - count
    h = np.zeros(max(len(word) - n + 1, 0), U64)
    for j in range(n):
        h = h * STEP + word[j : j + len(h)]
    h = mix(h)
    for b, c in zip(begin.tolist(), count.tolist(), strict=True):
        if c >= n:
            found = np.sort(h[b : b + c - n + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif c:
            whole = U64(c)
            with np.errstate(over="ignore"):
                for w in word[b : b + c]:
                    whole = whole * STEP + w
            yield mix(np.array([whole], U64))
        else:
            yield np.zeros(0, U64)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of strings or binaries without nulls, and the ends of its values."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]
