"""Removal of byte strings that also start in an earlier document, by prefix-free parsing.

*Parse.* A rolling hash of all ``gram``-byte strings gives the triggers: the trigger of a
``span``-byte string is the smallest hash in it. Consecutive strings with the same
trigger form a phrase. So each string of ``span`` bytes lies in exactly one phrase, and equal
strings have equal triggers wherever they stand. Phrases overlap by span - 1 bytes; with that
overlap the order of suffixes to the depth of ``span`` bytes is decided inside a phrase, and of
the parse only the first symbol counts.

*Dictionary.* Distinct phrases with the smallest document id that holds them: gathered per block
of documents first, then per bucket of triggers. Copies of a passage, however many, are one entry
per block. An occurrence in a later document is a repeat as a whole; a trigger whose phrases
are all first seen in one document needs no more. In highly repetitive text this settles almost everything.

*Corpus order.* Where a trigger has phrases that begin in different documents (the edges of copied
passages, edited copies), the suffixes of those dictionary phrases are sorted; the
occurrences of a phrase stand at its suffixes in the order of the parse. Runs of equal
``span``-byte prefixes in that order give the smallest document id of each string. These are compared byte by byte.

Blocks send one message per bucket and get answers back; the texts are shuffled once (the exchange
is reused) and nothing is gathered beyond a block or a bucket. Triggers that very many different
phrases share are found on a bounded sample; their entries are dealt by phrase, and their suffixes by content,
so that no bucket grows with them. Phrases are told apart by 96 bits or more of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
MIX = U64(0xD6E8FEB86659FD93)
CHUNK = 1 << 18
MESSAGE = "key long, block long, kind int, bucket long, a binary, b binary, c binary, d binary, e binary"
ANSWER, SUFFIXES, FOUND = 0, 1, 2


def _power(e: int) -> np.uint64:
    return U64(pow(BASE, e, 1 << 64))


_VALUES = (lambda h: h ^ h >> U64(29))((np.arange(256, dtype=U64) + U64(1)) * MIX)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> U64(32)
    h *= MIX
    h ^= h >> U64(29)
    return h


def _windows_min(h: np.ndarray, width: int) -> np.ndarray:
    reach, span = h, 1
    while 2 * span <= width:
        reach, span = np.minimum(reach[:-span], reach[span:]), 2 * span
    return np.minimum(reach[: len(h) - width + 1], reach[width - span :][: len(h) - width + 1]) if span < width else reach


def _doublings(data: np.ndarray, most: int) -> dict[int, np.ndarray]:
    """Rolling hashes of all strings of 1, 2, 4, ... bytes, up to ``most``."""
    found, size = {1: _VALUES[data]}, 1
    while 2 * size <= most:
        h = found[size]
        found[2 * size] = h[:-size] * _power(size) + h[size:]
        size *= 2
    return found


def _hash_at(found: dict[int, np.ndarray], at: np.ndarray | slice, length: int) -> np.ndarray:
    """Rolling hash of ``length`` bytes at positions, put together from powers of two."""
    out, shift = None, 0
    for size in sorted(found, reverse=True):
        if length & size:
            part = found[size][at + shift] if isinstance(at, np.ndarray) else found[size][at.start + shift : at.stop + shift]
            out = part if out is None else out * _power(size) + part
            shift += size
    return out


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For group sizes: the group of each member, and its number in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


def stretches(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    edge = np.flatnonzero(np.diff(values, prepend=-1, append=-1)).tolist()
    return zip(edge[:-1], edge[1:], strict=True)


class Block:
    """Phrases of a block of documents, and its part of the dictionary.

    Nothing here depends on the order of rows, so each pass finds the same entries.
    """

    def __init__(self, rows: pa.Table, span: int, gram: int, buckets: int, hot: np.ndarray):
        self.span, self.buckets = span, buckets
        text = rows.column("_bytes").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
        whole = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        self.data, self.ends = whole[ends[0] : ends[-1]] if len(text) else whole[:0], (ends - ends[0]).astype(np.int64)
        ids = rows.column("doc_id").combine_chunks()
        self.null = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0)).astype(np.int64)
        self._parse(gram)
        self._dictionary(hot)

    def _parse(self, gram: int) -> None:
        span, data = self.span, self.data
        row = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.ends))
        starts, lasts, trigger, head, tail = [], [], [], [], []
        before = None  # trigger of the string before the chunk, if that is in one document
        for begin in range(0, len(data) - span + 1, CHUNK):
            stop = min(begin + CHUNK, len(data) - span + 1)
            found = _doublings(data[begin : stop + span - 1], span)
            low = _windows_min(_mix(_hash_at(found, slice(0, stop - begin + span - gram), gram)), span - gram + 1)
            inside = row[begin:stop] == row[begin + span - 1 : stop + span - 1]
            same = np.empty(stop - begin, bool)
            same[1:] = inside[1:] & inside[:-1] & (low[1:] == low[:-1])
            same[0] = before is not None and inside[0] and low[0] == before
            first = np.flatnonzero(inside & ~same)
            if before is not None and not same[0]:
                lasts.append(np.array([begin - 1]))
                tail.append(last_hash)
            last = np.flatnonzero(inside[:-1] & ~same[1:])
            starts.append(first + begin)
            trigger.append(low[first])
            head.append(_hash_at(found, first, span))
            lasts.append(last + begin)
            tail.append(_hash_at(found, last, span))
            before = low[-1] if inside[-1] else None
            last_hash = _hash_at(found, np.array([stop - begin - 1]), span)
        if before is not None:
            lasts.append(np.array([len(data) - span]))
            tail.append(last_hash)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        start, last, trigger, head, tail = join(starts, np.int64), join(lasts, np.int64), join(trigger, U64), join(head, U64), join(tail, U64)
        long = np.flatnonzero(last - start >= span)
        if len(long):  # periodic text: cut so that the first and the last string cover a phrase
            group, nth = _spread((last[long] - start[long]) // span + 1)
            s = start[long][group] + nth * span
            e = np.minimum(s + span - 1, last[long][group])
            keep = np.ones(len(start), bool)
            keep[long] = False
            start, last = np.concatenate((start[keep], s)), np.concatenate((last[keep], e))
            trigger = np.concatenate((trigger[keep], trigger[long][group]))
            head, tail = np.concatenate((head[keep], self.hashes(s))), np.concatenate((tail[keep], self.hashes(e)))
        owner = row[start] if len(start) else np.zeros(0, np.int32)
        keep = ~self.null[owner]
        self.start, self.last, self.trigger, self.row = start[keep], last[keep], trigger[keep], owner[keep]
        self.key = _mix(_mix(head[keep]) * U64(BASE) + tail[keep] * U64(0xC2B2AE3D27D4EB4F) + (self.last - self.start).astype(U64)) ^ self.trigger

    def hashes(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the ``span`` bytes at positions."""
        weights = np.array([pow(BASE, self.span - 1 - j, 1 << 64) for j in range(self.span)], U64)
        out = np.empty(len(at), U64)
        for i in range(0, len(at), 100_000):
            out[i : i + 100_000] = (_VALUES[self.strings(at[i : i + 100_000])] * weights).sum(axis=1, dtype=U64)
        return out

    def strings(self, at: np.ndarray) -> np.ndarray:
        return self.data[at[:, None] + np.arange(self.span)]

    def _dictionary(self, hot: np.ndarray) -> None:
        order = np.argsort(self.key, kind="stable")
        key = self.key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(new)
        ids = self.ids[self.row]
        least = np.minimum.reduceat(ids[order], begin) if len(begin) else np.zeros(0, np.int64)
        sample, trigger = order[begin], self.trigger[order[begin]]
        n = U64(self.buckets)
        bucket = np.where(np.isin(trigger, hot), n + key[begin] % n, (trigger >> U64(32)) % n).astype(np.int64)
        place = np.lexsort((key[begin], bucket))
        self.bucket, self.entry_key, self.entry_trigger, self.least, self.sample = bucket[place], key[begin][place], trigger[place], least[place], sample[place]
        rank = np.empty(len(place), np.int64)
        rank[place] = np.arange(len(place))
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = rank[np.cumsum(new) - 1]

    def at(self, bucket: int, places: np.ndarray) -> np.ndarray:
        """Entries by their places in the message to a bucket."""
        return np.searchsorted(self.bucket, bucket) + places

    def per_bucket(self, bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
        for a, b in stretches(bucket):
            yield int(bucket[a]), slice(a, b)

    def hear(self, answers: pa.Table) -> None:
        """First answers: the corpus-wide smallest id of an entry, and whether its trigger is open."""
        self.open = np.zeros(len(self.least), np.uint8)
        self.block_least = self.least.copy()
        for m in messages(answers, ANSWER):
            entries = self.at(m["bucket"], np.frombuffer(m["a"], np.uint32).astype(np.int64))
            self.least[entries] = np.frombuffer(m["b"], np.int64)
            self.open[entries] = np.frombuffer(m["c"], np.uint8)
        # Strings of open entries with a hot trigger, each once.
        entries = np.flatnonzero((self.open > 0) & (self.bucket >= self.buckets))
        group, nth = _spread(self.last[self.sample[entries]] - self.start[self.sample[entries]] + 1)
        at = self.start[self.sample[entries]][group] + nth
        keys, first, which = np.unique(self.hashes(at), return_index=True, return_inverse=True)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(least, which, self.least[entries][group])
        bucket = (U64(2 * self.buckets) + keys % U64(self.buckets)).astype(np.int64)
        place = np.lexsort((keys, bucket))
        rank = np.empty(len(place), np.int64)
        rank[place] = np.arange(len(place))
        self.hot_bucket, self.hot_key, self.hot_at, self.hot_least = bucket[place], keys[place], at[first][place], least[place]
        self.hot_entry, self.hot_nth, self.hot_which = entries[group], nth, rank[which]

    def repeats(self, found: pa.Table) -> np.ndarray:
        """Which bytes are covered by a string that starts in an earlier document."""
        ids = self.ids[self.row]
        whole = ids > self.least[self.entry]
        first, last = [self.start[whole]], [self.last[whole]]
        entry, a, b, least = [], [], [], []
        hot = np.full(len(self.hot_key), np.iinfo(np.int64).max)
        for m in messages(found, FOUND):
            places = np.frombuffer(m["a"], np.uint32).astype(np.int64)
            ids_found = np.frombuffer(m["d"], np.int64)
            if m["bucket"] >= 2 * self.buckets:
                hot[np.searchsorted(self.hot_bucket, m["bucket"]) + places] = ids_found
                continue
            entry.append(self.at(m["bucket"], places))
            a.append(np.frombuffer(m["b"], np.uint32).astype(np.int64))
            b.append(np.frombuffer(m["c"], np.uint32).astype(np.int64))
            least.append(ids_found)
        hit = np.minimum(hot, self.hot_least)[self.hot_which] if len(self.hot_which) else np.zeros(0, np.int64)
        entry, a, b, least = (np.concatenate(x) for x in ([*entry, self.hot_entry], [*a, self.hot_nth], [*b, self.hot_nth], [*least, hit]))
        by_entry = np.argsort(self.entry, kind="stable")
        held = np.bincount(self.entry, minlength=len(self.least))
        begin = np.cumsum(held) - held
        group, nth = _spread(held[entry])
        phrase = by_entry[begin[entry][group] + nth] if len(group) else np.zeros(0, np.int64)
        later = ids[phrase] > least[group]
        first.append(self.start[phrase[later]] + a[group[later]])
        last.append(self.start[phrase[later]] + b[group[later]])
        n = len(self.data) + 1
        change = np.bincount(np.concatenate(first), minlength=n) - np.bincount(np.concatenate(last) + self.span, minlength=n)
        return np.cumsum(change)[: len(self.data)] > 0


def messages(table: pa.Table, kind: int) -> Iterator[dict]:
    for m in table.to_pylist():
        if m["kind"] == kind:
            yield m


def to_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    names = ["key", "block", "kind", "bucket", "a", "b", "c", "d", "e"]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _gather(rows: list[dict], name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """A column of arrays as one array, and the number of the message of each item."""
    parts = [np.frombuffer(m[name] or b"", kind) for m in rows]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def settle_dictionary(rows: list[dict], buckets: int) -> list[tuple]:
    """Answers of a bucket: entries with an earlier id elsewhere, and those of open triggers."""
    trigger, message = _gather(rows, "a", np.uint32)
    key, _ = _gather(rows, "b", U64)
    ids, _ = _gather(rows, "c", np.int64)
    place = np.concatenate([np.arange(len(np.frombuffer(m["a"], np.uint32))) for m in rows])
    order = np.lexsort((ids, key, trigger))
    t, k = trigger[order], key[order]
    family = np.ones(len(t), bool)
    family[1:] = t[1:] != t[:-1]
    phrase = family.copy()
    phrase[1:] |= k[1:] != k[:-1]
    least = ids[order][phrase]  # ids are sorted inside a phrase
    of_phrase = np.cumsum(phrase) - 1
    begin = np.flatnonzero(family[phrase])
    low, high = np.minimum.reduceat(least, begin), np.maximum.reduceat(least, begin)
    is_open = (low != high)[np.cumsum(family[phrase]) - 1][of_phrase]
    bucket = rows[0]["bucket"]
    if bucket >= buckets:  # hot triggers are spread over buckets: always open
        is_open[:] = True
    flag = is_open.astype(np.uint8) + (is_open & phrase).astype(np.uint8)  # 2: this block sends the phrase
    best = least[of_phrase]
    told = (best < ids[order]) | is_open
    order, flag, best = order[told], flag[told], best[told]
    by_block = np.argsort(message[order], kind="stable")
    order, flag, best = order[by_block], flag[by_block], best[by_block]
    out = []
    for a, b in stretches(message[order]):
        block = rows[message[order[a]]]["block"]
        out.append((block, block, ANSWER, bucket, place[order[a:b]].astype(np.uint32).tobytes(), best[a:b].tobytes(), flag[a:b].tobytes(), None, None))
    return out


def suffix_order(data: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their ``span`` bytes, and where a new string begins in that order."""
    wide = -(-span // 8) * 8
    strings = np.zeros((len(at), wide), np.uint8)
    strings[:, :span] = data[at[:, None] + np.arange(span)]
    words = np.ascontiguousarray(strings.view(">u8").T.astype(U64))
    order = np.lexsort(words[::-1])
    new = np.ones(len(at), bool)
    new[1:] = (words[:, order[1:]] != words[:, order[:-1]]).any(axis=0)
    return order, new


def sort_suffixes(rows: list[dict], span: int) -> list[tuple]:
    """Smallest id of each string of the bucket's phrases; told to all blocks with the phrase if it beats the phrase's own."""
    key, message = _gather(rows, "a", U64)
    place, _ = _gather(rows, "b", np.uint32)
    own, _ = _gather(rows, "c", np.uint8)
    sent, least = key[own > 0], np.concatenate([np.frombuffer(m["d"] or b"", np.int64) for m in rows])
    lengths = np.concatenate([np.frombuffer(m["e"] or b"", np.uint16, count=int((np.frombuffer(m["c"], np.uint8) > 0).sum())) for m in rows]).astype(np.int64)
    data = np.concatenate([np.frombuffer(m["e"] or b"", np.uint8)[2 * int((np.frombuffer(m["c"], np.uint8) > 0).sum()) :] for m in rows])
    if not len(sent):
        return []
    phrase, nth = _spread(lengths - span + 1)
    at = (np.cumsum(lengths) - lengths)[phrase] + nth
    order, new = suffix_order(data, at, span)
    best = np.empty(len(at), np.int64)
    best[order] = np.minimum.reduceat(least[phrase][order], np.flatnonzero(new))[np.cumsum(new) - 1]
    hit = best < least[phrase]
    start = hit.copy()
    start[1:] &= ~(hit[:-1] & (phrase[1:] == phrase[:-1]) & (best[1:] == best[:-1]))
    stop = hit.copy()
    stop[:-1] &= ~(hit[1:] & (phrase[1:] == phrase[:-1]) & (best[1:] == best[:-1]))
    of, first, last, ids = phrase[start], nth[start], nth[stop], best[start]
    # Runs of each phrase go to every block that has asked for it.
    by_key = np.argsort(sent, kind="stable")
    wanted = np.minimum(np.searchsorted(sent[by_key], key), len(sent) - 1)
    target = np.where(own > 0, np.cumsum(own > 0) - 1, np.where(sent[by_key][wanted] == key, by_key[wanted], -1))
    runs = np.bincount(of, minlength=len(sent))
    begin = np.cumsum(runs) - runs
    count = np.where(target >= 0, runs[target], 0)
    ask, k = _spread(count)
    run = begin[target[ask]] + k
    out = []
    for a, b in stretches(message[ask]):
        m, r = rows[message[ask[a]]], run[a:b]
        out.append((m["block"], m["block"], FOUND, m["bucket"], place[ask[a:b]].tobytes(), first[r].astype(np.uint32).tobytes(), last[r].astype(np.uint32).tobytes(), ids[r].tobytes(), None))
    return out


def hot_triggers(docs: DataFrame, n_docs: int, span: int, gram: int, sample_docs: int, share: float) -> np.ndarray:
    """Triggers with different phrases in more than ``share`` of about ``sample_docs`` documents."""
    chosen = docs.filter(F.xxhash64("doc_id", F.lit("hot")).bitwiseAND(F.lit(0xFFFFFF)) / float(1 << 24) * n_docs < sample_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = Block(pa.Table.from_batches([batch]), span, gram, 1, np.zeros(0, U64))
            trigger, n = np.unique(block.entry_trigger, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(trigger.view(np.int64)), pa.array(n.astype(np.int64))], ["trigger", "n"])

    least = max(2.0, share * min(n_docs, sample_docs))
    found = chosen.select("doc_id", "_bytes").mapInArrow(count, "trigger long, n long").groupBy("trigger").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return np.array([r.trigger for r in found.select("trigger").collect()], np.int64).view(U64)


def remove_repeats(
    docs: DataFrame, span: int = 50, gram: int = 20, block_bytes: int = 4_000_000, bucket_entries: int = 400_000,
    sample_docs: int = 5_000, hot_share: float = 0.005, keep_text: bool = False,
) -> DataFrame:
    """All columns of ``docs`` but text, and n_bytes, n_removed, n_spans, kept_sha256, spans.

    ``docs`` needs doc_id (a whole number) and text. Each byte goes that a ``span``-byte string covers which also starts in
    a document with a smaller id; strings are judged on the input and never cross documents.
    ``spans`` lists the maximal removed runs (first byte, end). With ``keep_text``, ``text`` holds what is left (a character cut
    in two is left out). Null texts are empty; texts shorter than ``span`` lose nothing. A null id is
    neither smaller nor larger than another: such rows lose nothing and remove nothing.
    Rows with equal ids do not remove from each other. Extra columns are carried, whatever
    their names. An empty table gives no rows. ``block_bytes``, ``bucket_entries``, ``sample_docs`` and
    ``hot_share`` change the plan, never the result.
    """
    carried = [c for c in docs.columns if c not in ("doc_id", "text")]
    extra = [F.col(f"`{c}`").alias(f"_carried_{i}") for i, c in enumerate(carried)]
    texts = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", texts.alias("_bytes"), *extra)
    n_docs, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col("text").cast("string")))).first()
    n_bytes = n_bytes or 0
    blocks = max(1, -(-n_bytes // block_bytes))
    buckets = max(1, -(-n_bytes // (16 * bucket_entries)))
    hot = docs.sparkSession.sparkContext.broadcast(hot_triggers(rows, max(n_docs, 1), span, gram, sample_docs, hot_share))

    dealt = rows.withColumn("_block", F.pmod(F.xxhash64("doc_id", "_bytes"), F.lit(blocks)))

    def block_of(table: pa.Table) -> Block:
        return Block(table, span, gram, buckets, hot.value)

    def tell(key: tuple, table: pa.Table) -> pa.Table:
        block = block_of(table)
        return to_table([
            (bucket, key[0].as_py(), ANSWER, bucket, block.entry_trigger[s].astype(np.uint32).tobytes(), block.entry_key[s].tobytes(), block.least[s].tobytes(), None, None)
            for bucket, s in block.per_bucket(block.bucket)
        ])

    def settle(table: pa.Table) -> pa.Table:
        return to_table(settle_dictionary(table.to_pylist(), buckets))

    def send(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return to_table([])
        number, block = key[0].as_py(), block_of(table)
        block.hear(answers)
        out = [(-1 - number, number, ANSWER, m["bucket"], m["a"], m["b"], m["c"], None, None) for m in messages(answers, ANSWER)]
        entries = np.flatnonzero((block.open > 0) & (block.bucket < buckets))
        for bucket, s in block.per_bucket(block.bucket[entries]):
            mine = entries[s]
            own = (block.open[mine] == 2).astype(np.uint8)
            phrase = block.sample[mine[own > 0]]
            begin, end = block.start[phrase], block.last[phrase] + span
            data = b"".join(block.data[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True))
            places = (mine - np.searchsorted(block.bucket, bucket)).astype(np.uint32)
            out.append((bucket, number, SUFFIXES, bucket, block.entry_key[mine].tobytes(), places.tobytes(), own.tobytes(), block.least[mine[own > 0]].tobytes(), (end - begin).astype(np.uint16).tobytes() + data))
        for bucket, s in block.per_bucket(block.hot_bucket):
            n = s.stop - s.start
            data = np.full(n, span, np.uint16).tobytes() + block.strings(block.hot_at[s]).tobytes()
            out.append((bucket, number, SUFFIXES, bucket, block.hot_key[s].tobytes(), np.arange(n, dtype=np.uint32).tobytes(), np.ones(n, np.uint8).tobytes(), block.hot_least[s].tobytes(), data))
        return to_table(out)

    def order(table: pa.Table) -> pa.Table:
        messages_in = table.to_pylist()
        if messages_in[0]["key"] < 0:  # answers on their way to their own block
            return to_table([(m["block"], m["block"], ANSWER, m["bucket"], m["a"], m["b"], m["c"], None, None) for m in messages_in])
        return to_table(sort_suffixes(messages_in, span))

    out_schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first long, end long>>, "
        "text string" + "".join(f", _carried_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carried))
    )

    def apply(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        block = block_of(table)
        block.hear(found)
        gone = block.repeats(found)
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        total = np.concatenate(([0], np.cumsum(gone)))
        spans, removed, digests, texts = [], [], [], []
        for a, b in zip(block.ends[:-1].tolist(), block.ends[1:].tolist(), strict=True):
            n = int(total[b] - total[a])
            kept = block.data[a:b]
            if n:
                # Repeats of neighbouring documents may touch in the block; a document's own begin and end at its edges.
                inner = edge[np.searchsorted(edge, a, "right") : np.searchsorted(edge, b)].tolist()
                marks = [a] * bool(gone[a]) + inner + [b] * bool(gone[b - 1])
                spans.append([{"first": x - a, "end": y - a} for x, y in zip(marks[::2], marks[1::2], strict=True)])
                kept = kept[~gone[a:b]]
            else:
                spans.append([])
            removed.append(n)
            kept = kept.tobytes()
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode("utf-8", "ignore") if keep_text else None)
        columns = [
            table.column("doc_id").cast(pa.int64()), pa.array(np.diff(block.ends)), pa.array(removed, pa.int64()), pa.array([len(s) for s in spans], pa.int64()),
            pa.array(digests, pa.string()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(texts, pa.string()),
            *[table.column(f"_carried_{i}") for i in range(len(carried))],
        ]
        return pa.Table.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text", *[f"_carried_{i}" for i in range(len(carried))]])

    told = dealt.groupBy("_block").applyInArrow(tell, MESSAGE)
    answers = told.groupBy("key").applyInArrow(settle, MESSAGE)
    sent = dealt.groupBy("_block").cogroup(answers.groupBy("key")).applyInArrow(send, MESSAGE)
    found = sent.groupBy("key").applyInArrow(order, MESSAGE)
    out = dealt.groupBy("_block").cogroup(found.groupBy("key")).applyInArrow(apply, out_schema)
    names = [F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carried)]
    return out.select("doc_id", *(["text"] if keep_text else []), *names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
