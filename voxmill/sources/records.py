"""Records of quoted CSV files whose fields hold line breaks, read by as many tasks as the files have splits.

Whether a line begins inside a quoted field depends on all that is before it. So each split first says what becomes of either
state from its first line to its last (one small row per split); a scan over those rows gives the state that each split begins with. Then
every split cuts its lines into records by itself. A record that goes on in the next split leaves two or more fragments,
which are put together by file and split; nothing else is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

WHOLE, CONTINUED, OPEN = 0, 1, 2
_CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')


def inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``. A quote opens a field only at its beginning; doubled quotes are text."""
    at = 0
    if inside:
        closed = _CLOSE.match(line)
        if closed is None:
            return True
        at = closed.end()
    elif line.startswith('"'):
        closed = _CLOSE.match(line, 1)
        if closed is None:
            return True
        at = closed.end()
    while (at := line.find(',"', at)) >= 0:
        closed = _CLOSE.match(line, at + 2)
        if closed is None:
            return True
        at = closed.end()
    return False


def lines_of(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """value, _path, _time, _block: the lines of text files, batch or stream, and the split that each is of."""
    places = ("file_path", "file_modification_time", "file_block_start")
    names = ("_path", "_time", "_block")
    return reader.option("lineSep", "\n").text(path).select("value", *(F.col(f"_metadata.{p}").alias(n) for p, n in zip(places, names, strict=True)))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """Lines as they come, with the (path, time, block) they are of; a split's lines follow each other."""
    for batch in batches:
        path, time, block = (batch.column(c).to_pylist() for c in ("_path", "_time", "_block"))
        values, begin = batch.column("value").to_pylist(), 0
        for i in range(1, batch.num_rows + 1):
            if i == batch.num_rows or (block[i], path[i]) != (block[begin], path[begin]):
                yield (path[begin], time[begin], block[begin]), values[begin:i]
                begin = i


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_path, _time, _block, n (lines), from_outside, from_inside: the state after a split for either state before it; returns: the file's first line ends with \\r\\n."""
    kinds = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
    names = ["_path", "_time", "_block", "n", "from_outside", "from_inside", "returns"]
    split, states, returns, n = None, [False, True], False, 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*split, n, *states, returns), kinds, strict=True)], names)

    for now, lines in _by_split(batches):
        if now != split:
            if split is not None:
                yield out()
            split, states, returns, n = now, [False, True], now[2] == 0 and lines[0].endswith("\r"), 0
        n += len(lines)
        for line in lines:
            if '"' in line:
                states = [inside_after(line, s) for s in states]
    if split is not None:
        yield out()


class Splits(NamedTuple):
    """``inside``: (path, block) of the splits whose first line is inside a quoted field; ``first``: number of the first line of each split;
    ``returns``: files whose lines end with \\r\\n; ``broken``: whether any record goes on beyond its split, or is never closed."""

    inside: set[tuple[str, int]]
    first: dict[tuple[str, int], int]
    returns: set[str]
    broken: bool


def states_of_splits(lines: DataFrame, by_time: bool = False) -> Splits:
    """One small row per split of some 100 MB comes to the driver. Lines are numbered by file (path, or time and path) and by place in it."""
    effects = lines.mapInArrow(_effects, "_path string, _time timestamp, _block long, n long, from_outside boolean, from_inside boolean, returns boolean").collect()
    inside, first, returns, broken, line, path, state = set(), {}, set(), False, 0, None, False
    for e in sorted(effects, key=lambda e: (*([e._time] if by_time else []), e._path, e._block)):
        if e._path != path:
            path, broken, state = e._path, broken or state, False
        if state:
            inside.add((path, e._block))
        if e.returns:
            returns.add(path)
        first[path, e._block] = line
        line += e.n
        state = e.from_inside if state else e.from_outside
    return Splits(inside, first, returns, broken or state or bool(inside))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files (``records_of``)."""
    return records_of(lines_of(spark.read, path))


def records_of(lines: DataFrame, by_time: bool = False) -> DataFrame:
    """record, _path, _time, _block, _stitched, _place: the records of CSV files without their header lines, as text.

    Lines end with ``\\n``, or with ``\\r\\n`` where the first one does (which then is ``\\n`` inside quotes too); blank lines are left out. Records of a split come in
    order within their partition. A record that goes on beyond its split comes apart from the others, with ``_stitched``, as the last of the split it begins in.
    ``_place`` is unique and ascends by file (path, or time and path) and by record; it has gaps where records have several lines.
    """
    found_at = states_of_splits(lines, by_time)
    splits = lines.sparkSession.sparkContext.broadcast(found_at)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        split, inside, header, waiting, place = None, False, False, [], 0

        def keep(kind: int) -> None:
            nonlocal header, waiting, place
            text = "\n".join(waiting)
            waiting = []
            place += 1
            if header and kind != CONTINUED:
                header = False
                if kind == OPEN:
                    rows.append((None, *split, kind, place))  # a header that goes on: its rest is left out too
            elif kind != WHOLE or text.strip():
                rows.append((text, *split, kind, place))

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            kinds = [pa.string(), pa.string(), time_type, pa.int64(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["record", "_path", "_time", "_block", "kind", "_place"])

        time_type = pa.timestamp("us", "UTC")
        for now, found in _by_split(batches):
            if now != split:
                if waiting:
                    keep(CONTINUED if continued else OPEN)
                key = now[0], now[2]
                split, inside, header, place = now, key in splits.value.inside, now[2] == 0, splits.value.first[key] - 1
                continued, returns = inside, now[0] in splits.value.returns
            for line in found:
                waiting.append(line.removesuffix("\r") if returns else line)
                if '"' in line:
                    inside = inside_after(line, inside)
                if not inside:
                    keep(CONTINUED if continued else WHOLE)
                    continued = False
            if len(rows) > 5000:
                yield out()
        if waiting:
            keep(CONTINUED if continued else OPEN)
        if rows:
            yield out()

    cut_up = lines.mapInArrow(cut, "record string, _path string, _time timestamp, _block long, kind int, _place long")
    whole = cut_up.filter(F.col("kind") == WHOLE).select("record", "_path", "_time", "_block", F.lit(False).alias("_stitched"), "_place")
    if not found_at.broken:
        return whole
    # What is continued at the beginning of a split belongs to the last record that was left open before it.
    upto = Window.partitionBy("_path").orderBy("_block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    fragments = cut_up.filter(F.col("kind") != WHOLE).withColumn("_begun", F.last(F.when(F.col("kind") == OPEN, F.col("_block")), ignorenulls=True).over(upto))
    pieces = F.array_sort(F.collect_list(F.struct((F.col("_block") * 2 - (F.col("kind") == CONTINUED).cast("int")).alias("at"), F.col("record").alias("record"))))
    stitched = fragments.groupBy("_path", "_time", "_begun").agg(pieces.alias("_pieces"), F.max(F.when(F.col("kind") == OPEN, F.col("_place"))).alias("_place"))
    stitched = stitched.filter(F.col("_pieces")[0]["record"].isNotNull())
    text = F.array_join(F.transform("_pieces", lambda p: p["record"]), "\n")
    return whole.unionByName(stitched.select(text.alias("record"), "_path", "_time", F.col("_begun").alias("_block"), F.lit(True).alias("_stitched"), "_place"))


def in_record_order(rows: DataFrame, by_time: bool = False) -> DataFrame:
    """``seq``: number of each of the rows of ``read_records`` that are left, by file (path, or time and path) and by place in it.

    Only a row per split is ordered; the rows themselves are not moved.
    """
    marked = rows.withColumn("_id", F.monotonically_increasing_id())
    pieces = marked.groupBy("_path", "_time", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(~F.col("_stitched"), F.col("_id"))).alias("_first"))
    order = Window.orderBy(*(["_time"] if by_time else []), "_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("_path", "_block", "_first", "_n", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_start"))
    place = F.when(F.col("_stitched"), F.col("_n") - 1).otherwise(F.col("_id") - F.col("_first"))
    return marked.join(starts, ["_path", "_block"]).withColumn("seq", F.col("_start") + place)
