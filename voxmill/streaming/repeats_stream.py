"""Repeated comments of a user, as the comments arrive.

The rule is that of ``operators/repeats.py``: a comment repeats its user's anchor when text and
title are equal and it is at most a window younger, and any other comment becomes the anchor.
The anchor is all that has to be known of the past, so it is the state: a few numbers per user,
which go when the watermark has passed the anchor by a window. Users are dealt into a fixed number of
buckets by their hash, and a bucket's anchors are read and written together: a call per user and
micro-batch would take longer than all the work on its comments.

For comments that arrive in the order of their times the flags are those of the batch job,
however the stream is cut into micro-batches and wherever it was stopped and started again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.repeats import MICROS, comment_key, time_micros

FLAGS = "id long, is_repetitive boolean, duplicate_of long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class AnchorsOfBucket(StatefulProcessor):
    """State: (key, time, id) of the anchor of each user of a bucket, and one timer, for when the last of them can be forgotten."""

    def __init__(self, window: int):
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.anchors = handle.getValueState("anchors", "u array<string>, k array<string>, t array<long>, i array<long>, timer long")

    def _expires(self, time: int) -> int:
        """Milliseconds, rounded up: no comment after it can repeat an anchor of this time."""
        return -(-(time + self.window) // 1000) + 1

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["t", "i"])
        users, keys, times, ids, timer = self.anchors.get() if self.anchors.exists() else ((), (), (), (), None)
        anchors = dict(zip(users, zip(keys, times, ids)))
        found: list[int | None] = []
        for u, k, t, i in zip(batch["u"], batch["k"], batch["t"].tolist(), batch["i"].tolist()):
            anchor = anchors.get(u)
            if anchor and k == anchor[0] and 0 <= t - anchor[1] <= self.window:
                found.append(anchor[2])
                continue
            found.append(None)
            if not anchor or t >= anchor[1]:
                anchors[u] = (k, t, i)
        self._keep(anchors, timer, timerValues.getCurrentWatermarkInMs())
        of = pd.array(found, dtype="Int64")
        yield pd.DataFrame({"id": batch["i"].to_numpy(), "is_repetitive": ~of.isna(), "duplicate_of": of})

    def _keep(self, anchors: dict[str, tuple[str, int, int]], timer: int | None, watermark: int) -> None:
        """Writes the anchors that something can still repeat. A timer that is no longer the last is taken back."""
        kept = {u: a for u, a in anchors.items() if self._expires(a[1]) > watermark}
        last = max((self._expires(a[1]) for a in kept.values()), default=None)
        if timer is not None and timer != last:
            self.handle.deleteTimer(timer)
        if last is None:
            self.anchors.clear()
            return
        if timer != last:
            self.handle.registerTimer(last)
        keys, times, ids = zip(*kept.values())
        self.anchors.update((list(kept), list(keys), list(times), list(ids), last))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.anchors.clear()  # the timer is that of the last anchor
        yield pd.DataFrame({"id": pd.array([], "int64"), "is_repetitive": pd.array([], "bool"), "duplicate_of": pd.array([], "Int64")})

    def close(self) -> None:
        pass


def flag_stream(
    comments: DataFrame, *, window_seconds: int = 3600, late: str = "1 day", user: str = "national_code_hash",
    text: str = "description", title: str = "title", time: str = "created_at", id: str = "id", buckets: int = 1024,
) -> DataFrame:
    """(id, is_repetitive, duplicate_of) of a stream of comments, for the output mode ``append``.

    A comment without user or time never repeats. One that is older than its user's anchor by arriving
    late neither repeats nor becomes the anchor. One that is older than the newest by more than
    ``late`` is left out by the watermark (``numRowsDroppedByWatermark`` counts them); ``late`` has to be
    more than zero, since rows as old as the newest of the batch before would be late too.

    Texts are fingerprinted before the shuffle. A task holds user, key, time and id of one bucket's comments of one micro-batch,
    which ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` of the source bounds, and the anchors of its users. The number of
    ``buckets`` belongs to the checkpoint: it has to stay when a stream is started again. State is kept in RocksDB, which the
    session is set to.
    """
    comments.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    placed = F.col(user).isNotNull() & F.col(time).isNotNull()
    rows = comments.filter(placed).select(
        F.pmod(F.xxhash64(F.col(user).cast("string")), F.lit(buckets)).alias("bucket"), F.col(user).cast("string").alias("u"), F.col(id).cast("long").alias("i"), time_micros(comments, time).alias("t"),
        comment_key(text, title).alias("k"), F.col(time).cast("timestamp").alias("event_time"),
    )
    flagged = rows.withWatermark("event_time", late).groupBy("bucket").transformWithStateInPandas(
        AnchorsOfBucket(window_seconds * MICROS), outputStructType=FLAGS, outputMode="append", timeMode="EventTime"
    )
    others = comments.filter(~placed).select(
        F.col(id).cast("long").alias("id"), F.lit(False).alias("is_repetitive"), F.lit(None).cast("long").alias("duplicate_of")
    )
    return flagged.unionByName(others)
