"""Repeated comments of one user within a time window.

A comment repeats the user's *anchor* when text and title are equal and it is at most
``window_seconds`` younger. Any other comment becomes the new anchor, so whether a row
repeats depends on a chain of earlier decisions. The chain is cut twice before it is
followed:

1. a comment that differs from the one just before it, or comes more than a window
   later, is an anchor for certain: it starts a *run*;
2. within a run everything up to one window after its start repeats the start.

Only rows later than that are left. Each of them knows which row would be the next
anchor if it were one; the anchors actually reached from the run's start are found by
pointer doubling, so a chain of n anchors takes log2(n) joins on row ids.

No step needs all rows of a user in one task: see ``carry_forward``. Slots are of
``slot_seconds``; where a user has more than ``slot_rows`` rows in one of them (bursts, times
finer than a second), all slots are cut by rank instead (``slots_by_rank``), down to rows of
one and the same time, which their ids tell apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import squeeze
from ..session import cut_lineage
from .ordering import carry_forward, slots_by_rank

MICROS = 1_000_000


def time_micros(comments: DataFrame, name: str) -> Column:
    if isinstance(comments.schema[name].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(F.col(name))


def comment_key(text: str, title: str) -> Column:
    """Fingerprint of normalised text and title, so that whole texts are not shuffled."""
    body, head = squeeze(F.col(text)), squeeze(F.col(title))
    return F.sha2(F.concat(F.length(body).cast("string"), F.lit(":"), body, head), 256)


def find_repeats(
    comments: DataFrame,
    *,
    window_seconds: int = 3600,
    slot_seconds: int = 3600,
    slot_rows: int = 100_000,
    user: str = "national_code_hash",
    text: str = "description",
    title: str = "title",
    time: str = "created_at",
    id: str = "id",
) -> DataFrame:
    """One row (id, duplicate_of) per repeated comment."""
    window, slot = window_seconds * MICROS, slot_seconds * MICROS
    rows = comments.filter(F.col(user).isNotNull() & F.col(time).isNotNull()).select(
        F.col(user).alias("u"), F.col(id).alias("i"), time_micros(comments, time).alias("t"),
        comment_key(text, title).alias("k"),
    )
    by_time = rows.withColumn("s", F.floor(F.col("t") / slot))
    fullest = by_time.groupBy("u", "s").count().agg(F.max("count")).first()[0] or 0  # reads user and time only
    dense = fullest > slot_rows
    rows = slots_by_rank(cut_lineage(rows), ["u"], ["t", "i"], "s", slot_rows) if dense else by_time
    # One exchange of narrow rows serves the windows, aggregates and joins of both passes,
    # and texts are read and fingerprinted once.
    rows = rows.repartition("u", "s")

    runs = carry_forward(
        rows.withColumn("_row", F.struct("t", "k")), ["u"], "s", ["t", "i"], "_row", "prev", include_current=False
    )
    begins = F.col("prev").isNull() | (F.col("prev.k") != F.col("k")) | (F.col("t") - F.col("prev.t") > window)
    runs = carry_forward(
        runs.select("u", "i", "t", "s", F.when(begins, F.struct("t", "i")).alias("_start")),
        ["u"], "s", ["t", "i"], "_start", "start", include_current=True,
    ).select("i", "t", "s", F.col("start.i").alias("run"), (F.col("t") - F.col("start.t")).alias("age"))
    # Narrow rows, written once: all that follows starts from them.
    runs = cut_lineage(runs)

    late = runs.filter(F.col("age") > window)
    repeats = runs.filter((F.col("age") <= window) & (F.col("i") != F.col("run"))).select(
        "i", F.col("run").alias("duplicate_of")
    )
    if not late.isEmpty():
        repeats = repeats.unionByName(_follow_chains(late.select("run", "i", "t", "s"), window, slot, slot_rows if dense else None))
    return repeats.select(F.col("i").alias(id), "duplicate_of")


def _follow_chains(late: DataFrame, window: int, slot: int, slot_rows: int | None) -> DataFrame:
    """(i, duplicate_of) for the late rows of runs; ``run`` identifies the run."""
    jumps = cut_lineage(_next_candidates(late, window, slot, slot_rows))
    reached = late.groupBy("run").agg(F.min_by("i", F.struct("t", "i")).alias("i")).select("i")
    reached = cut_lineage(reached)
    while True:
        further = cut_lineage(reached.join(jumps, "i").select(F.col("next").alias("i")))
        if further.isEmpty():
            break
        reached = reached.unionByName(further)
        second = jumps.select(F.col("i").alias("next"), F.col("next").alias("after"))
        jumps = cut_lineage(jumps.join(second, "next").select("i", F.col("after").alias("next")))
    anchors = reached.withColumn("_is_anchor", F.lit(True))
    marked = late.join(anchors, "i", "left").withColumn("_anchor", F.when(F.col("_is_anchor"), F.col("i")))
    placed = carry_forward(marked, ["run"], "s", ["t", "i"], "_anchor", "anchor", include_current=True)
    return placed.filter(F.col("anchor") != F.col("i")).select("i", F.col("anchor").alias("duplicate_of"))


def _next_candidates(late: DataFrame, window: int, slot: int, slot_rows: int | None) -> DataFrame:
    """(i, next): the first row of the same run more than a window after row i.

    Rows and probes (row time plus window) are ordered from the latest to the
    earliest; the last row passed before a probe is the one sought. Slots of time hold
    twice the rows of the slots they were counted in; with ``slot_rows`` they are cut by rank.
    """
    rows = late.select("run", "i", (-F.col("t")).alias("b"), F.lit(1).alias("kind"), F.col("i").alias("_row"))
    probes = late.select(
        "run", "i", (-(F.col("t") + window)).alias("b"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("_row")
    )
    both = rows.unionByName(probes).withColumn("j", -F.col("i"))
    if slot_rows is None:
        both = both.withColumn("s", F.floor(F.col("b") / slot))
    else:
        both = slots_by_rank(both, ["run"], ["b", "kind", "j"], "s", slot_rows)
    found = carry_forward(both, ["run"], "s", ["b", "kind", "j"], "_row", "next", include_current=False)
    return found.filter((F.col("kind") == 0) & F.col("next").isNotNull()).select("i", "next")


def flag_repetitive(comments: DataFrame, *, id: str = "id", **options) -> DataFrame:
    """(id, is_repetitive, duplicate_of) for every row given."""
    repeats = find_repeats(comments, id=id, **options)
    return comments.select(id).join(repeats, id, "left").select(
        id, F.col("duplicate_of").isNotNull().alias("is_repetitive"), "duplicate_of"
    )


def apply_flags(comments: DataFrame, flags: DataFrame) -> DataFrame:
    """Flags written into the table; rows without a flag keep what they had. Of several
    flags of a row the largest counts, so a row stays one row."""
    flags = flags.groupBy("id").agg(F.max(F.struct("is_repetitive", "duplicate_of")).alias("_flags")).select("id", "_flags.*")
    new = flags.select("id", F.col("is_repetitive").alias("_flag"), F.col("duplicate_of").alias("_of"))
    flagged = F.col("_flag").isNotNull()
    return comments.join(new, "id", "left").withColumns(
        {
            "is_repetitive": F.when(flagged, F.col("_flag")).otherwise(F.col("is_repetitive")),
            "duplicate_of": F.when(flagged, F.col("_of")).otherwise(F.col("duplicate_of")),
        }
    ).drop("_flag", "_of")


def reset_flags(comments: DataFrame) -> DataFrame:
    return comments.withColumns({"is_repetitive": F.lit(False), "duplicate_of": F.lit(None).cast("long")})
