"""Order-dependent building blocks that keep no whole group in one task.

A window over a group that holds a third of all rows is a third of all rows in one
task. Both helpers here cut a group into slots of the ordering value, work inside the
slots, and carry one small row per slot across them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MOST_SLOTS = 10_000  # tasks of one shuffle; beyond it slots grow with the table instead


def carry_forward(
    rows: DataFrame, keys: Sequence[str], slot: str, order: Sequence[str], value: str, out: str, *, include_current: bool
) -> DataFrame:
    """``out`` = last non-null ``value`` at (or strictly before) each row of its group.

    Rows are ordered by ``order``, ascending; ``slot`` must not decrease along it. One
    task sees the rows of one slot, and of each other slot a single row.
    """
    last_offset = 0 if include_current else -1
    in_slot = Window.partitionBy(*keys, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, last_offset)
    earlier = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    per_slot = rows.groupBy(*keys, slot).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_last")
    )
    carried = per_slot.select(*keys, slot, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    return (
        rows.withColumn("_here", F.last(value, ignorenulls=True).over(in_slot))
        .join(carried, [*keys, slot], "left")
        .withColumn(out, F.coalesce("_here", "_carried"))
        .drop("_here", "_carried")
    )


def slots_by_rank(rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, slot_rows: int) -> DataFrame:
    """A written copy of ``rows`` with a slot of about ``slot_rows`` rows each, however dense the ordering value is.

    Rows are range partitioned by keys and order, and the number of the partition is the
    slot: a group that is larger than a partition goes through several of them in order.
    Range bounds come from a sample, so a slot may hold two or three times as many rows;
    where ``MOST_SLOTS`` slots are not enough, each holds that share of the table. ``rows``
    are read three times (count, sample, write) and should be cheap to read.
    """
    parts = min(MOST_SLOTS, max(1, -(-rows.count() // slot_rows)))
    return cut_lineage(rows.repartitionByRange(parts, *keys, *order).withColumn(out, F.spark_partition_id().cast("long")))


def add_position(rows: DataFrame, keys: Sequence[str], order: str, out: str, slot_width: int = 1_000_000) -> DataFrame:
    """``out`` = 0-based position of each row in its group by ``order``, a whole number
    that is unique within the group. One task sees at most ``slot_width`` rows."""
    cut = rows.withColumn("_slot", F.floor(F.col(order) / slot_width))
    in_slot = Window.partitionBy(*keys, "_slot").orderBy(order)
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_slot")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_slot", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        cut.withColumn("_row", F.row_number().over(in_slot) - 1)
        .join(offsets, [*keys, "_slot"])
        .withColumn(out, F.col("_offset") + F.col("_row"))
        .drop("_slot", "_row", "_offset")
    )


def top_per_group(rows: DataFrame, keys: Sequence[str], order: Sequence, k: int, out: str = "rank") -> DataFrame:
    """First ``k`` rows of each group, numbered from 1. For a small ``k`` Spark keeps
    only ``k`` rows per group and task before it shuffles."""
    ranked = rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(out) <= k)


def join_skewed(rows: DataFrame, stats: DataFrame, keys: Sequence[str], weight: str, hot: int = 2_000) -> DataFrame:
    """Inner join of ``rows`` with one row per key of ``stats``; ``weight`` is the number
    of rows a key has.

    The ``hot`` most frequent keys are broadcast, so their rows never shuffle. A key
    outside them holds at most ``1/hot`` of all rows, so the others shuffle evenly.
    """
    frequent = stats.orderBy(F.desc(weight), *keys).limit(hot)
    marked = rows.join(F.broadcast(frequent), list(keys), "left")
    joined = marked.filter(F.col(weight).isNotNull())
    others = marked.filter(F.col(weight).isNull()).select(*rows.columns)
    return joined.unionByName(others.join(stats, list(keys)))
