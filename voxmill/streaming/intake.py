"""Feedback files that keep arriving, as a stream.

Each micro-batch is cleaned and added to the newest snapshot of a table kept by month (``month_table``): batch ``b`` goes on from snapshot ``b``
and makes snapshot ``b + 1``. Its rows are merged with those of other batches when enough of them are pending, or by who reads; only months that have
such rows are rewritten. Running a batch again overwrites the same files, which makes retries harmless, and old snapshots are retired.
Where the table format knows MERGE INTO, pass ``merge`` and only the batch is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.merges import upsert_comments
from ..session import temporary_tables
from ..sources.files import FEEDBACK_FIELDS, clean_feedback, csv_options, feedback_columns, feedback_of_lines, positional_schema, with_places
from ..sources.records import lines_of
from .month_table import append_batch, read_months, retire, start_months

# What a batch leaves to be merged: no identifiers in the clear.
LANDED = T.StructType([T.StructField("seq", T.LongType()), *(schemas.COMMENTS[c] for c in (
    "title", "grade", "description", "national_code_hash", "mobile_no_hash", "created_at", "channel_code", "imported_at"))])


def _merge(old: DataFrame, new: DataFrame, top: int) -> DataFrame:
    return upsert_comments(old, new, top_id=top)


def start_table(spark: SparkSession, table: str, rows: DataFrame | None = None) -> None:
    """Snapshot 0: the given rows or none."""
    start_months(spark, table, schemas.COMMENTS, rows)


def read_table(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The comments after batch ``number`` (the last one by default), and their ``month``."""
    return read_months(spark, table, schemas.COMMENTS, number, change=_merge, landed=LANDED)


def import_stream(
    spark: SparkSession, source: str, table: str, checkpoint: str, *, files_per_batch: int | None = None,
    imported_at: Column | None = None, merge: Callable[[DataFrame, int], None] | None = None, multi_line: bool = True,
    keep: int = 2,
) -> StreamingQuery:
    """Start the import of all CSV files in ``source``; it ends when they are read. The last ``keep`` snapshots stay (0: all)."""

    def into_snapshot(batch: DataFrame, number: int) -> None:
        clean = clean_feedback((feedback_of_lines if multi_line else feedback_columns)(batch, by_time=True))
        if merge is not None:
            merge(clean, number)
            return
        session = batch.sparkSession
        with temporary_tables(session):
            dated = clean.withColumn("imported_at", imported_at if imported_at is not None else F.current_timestamp())
            append_batch(session, table, schemas.COMMENTS, number, dated, _merge, LANDED)
        if keep:
            retire(session, table, keep)

    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if multi_line:
        arriving = lines_of(reader, source)
    else:
        arriving = with_places(reader.schema(positional_schema(FEEDBACK_FIELDS)).options(**csv_options(False)).csv(source))
    return (
        arriving.writeStream.foreachBatch(into_snapshot)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
