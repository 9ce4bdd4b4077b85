"""A table kept by month, of which a change rewrites the touched months only.

    table/data/batch=3/month=202401/part-...     what batch 3 wrote
    table/pending/batch=4/month=202401/part-...  rows of batch 4 that are still to be merged
    table/manifest/4                             after batch 4: for each month its live batch, rows and highest id, and the pending ones

A manifest is one small row per month (and pending batch of it) and is written last: a batch that dies before leaves nothing visible. Running a
batch again reads the manifest before it and overwrites its own files only, so the result is the same. Months that a batch does not touch keep their files.
``retire`` removes the files that none of the last snapshots refers to.

``write_batch`` rewrites the months of a batch at once. ``append_batch`` only adds the batch, and merges all pending rows together when they are as many as
the months they belong to hold: however many batches come, what is written stays in proportion to what has come. Who reads a snapshot merges what is pending.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_number

Change = Callable[[DataFrame, DataFrame, int], DataFrame]
MANIFEST = "month int, batch long, rows long, top_id long, pending boolean"  # of pending rows top_id is the highest place
MANIFEST_NAMES = [f.split()[0] for f in MANIFEST.split(", ")]
NO_MONTH = 0  # rows without a time


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, files = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def _exists(spark: SparkSession, path: str) -> bool:
    place, files = _folder(spark, path)
    return files.exists(place)


def _remove(spark: SparkSession, path: str) -> None:
    place, files = _folder(spark, path)
    files.delete(place, True)


def snapshots(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the snapshots that are complete, ascending."""
    names = _names(spark, f"{table}/manifest")
    return sorted(int(n) for n in names if n.isdigit() and _exists(spark, f"{table}/manifest/{n}/_SUCCESS"))


def manifest(spark: SparkSession, table: str, number: int) -> list[T.Row]:
    """month, batch, rows, top_id of the live months: one row per month."""
    return spark.read.schema(MANIFEST).json(f"{table}/manifest/{number}").collect()


def _read(spark: SparkSession, table: str, schema: T.StructType, live: Sequence[T.Row], kind: str = "data") -> DataFrame:
    """Rows of these months, with ``month`` as a partition column."""
    whole = T.StructType([*schema.fields, T.StructField("month", T.IntegerType())])
    paths = [f"{table}/{kind}/batch={m.batch}/month={m.month}" for m in live if m.rows]
    if not paths:
        return spark.createDataFrame([], whole)
    with_batch = T.StructType([*whole.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(with_batch).option("basePath", f"{table}/{kind}").parquet(*paths).drop("batch")


def read_months(
    spark: SparkSession, table: str, schema: T.StructType, number: int | None = None, *,
    change: Change | None = None, landed: T.StructType | None = None, time: str = "created_at",
) -> DataFrame:
    """The table after batch ``number`` (the last one by default), with its partition column ``month`` (year * 100 + month).

    Where rows are pending, ``change`` and ``landed`` are those of ``append_batch``.
    """
    found = snapshots(spark, table)
    if not found:
        return _read(spark, table, schema, [])
    live, pending = _parts(manifest(spark, table, found[-1] if number is None else number))
    if not pending:
        return _read(spark, table, schema, live)
    if change is None or landed is None:
        raise ValueError("rows are pending; say how they change the table")
    merged = _merged(spark, table, schema, live, pending, change, landed).withColumn("month", month_of(time))
    touched = {p.month for p in pending}
    return _read(spark, table, schema, [m for m in live if m.month not in touched]).unionByName(merged)


def _parts(entries: Sequence[T.Row]) -> tuple[list[T.Row], list[T.Row]]:
    """Live months, and pending batches of months."""
    return [m for m in entries if not m.pending], [m for m in entries if m.pending]


def _merged(
    spark: SparkSession, table: str, schema: T.StructType, live: Sequence[T.Row], pending: Sequence[T.Row], change: Change, landed: T.StructType
) -> DataFrame:
    """New rows of the months that have pending rows. Batches in a row change the table as one batch of all their rows does."""
    touched = {p.month for p in pending}
    old = _read(spark, table, schema, [m for m in live if m.month in touched]).drop("month")
    return change(old, _read(spark, table, landed, pending, "pending").drop("month"), max((m.top_id or 0 for m in live), default=0))


def month_of(time: str) -> F.Column:
    return F.coalesce(month_number(F.col(time)), F.lit(NO_MONTH))


def write_batch(
    spark: SparkSession, table: str, schema: T.StructType, number: int, batch: DataFrame, change: Change,
    *, time: str = "created_at", id: str = "id",
) -> None:
    """Snapshot ``number`` + 1 from snapshot ``number``: ``change`` (old rows, batch, highest id of the whole table) gives the new rows.

    ``change`` sees the months only in which the batch has rows, and must not move a row to another month. A batch without rows
    makes a snapshot with the same files.
    """
    live, pending = _parts(manifest(spark, table, number))
    if pending:
        raise ValueError("rows are pending; go on with append_batch")
    touched = {r.month for r in batch.select(month_of(time).alias("month")).distinct().collect()}  # months: a few hundred
    _remove(spark, f"{table}/data/batch={number + 1}")
    fresh: list[tuple] = []
    if touched:
        old = _read(spark, table, schema, [m for m in live if m.month in touched]).drop("month")
        rows = change(old, batch, max((m.top_id or 0 for m in live), default=0))
        fresh = _write(spark, table, schema, number + 1, rows, time, id)
    _commit(spark, table, number + 1, [*fresh, *(tuple(m) for m in live if m.month not in touched)])


def append_batch(
    spark: SparkSession, table: str, schema: T.StructType, number: int, batch: DataFrame, change: Change, landed: T.StructType,
    *, place: str = "seq", time: str = "created_at", id: str = "id",
) -> None:
    """Snapshot ``number`` + 1: ``number`` and the rows of the batch, which has the columns ``landed``.

    ``change`` is that of ``write_batch``; batches in a row must change the table as one batch of all their rows does. ``place`` orders
    the rows of a batch by whole numbers from 0, and is shifted so that later batches come later. A merge reads and writes at most the rows that
    are pending and as many again, so all merges together write a small multiple of all rows, whatever the number of batches.
    """
    live, pending = _parts(manifest(spark, table, number))
    _remove(spark, f"{table}/data/batch={number + 1}")
    start = max((p.top_id + 1 for p in pending), default=0)
    shifted = batch.withColumn(place, F.col(place) + start).select(*landed.names)
    pending += [T.Row(*MANIFEST_NAMES)(*m) for m in _write(spark, table, landed, number + 1, shifted, time, place, "pending")]
    touched = {p.month for p in pending}
    if sum(p.rows for p in pending) >= sum(m.rows for m in live if m.month in touched) and touched:
        fresh = _write(spark, table, schema, number + 1, _merged(spark, table, schema, live, pending, change, landed), time, id)
        _commit(spark, table, number + 1, [*fresh, *(tuple(m) for m in live if m.month not in touched)])
        _remove(spark, f"{table}/pending/batch={number + 1}")
    else:
        _commit(spark, table, number + 1, [tuple(m) for m in (*live, *pending)])


def _write(spark: SparkSession, table: str, schema: T.StructType, batch: int, rows: DataFrame, time: str, id: str, kind: str = "data") -> list[tuple]:
    """Writes the rows by month; the entries of the manifest for them."""
    out = f"{table}/{kind}/batch={batch}"
    _remove(spark, out)
    rows.withColumn("month", month_of(time)).write.partitionBy("month").parquet(out)
    written = spark.read.schema(T.StructType([schema[id], T.StructField("month", T.IntegerType())])).parquet(out)
    counted = written.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.max(id).cast("long").alias("top_id"))
    return [(r.month, batch, r.rows, r.top_id, kind == "pending") for r in counted.collect()]


def _commit(spark: SparkSession, table: str, number: int, live: list[tuple]) -> None:
    rows = spark.createDataFrame(sorted(live), MANIFEST).coalesce(1)
    rows.write.mode("overwrite").json(f"{table}/manifest/{number}")


def start_months(spark: SparkSession, table: str, schema: T.StructType, rows: DataFrame | None = None, *, time: str = "created_at", id: str = "id") -> None:
    """Snapshot 0: the given rows or none."""
    _commit(spark, table, -1, [])
    write_batch(spark, table, schema, -1, rows if rows is not None else spark.createDataFrame([], schema), lambda old, batch, top: batch, time=time, id=id)
    _remove(spark, f"{table}/manifest/-1")


def retire(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Removes all snapshots but the last ``keep``, and the months that none of those refers to; what was removed.

    Manifests go first, so a snapshot that is there is whole.
    """
    if keep < 1:
        raise ValueError("one snapshot has to stay")
    found = snapshots(spark, table)
    entries = [m for n in found[-keep:] for m in manifest(spark, table, n)]
    kept = {(m.batch, m.month) for m in entries if not m.pending}
    pending = {m.batch for m in entries if m.pending}
    gone = [f"{table}/manifest/{n}" for n in found[:-keep]]
    done = found[-1] if found else -1
    for name in _names(spark, f"{table}/pending"):
        batch = int(name.removeprefix("batch="))
        if batch <= done and batch not in pending:
            gone.append(f"{table}/pending/{name}")
    for name in _names(spark, f"{table}/data"):
        batch = int(name.removeprefix("batch="))
        if batch > done:
            continue  # being written
        months = [n for n in _names(spark, f"{table}/data/{name}") if n.startswith("month=")]
        unused = [n for n in months if (batch, int(n.removeprefix("month="))) not in kept]
        gone += [f"{table}/data/{name}"] if len(unused) == len(months) else [f"{table}/data/{name}/{n}" for n in unused]
    for path in gone:
        _remove(spark, path)
    return gone
