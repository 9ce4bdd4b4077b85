"""Changes to tables: upserts, updates by key, appends.

Each function returns the new content of the table (or what to append); the caller
writes it as a new snapshot. A batch is first reduced to one row per key with
aggregates that combine on the map side, so copies of one key do not pile up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import to_jalali_int
from ..functions import lexicon as lx
from ..functions.text import strip
from ..session import cut_lineage
from .ordering import add_position
from .selection import missing_jalali


def latest_per_key(batch: DataFrame, keys: Sequence[str], order: str | None, values: Sequence[str]) -> DataFrame:
    """One row per key: the values of its last row; without an order the largest row."""
    whole = F.struct(*values)
    last = (F.max_by(whole, F.col(order)) if order else F.max(whole)).alias("_last")
    return batch.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def _split(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The table with what the batch says about its rows (``_new`` and ``_new_*``), and
    the batch rows that are new.

    The reduced batch is written once, since four readers follow. It is always the side that
    may be broadcast. Next to a large table it usually is small: then the table is not shuffled
    at all, and finding the new rows reads its key columns only.
    """
    batch = cut_lineage(batch)
    said = batch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in batch.columns if c not in keys], F.lit(True).alias("_new"))
    known = target.select(*keys).join(batch.select(*keys), list(keys))
    return target.join(said, list(keys), "left"), batch.join(known, list(keys), "left_anti")


def _kind(target: DataFrame, name: str) -> T.DataType:
    """Type of a column of the table; arrays may hold nulls, since the batch's may."""
    kind = target.schema[name].dataType
    return T.ArrayType(kind.elementType, True) if isinstance(kind, T.ArrayType) else kind


def _replace(target: DataFrame, joined: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Target columns; where the batch has the key, ``changes`` are applied."""
    hit = F.col("_new").isNotNull()

    def column(name: str) -> Column:
        if name not in changes:
            return F.col(name)
        return F.when(hit, changes[name]).otherwise(F.col(name)).cast(_kind(target, name)).alias(name)

    return joined.select(*[column(c) for c in target.columns])


def _as_rows(target: DataFrame, fresh: DataFrame, values: dict[str, Column]) -> DataFrame:
    """New rows in the shape of the table; columns without a value are null."""
    return fresh.select(
        *[values.get(f.name, F.lit(None)).cast(_kind(target, f.name)).alias(f.name) for f in target.schema.fields]
    )


def _numbered(target: DataFrame, id: str, fresh: DataFrame, order: str, top: int | None = None) -> DataFrame:
    """New rows with the next free ids of the table (or those after ``top``), in ``order``."""
    if top is not None:
        return add_position(fresh, [], order, "_position").withColumn(id, F.lit(top).cast("long") + 1 + F.col("_position")).drop("_position")
    highest = target.agg(F.coalesce(F.max(id), F.lit(0)).alias("_top"), F.lit(1).alias("_one"))
    placed = add_position(fresh, [], order, "_position").withColumn("_one", F.lit(1))
    placed = placed.join(F.broadcast(highest), "_one")  # one row
    return placed.withColumn(id, F.col("_top") + 1 + F.col("_position")).drop("_top", "_one", "_position")


def upsert_comments(
    target: DataFrame, batch: DataFrame, *, imported_at: Column | None = None, seq: str = "seq", top_id: int | None = None
) -> DataFrame:
    """Key (national_code_hash, created_at). The batch wins, but an existing channel
    stays; within the batch the last row wins and the first known channel stays.
    New rows get ids after the highest one, in batch order. The time is part of the key, so ``target`` may be the months of the batch
    only; then ``top_id`` says what the highest id of the whole table is. A batch whose rows have an ``imported_at`` keeps it where none is given."""
    keys = ["national_code_hash", "created_at"]
    dated = imported_at is None and "imported_at" in batch.columns
    overwritten = ["title", "grade", "description", "mobile_no_hash", *(["imported_at"] if dated else [])]
    now = imported_at if imported_at is not None else F.current_timestamp()
    rows = batch.groupBy(*keys).agg(
        F.max_by(F.struct(*overwritten), F.col(seq)).alias("_last"),
        F.min_by("channel_code", F.when(F.col("channel_code").isNotNull(), F.col(seq))).alias("channel_code"),
        F.min(seq).alias("seq"),
    ).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in overwritten], "channel_code", "seq")
    joined, fresh = _split(target, rows, keys)
    changes = {c: F.col(f"_new_{c}") for c in overwritten}
    changes = {"imported_at": now} | changes | {"channel_code": F.coalesce("channel_code", "_new_channel_code")}
    fresh = _numbered(target, "id", fresh, "seq", top_id)
    values = {"imported_at": now} | {c: F.col(c) for c in ("id", *keys, *overwritten, "channel_code")}
    return _replace(target, joined, changes).unionByName(_as_rows(target, fresh, values))


def upsert_assistant(target: DataFrame, batch: DataFrame, *, imported_at: Column | None = None, seq: str = "seq") -> DataFrame:
    """Key (user_message, created_at). The last row wins, empty answers become null;
    the import time is that of the first load."""
    keys = ["user_message", "created_at"]
    overwritten = ["assistant_message", "is_liked", "q1", "q2", "q3"]
    now = imported_at if imported_at is not None else F.current_timestamp()
    clean = batch.withColumns({q: F.when(F.col(q) != "", F.col(q)) for q in ("q1", "q2", "q3")})
    rows = clean.groupBy(*keys).agg(
        F.max_by(F.struct(*overwritten), F.col(seq)).alias("_last"), F.min(seq).alias("seq")
    ).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in overwritten], "seq")
    joined, fresh = _split(target, rows, keys)
    fresh = _numbered(target, "turn_id", fresh, "seq")
    values = {c: F.col(c) for c in ("turn_id", *keys, *overwritten)} | {"imported_at": now}
    changes = {c: F.col(f"_new_{c}") for c in overwritten}
    return _replace(target, joined, changes).unionByName(_as_rows(target, fresh, values))


def insert_if_absent(target: DataFrame, batch: DataFrame, *, key: str = "comment_idd", order: str) -> DataFrame:
    """The rows of the batch to append: by ``order`` the first of each key that the table
    lacks. Their number is the count of new comments."""
    values = [c for c in batch.columns if c != key]
    rows = batch.groupBy(key).agg(F.min_by(F.struct(*values), F.col(order)).alias("_first"))
    rows = rows.select(key, *[F.col(f"_first.{v}").alias(v) for v in values]).select(*batch.columns)
    known = target.select(key).join(rows.select(key), key)
    return rows.join(known, key, "left_anti")


def upsert_analysis(
    target: DataFrame, rows: DataFrame, *, processed_at: Column | None = None, seq: str | None = None
) -> DataFrame:
    """Key comment_id; everything but created_at is replaced. A comment that comes several
    times counts by its last row by ``seq``; without ``seq`` by one of them, the same in every run."""
    now = processed_at if processed_at is not None else F.current_timestamp()
    given = [c for c in target.columns if c != "processed_at"]
    rows = latest_per_key(rows, ["comment_id"], seq, [c for c in given if c != "comment_id"])
    joined, fresh = _split(target, rows.select(*given), ["comment_id"])
    changes = {c: F.col(f"_new_{c}") for c in given if c not in ("comment_id", "created_at")} | {"processed_at": now}
    values = {c: F.col(c) for c in given} | {"processed_at": now}
    return _replace(target, joined, changes).unionByName(_as_rows(target, fresh, values))


def mark_analyzed(comments: DataFrame, ids: DataFrame) -> DataFrame:
    """``is_analyzed`` becomes true for the ids given; other rows keep theirs."""
    written = ids.select("id").distinct().withColumn("_written", F.lit(True))
    return comments.join(written, "id", "left").withColumn(
        "is_analyzed", F.coalesce("_written", "is_analyzed")
    ).drop("_written")


def summaries_to_append(rows: DataFrame) -> DataFrame:
    """Summaries are only appended; a row without a summary is rejected."""
    return rows.filter(F.col("summarized_comment").isNotNull())


def finish_jobs(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Outcome written to the jobs by id; jobs without an outcome stay as they are. Of
    several outcomes of a job the largest counts, so a job stays one row."""
    columns = ["summarized_comment", "comment_count", "status", "duration_seconds", "model"]
    results = latest_per_key(results, ["summarized_id"], None, columns)
    new = results.select("summarized_id", *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_new"))
    joined = jobs.join(new, "summarized_id", "left")
    return _replace(jobs, joined, {c: F.col(f"_new_{c}") for c in columns})


def unknown_jobs(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Outcomes whose job does not exist: an error of the caller."""
    return results.join(jobs.select("summarized_id"), "summarized_id", "left_anti")


def import_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts around a load, as one row."""
    counted = before.agg(F.count(F.lit(1)).alias("rows_before"), F.lit(0).cast("long").alias("rows_after")).unionByName(
        after.agg(F.lit(0).cast("long").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    )
    return counted.agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))


# --- apps -------------------------------------------------------------------------------------------
SCRAPED_ATTRIBUTES = [
    "app_img", "company", "version", "total_rate", "average_rate", "install", "category", "size",
    "last_update", "img_base64",
]
REGISTERED_ATTRIBUTES = ["app_name", *SCRAPED_ATTRIBUTES, "url", "nickname"]


def upsert_app_info(apps: DataFrame, scrape: DataFrame, *, seq: str | None = None) -> DataFrame:
    """Ten attributes by nickname; nothing is inserted. Of several scrapes of a nickname the
    last by ``seq`` counts; without ``seq`` one of them, the same in every run."""
    scrape = latest_per_key(scrape, ["nickname"], seq, SCRAPED_ATTRIBUTES)
    new = scrape.select("nickname", *[F.col(c).alias(f"_new_{c}") for c in SCRAPED_ATTRIBUTES], F.lit(True).alias("_new"))
    joined = apps.join(new, "nickname", "left")
    return _replace(apps, joined, {c: F.col(f"_new_{c}") for c in SCRAPED_ATTRIBUTES})


def unknown_apps(apps: DataFrame, scrape: DataFrame) -> DataFrame:
    return scrape.join(apps.select("nickname"), "nickname", "left_anti")


def registration_status(apps: DataFrame, candidates: DataFrame, *, seq: str = "seq") -> DataFrame:
    """Candidates with ``app_id`` of the app they match and a ``status``: Duplicate,
    deleted-back, Valid (new and of an accepted category) or Irrelevant.

    Candidates count in ``seq`` order: once an app is added or back, further candidates
    for it are duplicates.
    """
    key = ["app_name", "nickname"]
    accepted = F.col("category").isin(lx.ACCEPTED_APP_CATEGORIES)
    known = apps.select(*key, "app_id", "deleted")
    firsts = candidates.groupBy(*key).agg(
        F.min(seq).alias("_first"), F.min(F.when(accepted, F.col(seq))).alias("_first_accepted")
    )
    is_known = F.col("app_id").isNotNull()
    return candidates.join(firsts.join(known, key, "left"), key).withColumn(
        "status",
        F.when(is_known & F.col("deleted") & (F.col(seq) == F.col("_first")), "deleted-back")
        .when(is_known, "Duplicate")
        .when(F.col(seq) > F.col("_first_accepted"), "Duplicate")
        .when(accepted, "Valid")
        .otherwise("Irrelevant"),
    ).drop("deleted", "_first", "_first_accepted")


def register_app(apps: DataFrame, candidates: DataFrame, *, seq: str = "seq") -> DataFrame:
    """App table after registration: deleted apps come back with the new attributes,
    valid candidates are added with the next ids in ``seq`` order."""
    judged = registration_status(apps, candidates, seq=seq)
    back = judged.filter(F.col("status") == "deleted-back").select(
        "app_id", *[F.col(c).alias(f"_new_{c}") for c in REGISTERED_ATTRIBUTES], F.lit(True).alias("_new")
    )
    changes = {c: F.col(f"_new_{c}") for c in REGISTERED_ATTRIBUTES} | {"deleted": F.lit(False)}
    updated = _replace(apps, apps.join(back, "app_id", "left"), changes)
    valid = _numbered(apps, "app_id", judged.filter(F.col("status") == "Valid").drop("app_id"), seq)
    values = {c: F.col(c) for c in ("app_id", *REGISTERED_ATTRIBUTES)} | {"active": F.lit(True), "deleted": F.lit(False)}
    return updated.unionByName(_as_rows(apps, valid, values))


SNAPSHOT_COLUMNS = [
    "app_id", "app_name", "company", "version", "total_rate", "average_rate", "install", "category", "size",
    "last_update", "nickname",
]


def append_snapshot(apps: DataFrame, scraped_time: Column) -> DataFrame:
    """History rows of a scrape with its time and its Jalali day."""
    return apps.select(
        *SNAPSHOT_COLUMNS,
        scraped_time.alias("app_scraped_time"),
        to_jalali_int(scraped_time.cast("date")).alias("app_scraped_time_jalali"),
    )


def update_scrape_stats(apps: DataFrame, stats: DataFrame) -> DataFrame:
    """Comment counts and last scrape day by app_id; unknown apps are added."""
    columns = ["count_scraped_comments", "count_new_comments", "last_update_comment_scraping"]
    joined, fresh = _split(apps, stats.select("app_id", *columns), ["app_id"])
    updated = _replace(apps, joined, {c: F.col(f"_new_{c}") for c in columns})
    return updated.unionByName(_as_rows(apps, fresh, {c: F.col(c) for c in ("app_id", *columns)}))


def daily_snapshot(apps: DataFrame, scrape: DataFrame, scraped_time: Column) -> DataFrame:
    """One day's run: attributes updated from the scrape, then the history rows of the
    apps that are not deleted and were scraped."""
    updated = upsert_app_info(apps.filter(~F.col("deleted")), scrape)
    return append_snapshot(updated.join(scrape.select("nickname"), "nickname", "left_semi"), scraped_time)


def normalize_scraped(raw: DataFrame, today: Column | None = None) -> DataFrame:
    """Raw strings of a scraped comment -> typed row.

    Rows without an id are left out. The rating is the percentage after the first
    space of the style, over 20; 0 when it cannot be read. A bad date is today.
    """
    today = today if today is not None else F.current_date()
    second = F.get(F.filter(F.split(strip(F.col("style")), r"\s+"), lambda p: p != ""), F.lit(1))
    percent = F.get(F.split(second, "%"), F.lit(0)).try_cast("int")
    parts = r"\A(\d{4})/(\d{1,2})/(\d{1,2})\z"
    part = lambda i: F.lpad(F.regexp_extract("date", parts, i), 2 if i > 1 else 4, "0")
    day = F.when(
        F.rlike("date", F.lit(parts)), F.concat_ws("-", part(1), part(2), part(3)).try_cast("date")
    )
    return (
        raw.withColumn("comment_idd", F.col("raw_id").try_cast("long"))
        .filter(F.col("comment_idd").isNotNull())
        .withColumn("comment_date", F.coalesce(day, today))
        .select(
            "app_id", "user_name", "comment_text",
            F.coalesce(percent / 20, F.lit(0.0)).alias("comment_rating"),
            "comment_date",
            F.lit(False).alias("second_model_processed"),
            "comment_idd",
            to_jalali_int(F.col("comment_date")).alias("comment_date_jalali"),
        )
    )


def backfill_jalali(comments: DataFrame, app_id: int | None = None) -> DataFrame:
    """(comment_id, comment_date_jalali) for the rows whose Jalali day is missing."""
    rows = missing_jalali(comments, app_id).select("comment_id", to_jalali_int(F.col("comment_date")).alias("comment_date_jalali"))
    return rows.filter(F.col("comment_date_jalali").isNotNull())
