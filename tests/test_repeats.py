"""Repeats against a row-by-row loop, on small and on skewed input."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from voxmill.operators import ordering, repeats
from voxmill.streaming import repeats_stream

START = dt.datetime(2025, 1, 1)
SCHEMA = "id long, national_code_hash string, title string, description string, created_at timestamp_ntz"


def by_hand(rows, window):
    found = {}
    anchor = {}
    for id, user, title, text, time in sorted(rows, key=lambda r: (r[1] or "", r[4] or dt.datetime.max, r[0])):
        key = (" ".join((text or "").split()), " ".join((title or "").split()))
        old = anchor.get(user)
        if user is not None and time is not None and old and old[0] == key and (time - old[1]).total_seconds() <= window:
            found[id] = old[2]
        elif time is not None:
            anchor[user] = (key, time, id)
    return found


def by_job(spark, rows, **options):
    flags = repeats.flag_repetitive(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert len(flags) == len(rows)
    assert all(f.is_repetitive == (f.duplicate_of is not None) for f in flags)
    return {f.id: f.duplicate_of for f in flags if f.is_repetitive}


def minutes(*values):
    return [START + dt.timedelta(minutes=m) for m in values]


def test_restart_inside_a_run(spark):
    rows = [(i, "u", "t", " a  b ", t) for i, t in enumerate(minutes(0, 40, 70, 110))]
    assert by_job(spark, rows) == {1: 0, 3: 2}


def test_other_text_between(spark):
    rows = [(i, "u", "t", x, t) for i, (x, t) in enumerate(zip("ABA", minutes(0, 5, 10)))]
    assert by_job(spark, rows) == {}


def test_title_counts_and_case_matters(spark):
    rows = [(0, "u", "t", "a", START), (1, "u", "T", "a", START), (2, "u", "T", "A", START), (3, "v", "T", "A", START)]
    assert by_job(spark, rows) == {}


def test_window_is_inclusive_and_null_user_or_time_never_repeats(spark):
    rows = [(0, "u", "t", "a", START), (1, "u", "t", "a", START + dt.timedelta(seconds=3600)),
            (2, "u", "t", "a", None), (3, None, "t", "a", START), (4, None, "t", "a", START)]
    assert by_job(spark, rows) == {1: 0}


@pytest.mark.parametrize("seed,window,slot", [(1, 600, 3600), (2, 3600, 600), (3, 86400, 3600)])
def test_random_rows_with_one_hot_user(spark, seed, window, slot):
    """Half of the rows belong to one user who mostly repeats one text, so runs are long
    and their chains have many anchors."""
    rng = random.Random(seed)
    rows = []
    for i in range(3000):
        user = "hot" if rng.random() < 0.5 else f"u{rng.randrange(20)}"
        text = "same" if rng.random() < (0.995 if user == "hot" else 0.7) else rng.choice("xy")
        rows.append((i, user, "t", text, START + dt.timedelta(seconds=rng.randrange(10 * 86400))))
    expected = by_hand(rows, window)
    assert expected and by_job(spark, rows, window_seconds=window, slot_seconds=slot) == expected


@pytest.mark.parametrize("seed,window", [(4, 1), (5, 60)])
def test_bursts_are_cut_by_rank(spark, seed, window):
    """Times finer than a second, many of them equal, most rows of one user in one minute."""
    rng = random.Random(seed)
    rows = []
    for i in range(3000):
        user = "hot" if rng.random() < 0.8 else f"u{rng.randrange(5)}"
        time = START + dt.timedelta(milliseconds=rng.randrange(0, 90_000, 25))
        rows.append((i, user, "t", "same" if rng.random() < 0.99 else "x", time))
    expected = by_hand(rows, window)
    assert expected and by_job(spark, rows, window_seconds=window, slot_rows=100) == expected


def test_a_burst_is_read_by_many_tasks(spark):
    """200,000 rows of one user in 200 seconds, a tenth of them at one instant."""
    step = F.when(F.col("id") < 20_000, 0).otherwise(F.col("id") * 1000)
    rows = spark.range(200_000).select("id", F.lit("u").alias("u"), step.alias("t"))
    slots = ordering.slots_by_rank(rows, ["u"], ["t", "id"], "s", 10_000)
    sizes = [r["count"] for r in slots.groupBy("s").count().collect()]
    assert sum(sizes) == 200_000 and len(sizes) >= 10 and max(sizes) <= 30_000
    bounds = slots.groupBy("s").agg(F.min("id").alias("low"), F.max("id").alias("high")).orderBy("s").collect()
    assert all(a.high < b.low for a, b in zip(bounds, bounds[1:]))

    comments = rows.select(
        "id", F.col("u").alias("national_code_hash"), F.lit("t").alias("title"), F.lit("a").alias("description"),
        F.expr("timestampadd(MICROSECOND, t, timestamp_ntz'2025-01-01 00:00:00')").alias("created_at"))
    flags = repeats.flag_repetitive(comments, window_seconds=50, slot_rows=10_000)
    counted = {r.duplicate_of: r["count"] for r in flags.groupBy("duplicate_of").count().collect()}
    # Anchors: the first row, then each first row more than 50 seconds (50,000 rows) later.
    assert counted == {None: 4, 0: 50_000, 50_001: 50_000, 100_002: 50_000, 150_003: 49_996}


def test_stream_in_order_equals_the_loop(spark, tmp_path):
    """Five parts by time, a new start for each: a restart between parts changes nothing. Rows without
    user or time, ties inside a part, and users who stay away longer than the watermark waits."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        time = START + dt.timedelta(seconds=rng.randrange(0, 5 * 86400, 300))
        rows.append((i, f"u{rng.randrange(12)}", "t", rng.choice(["a", "a", " a", "b"]), time))
    rows += [(5000 + d, f"once{d}", "t", "a", START + dt.timedelta(days=d)) for d in range(5)]
    odd = [(9000, None, "t", "a", START), (9001, "u1", "t", "a", None), (9002, "u2", None, None, START + dt.timedelta(days=4, hours=23, minutes=59))]
    expected = by_hand(rows + odd, 7200)
    kept = []
    for day in range(5):
        part = [r for r in rows + odd if (day == 0 if r[4] is None else (r[4] - START).days == day)]
        spark.createDataFrame(part, SCHEMA).coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        stream = (
            repeats_stream.flag_stream(source, window_seconds=7200, late="1 hour").writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/flags")
        )
        stream.awaitTermination()
        kept.append(sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in stream.recentProgress if p["stateOperators"]))
    flags = spark.read.parquet(f"{tmp_path}/flags").collect()
    assert kept == [0] * 5
    assert len(flags) == len(rows + odd) and expected
    assert {f.id: f.duplicate_of for f in flags if f.is_repetitive} == expected


def test_stream_forgets_anchors_that_nothing_can_repeat(spark, tmp_path):
    sizes = []
    for users, day in ((50, 0), (1, 3)):
        part = [(100 * day + u, f"u{u}", "t", "a", START + dt.timedelta(days=day)) for u in range(users)]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        stream = (
            repeats_stream.flag_stream(source, late="1 hour").writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/flags")
        )
        stream.awaitTermination()
        sizes.append(stream.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(f"{tmp_path}/flags").count() == 51
    assert sizes[0] >= 50 and sizes[1] < 10


def test_stream_calls_a_bucket_and_not_each_user(spark, tmp_path):
    """Anchors of all users of a bucket are one row of state and have one timer, and are still told apart."""
    rows = [(10 * u + j, f"u{u}", "t", "a", START + dt.timedelta(minutes=20 * j)) for u in range(300) for j in range(3)]
    for part in (0, 1):
        spark.createDataFrame([r for r in rows if (r[0] % 10 > 1) == part], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        flags = repeats_stream.flag_stream(source, late="1 hour", buckets=4)
        stream = (
            flags.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/flags")
        )
        stream.awaitTermination()
    assert stream.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4 * 3
    repeated = {f.id: f.duplicate_of for f in spark.read.parquet(f"{tmp_path}/flags").collect() if f.is_repetitive}
    assert repeated == {10 * u + j: 10 * u for u in range(300) for j in (1, 2)}


def test_flags_change_only_given_rows(spark):
    table = spark.createDataFrame([(1, True, 9), (2, None, None), (3, True, 8)], "id long, is_repetitive boolean, duplicate_of long")
    flags = spark.createDataFrame([(2, True, 1), (3, False, None)], "id long, is_repetitive boolean, duplicate_of long")
    rows = {r.id: (r.is_repetitive, r.duplicate_of) for r in repeats.apply_flags(table, flags).collect()}
    assert rows == {1: (True, 9), 2: (True, 1), 3: (False, None)}
