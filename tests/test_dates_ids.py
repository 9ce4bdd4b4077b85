import datetime as dt

import pytest
from pyspark.sql import functions as F

from voxmill.functions import dates, ids

N = None
D = dt.datetime


@pytest.mark.parametrize("text,imported,converted", [
    ("2025-12-24-00.02.26.367590", D(2025, 12, 24, 0, 2, 26), D(2025, 12, 24, 0, 2, 26, 367590)),
    (" 2025-12-24-00.02.26.36 ", N, D(2025, 12, 24, 0, 2, 26, 360000)),
    ("11/29/25 12:05 AM", D(2025, 11, 29, 0, 5), D(2025, 11, 29, 0, 5)),
    ("11/29/2025 12:05 pm", D(2025, 11, 29, 12, 5), D(2025, 11, 29, 12, 5)),
    ("1/2/70 3:04", D(1970, 1, 2, 3, 4), D(1970, 1, 2, 3, 4)),
    ("1/2/68 3:04:05", D(2068, 1, 2, 3, 4, 5), D(2068, 1, 2, 3, 4, 5)),
    ("11/29/2025 13:05 PM", N, N),
    ("02/30/2025 10:00", N, N),
    ("2025-11-29 10:00:00", N, N),
    ("11/29/2025 25:00", N, N),
    ("1404/09/22-23:23", N, D(2025, 12, 13, 23, 23)),
    ("1404/12/30-01:00", N, N),
    ("", N, N),
    (N, N, N),
])
def test_parse(spark, text, imported, converted):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(dates.parse_timestamp(F.col("t")), dates.parse_timestamp_jalali(F.col("t"))).first()
    assert (row[0], row[1]) == (imported, converted)


def test_jalali_known_days(spark):
    days = {"2025-12-13": 14040922, "2025-03-20": 14031230, "1979-02-11": 13571122, "2024-03-20": 14030101}
    df = spark.createDataFrame(list(days.items()), "d string, j int")
    assert df.filter(dates.to_jalali_int(F.col("d").cast("date")) != F.col("j")).count() == 0


def test_jalali_round_trip_for_every_day(spark):
    df = spark.sql("select explode(sequence(date'1900-01-01', date'2099-12-31')) as d")
    back = dates.from_jalali(*dates.to_jalali_parts(F.col("d")))
    assert df.filter(~back.eqNullSafe(F.col("d"))).count() == 0


def test_hash(spark):
    df = spark.createDataFrame([(" 12345 ",), ("123456789012",), ("  ",)], "v string")
    rows = df.select(ids.hash_id(F.col("v")), ids.hash_id_or_null(F.col("v"))).collect()
    assert rows[0][0].startswith("cfe5ec54042c8382") and rows[1][0].startswith("2a33349e7e606a8a")
    assert rows[2][1] is None and rows[2][0] is not None


@pytest.mark.parametrize("url,package,status", [
    ("store.example/app/com.x/", "com.x", N),
    ("https://STORE.example/app/com.x?l=fa", "com.x", N),
    ("https://user@store.example:80/app/com.x#top", "com.x", N),
    ("https://example.org/app/com.x", N, "host-error"),
    ("http://[::1/app", N, "url-error"),
    (N, N, "url-error"),
])
def test_package(spark, url, package, status):
    df = spark.createDataFrame([(url,)], "u string")
    row = df.select(ids.package_name(F.col("u"), "store.example"), ids.package_status(F.col("u"), "store.example")).first()
    assert (row[0], row[1]) == (package, status)
