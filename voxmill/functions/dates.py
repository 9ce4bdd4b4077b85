"""Time stamps and Jalali dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip

# Day number (0001-01-01 = 1) of the day before 1 Farvardin of Jalali year 0.
JALALI_EPOCH = 226530

# Forms of a written time and what they look like as a literal. Two-digit years are
# completed first: 69 to 99 belong to the last century.
IMPORT_DASHED = r"\A(\d{4})-(\d\d)-(\d\d)-(\d{1,2})\.(\d{1,2})\.(\d{1,2})\.\d{1,6}\z", "$1-$2-$3 $4:$5:$6"
DASHED = r"\A(\d{4})-(\d{1,2})-(\d{1,2})-(\d{1,2})\.(\d{1,2})\.(\d{1,2})(\.\d{1,6})\z", "$1-$2-$3 $4:$5:$6$7"
LAST_CENTURY = r"\A(\d{1,2}/\d{1,2}/)(?=(?:69|[7-9]\d)\s)", "$119"
THIS_CENTURY = r"\A(\d{1,2}/\d{1,2}/)(?=\d\d\s)", "$120"
CLOCK_24 = r"\A(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2})\z", "$3-$1-$2 $4:$5:00"
CLOCK_24_SECONDS = r"\A(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})\z", "$3-$1-$2 $4:$5:$6"
CLOCK_12 = r"\A(\d{1,2})/(\d{1,2})/(\d{4})\s+(0?[1-9]|1[0-2]):(\d{1,2})\s+[AaPp][Mm]\z", "$3-$1-$2 $4:$5:00"
JALALI = r"\A(\d{1,4})/(\d{1,2})/(\d{1,2})-(\d{1,2}:\d{1,2})\z"
SHORTEST_DASHED = 23


def _int(column: Column) -> Column:
    return column.cast("int")


def to_jalali_parts(date: Column) -> tuple[Column, Column, Column]:
    day_number = F.date_diff(date, F.lit("0001-01-01").cast("date")) + F.lit(1 - JALALI_EPOCH)
    year = F.floor((day_number * 33 + 11) / 12053).cast("int")
    day_of_year = day_number - 365 * year - F.floor((8 * year + 21) / 33).cast("int")
    first_half = day_of_year < 186
    month = F.when(first_half, F.floor(day_of_year / 31) + 1).otherwise(F.floor((day_of_year - 186) / 30) + 7)
    day = F.when(first_half, day_of_year % 31 + 1).otherwise((day_of_year - 186) % 30 + 1)
    return year, _int(month), _int(day)


def to_jalali_int(date: Column) -> Column:
    """Gregorian date -> Jalali yyyymmdd; null when the value is no date."""
    year, month, day = to_jalali_parts(date)
    return _int(year * 10000 + month * 100 + day)


def from_jalali(year: Column, month: Column, day: Column) -> Column:
    """Jalali year, month, day -> Gregorian date; null for a day that does not exist."""

    def to_date(p: Column) -> Column:
        y, m, d = p["y"], p["m"], p["d"]
        offset = F.when(m <= 7, (m - 1) * 31).otherwise((m - 7) * 30 + 186)
        number = 365 * y + F.floor((8 * y + 21) / 33).cast("int") + offset + d - 1
        date = F.date_add(F.lit("0001-01-01").cast("date"), _int(number + JALALI_EPOCH - 1))
        return let(date, lambda found: F.when(to_jalali_int(found) == y * 10000 + m * 100 + d, found))

    given = F.struct(_int(year).alias("y"), _int(month).alias("m"), _int(day).alias("d"))
    return let(given, to_date)


def _read(text: Column, form: tuple[str, str]) -> Column:
    """Time of a text in one form, else null."""
    pattern, literal = form
    iso = F.regexp_replace(text, F.lit(pattern), F.lit(literal))
    return F.when(F.rlike(text, F.lit(pattern)), iso).try_cast("timestamp_ntz")


def _read_slashed(text: Column) -> Column:
    """Month first, two- or four-digit year, 12-hour clock with AM/PM (no seconds) or 24-hour clock."""
    for pattern, literal in (LAST_CENTURY, THIS_CENTURY):
        text = F.regexp_replace(text, F.lit(pattern), F.lit(literal))

    def read(t: Column) -> Column:
        pattern, literal = CLOCK_12
        morning = F.replace(F.regexp_replace(t, F.lit(pattern), F.lit(literal)), F.lit(" 12:"), F.lit(" 00:"))
        twelve = F.when(F.rlike(t, F.lit(pattern)), morning).try_cast("timestamp_ntz")
        half_day = F.when(F.endswith(F.upper(t), F.lit("PM")), F.expr("INTERVAL 12 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
        return F.coalesce(_read(t, CLOCK_24), _read(t, CLOCK_24_SECONDS), twelve + half_day)

    return let(text, read)


def _read_jalali(text: Column) -> Column:
    """Jalali yyyy/MM/dd-HH:mm"""
    part = lambda i: F.regexp_extract(text, JALALI, i)
    date = from_jalali(*(part(i).try_cast("int") for i in (1, 2, 3)))
    iso = F.concat(date.cast("string"), F.lit(" "), part(4), F.lit(":00"))
    return F.when(F.rlike(text, F.lit(JALALI)), iso).try_cast("timestamp_ntz")


def parse_timestamp(text: Column) -> Column:
    """Import form: the dashed form needs at least 23 characters and loses its
    fraction; then the slashed forms; otherwise null."""

    def read(t: Column) -> Column:
        dashed = F.when(F.length(t) >= SHORTEST_DASHED, t)
        return F.coalesce(_read(dashed, IMPORT_DASHED), _read_slashed(t))

    return let(strip(text), read)


def parse_timestamp_jalali(text: Column) -> Column:
    """Conversion form: the fraction stays and Jalali dates are understood."""
    return let(strip(text), lambda t: F.coalesce(_read(t, DASHED), _read_slashed(t), _read_jalali(t)))


def month_number(time: Column) -> Column:
    """year * 100 + month, the partition column of tables kept by month."""
    return (F.year(time) * 100 + F.month(time)).cast("int")
