"""Files in and out: positional CSV, JSON lines, word lists, report CSVs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.dates import parse_timestamp
from ..functions import lexicon as lx
from ..functions.ids import hash_id, hash_id_or_null
from ..functions.text import strip
from .records import in_record_order, read_records, records_of

FEEDBACK_FIELDS = 9
CORRUPT = "_line"
# Positions of the fields of an assistant file by layout.
ASSISTANT_LAYOUTS = {
    1: {"user_message": 1, "assistant_message": 2, "is_liked": 3, "q1": 5, "q3": 6, "q2": 7, "created_at": 8},
    0: {"user_message": 2, "assistant_message": 3, "is_liked": 4, "q1": 6, "q3": 7, "q2": 8, "created_at": 9},
}


def positional_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)] + [T.StructField(CORRUPT, T.StringType())])


def csv_options(multi_line: bool = True) -> dict[str, str]:
    """Quoted fields may hold line breaks and doubled quotes. Without line breaks in
    fields ``multi_line=False`` lets Spark split large files."""
    return {
        "header": "true", "multiLine": str(multi_line).lower(), "escape": '"', "encoding": "UTF-8",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    }


def field_count(line: Column) -> Column:
    """Number of comma-separated fields outside quotes."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(F.regexp_replace(bare, "[^,]", "")) + 1


def long_enough(rows: DataFrame, fields: int) -> DataFrame:
    """Spark marks rows that are too short and rows that are too long alike; only the
    short ones are left out."""
    # Always true; Spark refuses a scan of the marking column alone, as counting rows would be.
    with_fields = F.coalesce(F.length("c0"), F.lit(0)) >= 0
    return rows.filter(with_fields & (F.col(CORRUPT).isNull() | (field_count(F.col(CORRUPT)) >= fields))).drop(CORRUPT)


def with_places(read: DataFrame) -> DataFrame:
    """Rows of a file source, batch or stream, with the file that each came from."""
    return read.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_time"))


def in_file_order(rows: DataFrame, by_time: bool = False) -> DataFrame:
    """``seq``: number of each row by file and by row within its file.

    Spark reads large files first and in pieces, so the order of its partitions is not that of the files.
    Files follow each other by path, or by time of change and path. Only a row per file and task is
    ordered; the rows themselves are not moved.
    """
    marked = rows.withColumns({"_id": F.monotonically_increasing_id(), "_part": F.spark_partition_id()})
    pieces = marked.groupBy("_path", "_time", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    order = Window.orderBy(*(["_time"] if by_time else []), "_path", "_first").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("_path", "_part", "_first", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_start"))
    return marked.join(starts, ["_path", "_part"]).withColumn("seq", F.col("_start") + F.col("_id") - F.col("_first"))


def positional_rows(spark: SparkSession, path: str, width: int, multi_line: bool, by_time: bool) -> DataFrame:
    """seq and the fields of all rows that have ``width`` of them at least. Files are split over tasks in both forms; ``multi_line=False``
    spares the look at quotes where no field holds a line break."""
    if not multi_line:
        return in_file_order(long_enough(with_places(spark.read.schema(positional_schema(width)).options(**csv_options(False)).csv(path)), width), by_time)
    return in_record_order(_fields(read_records(spark, path), width, "_path", "_time", "_block", "_stitched"), by_time)


def _fields(records: DataFrame, width: int, *kept: str) -> DataFrame:
    """The fields of the records that have ``width`` of them at least."""
    options = {k: v for k, v in csv_options(True).items() if k != "header"}
    fields = F.from_csv("record", positional_schema(width).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    return long_enough(records.select(fields.alias("_fields"), *kept).select("_fields.*", *kept), width)


def feedback_columns(raw: DataFrame, by_time: bool = False) -> DataFrame:
    """Names for the positions; empty title and text stay ''."""
    return _feedback(in_file_order(long_enough(raw, FEEDBACK_FIELDS), by_time))


def feedback_of_lines(lines: DataFrame, by_time: bool = False) -> DataFrame:
    """As ``feedback_columns``, from the lines of the files (``records.lines_of``): a file is read by as many tasks as it has splits.
    ``seq`` ascends in the order of files and rows, with gaps."""
    return _feedback(_fields(records_of(lines, by_time).withColumnRenamed("_place", "seq"), FEEDBACK_FIELDS, "seq"))


def _feedback(rows: DataFrame) -> DataFrame:
    text = lambda i: F.coalesce(F.col(f"c{i}"), F.lit(""))
    return rows.select(
        "seq", text(0).alias("title"), text(1).alias("grade"),
        text(2).alias("description"), text(3).alias("national_code"), text(6).alias("mobile_no"),
        text(7).alias("created_at"), text(8).alias("channel_code"),
    )


def read_feedback_csv(spark: SparkSession, path: str, *, multi_line: bool = True, by_time: bool = False) -> DataFrame:
    """Feedback files as strings. Columns count by position; rows of fewer than nine
    fields are left out, fields after the ninth ignored. ``seq`` keeps the order of files
    (by path, or by time) and of their rows."""
    return _feedback(positional_rows(spark, path, FEEDBACK_FIELDS, multi_line, by_time))


def clean_feedback(raw: DataFrame) -> DataFrame:
    """Typed rows without identifiers in the clear. A bad grade is 0, a bad time drops
    the row, blank channel and phone are null."""
    digits = F.translate(strip(F.col("grade")), lx.PERSIAN_DIGITS, lx.ASCII_DIGITS)
    grade = F.when(F.rlike(digits, F.lit(r"\A[+-]?\d+\z")), digits.try_cast("int"))
    channel = strip(F.col("channel_code"))
    return raw.withColumn("_time", parse_timestamp(F.col("created_at"))).filter(F.col("_time").isNotNull()).select(
        "seq", "title", F.coalesce(grade, F.lit(0)).alias("grade"), "description",
        hash_id(F.col("national_code")).alias("national_code_hash"),
        hash_id_or_null(F.col("mobile_no")).alias("mobile_no_hash"),
        F.col("_time").alias("created_at"),
        F.when(channel != "", channel).alias("channel_code"),
    )


def parse_like(value: Column, layout: int) -> Column:
    """Layout 1: LIKE, DISLIKE, anything else null. Layout 0: true, anything else false."""
    if layout == 1:
        upper = F.upper(strip(value))
        return F.when(upper == "LIKE", True).when(upper == "DISLIKE", False)
    return F.coalesce(F.lower(value) == "true", F.lit(False))


def read_assistant_csv(spark: SparkSession, path: str, layout: int, *, multi_line: bool = True, by_time: bool = False) -> DataFrame:
    """Assistant feedback files in one of two layouts; rows without a time field are rejected."""
    position = ASSISTANT_LAYOUTS[layout]
    width = position["created_at"] + 1
    rows = positional_rows(spark, path, width, multi_line, by_time)
    field = lambda name: F.coalesce(F.col(f"c{position[name]}"), F.lit(""))
    texts = [field(n).alias(n) for n in ("user_message", "assistant_message", "q1", "q2", "q3")]
    return rows.select(
        "seq", *texts, parse_like(field("is_liked"), layout).alias("is_liked"),
        strip(field("created_at")).try_cast("timestamp_ntz").alias("created_at"),
    )


# --- JSON lines ------------------------------------------------------------------------------------
def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    """One object per line; fields without a value are written as null."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


# --- reports and word lists -------------------------------------------------------------------------
def write_ngram_csv(report: DataFrame, path: str, version: str, group: str = "grp") -> None:
    """One folder per version and group with its n-grams; a group without rows gets none.
    Writing a version again replaces its groups; other versions stay."""
    report.withColumn("version", F.lit(version)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("version", group).option("header", "true").csv(path)


def load_stopwords(spark: SparkSession, path: str, *, plain: bool = False) -> DataFrame:
    """Words of a list file: one per line, as they are or in quotes and with commas. A
    file that is not there is an empty list."""
    line = strip(F.col("value"))
    word = line if plain else strip(F.translate(line, "'," + lx.ZWNJ, ""))
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition() or ""):
            raise
        lines = spark.createDataFrame([], "value string")
    words = lines.select(word.alias("word"))
    return words.filter(F.col("word") != "").distinct()


def stopword_list(words: DataFrame) -> list[str]:
    """The words as literals for the functions that take a list: a few hundred as a rule. A word
    list that is large data stays a table (``operators.ngrams.without_words``)."""
    return [row["word"] for row in words.collect()]
