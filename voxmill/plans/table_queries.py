"""Selection, upserts, updates, files, apps, dates and identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids
from ..functions import lexicon as lx
from ..operators import merges, repeats, reports, selection
from ..schemas import COMMENTS, COMMENT_RECORD
from ..sources import files
from ..streaming import intake, repeats_stream
from . import sqltext as sq
from .registry import query
from .scratch import scratch_folder
from .views import (
    STORE_HOST, analysis, app_comments, apps, comments, labels, scrapes, sql_pick, table, texts, with_views,
)

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TITLE, OTHER_TITLE = "انتقال وجه", "کارت‌ها"


def shown(df: DataFrame) -> DataFrame:
    """Times and days as text, so that engines cannot disagree on their type."""
    out = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind.startswith("timestamp"):
            out[field.name] = F.date_format(field.name, STAMP)
        elif kind == "date":
            out[field.name] = F.date_format(field.name, "yyyy-MM-dd")
        elif kind == "array":
            out[field.name] = F.array_join(field.name, "|")
    return df.withColumns(out) if out else df


# --- selection --------------------------------------------------------------------------------------
NGRAM_ROWS = "description IS NOT NULL AND is_repetitive = FALSE AND sentiment_score > 0"
NGRAM_COLUMNS = "id, title, grade, description, coalesce(sentiment_result, '') AS sentiment_result"


@query("select_for_ngrams", with_views(
    f"SELECT {NGRAM_COLUMNS} FROM comments_v WHERE {NGRAM_ROWS} AND sentiment_score IN (1, 2) AND title = {sq.lit(TITLE)} "
    "AND created_at >= TIMESTAMP '2024-01-03' AND created_at <= TIMESTAMP '2024-01-25 12:00:00' AND length(description) >= 2", "comments_v"))
def q_select_for_ngrams(spark, sf_dir):
    return selection.select_for_ngrams(
        comments(spark, sf_dir), title=TITLE, sentiment="Negative", start="2024-01-03", end="2024-01-25 12:00:00")


@query("select_for_ngrams_all", with_views(
    f"SELECT {NGRAM_COLUMNS} FROM comments_v WHERE {NGRAM_ROWS} AND length(description) >= 2", "comments_v"))
def q_select_for_ngrams_all(spark, sf_dir):
    return selection.select_for_ngrams(comments(spark, sf_dir), title="all")


@query("select_for_ngrams_limit", with_views(
    f"SELECT * FROM (SELECT {NGRAM_COLUMNS} FROM comments_v WHERE {NGRAM_ROWS} AND sentiment_score IN (1, 2, 3, 4, 5) ORDER BY id LIMIT 200) WHERE length(description) >= 5", "comments_v"))
def q_select_for_ngrams_limit(spark, sf_dir):
    return selection.select_for_ngrams(comments(spark, sf_dir), title="ALL", sentiment="all", limit=200, min_len=5)


UNLABELLED = "(sentiment_result IS NULL OR sentiment_result = '')"


@query("select_for_duplicates", with_views(
    f"SELECT id, title, description FROM comments_v WHERE description IS NOT NULL AND description <> '' AND {UNLABELLED}", "comments_v"))
def q_select_for_duplicates(spark, sf_dir):
    return selection.select_for_duplicates(comments(spark, sf_dir)).select("id", "title", "description")


@query("select_for_sentiment", with_views(
    f"SELECT id, description, grade FROM comments_v WHERE {UNLABELLED} ORDER BY id LIMIT 100", "comments_v"))
def q_select_for_sentiment(spark, sf_dir):
    return selection.select_for_sentiment(comments(spark, sf_dir), limit=100)


@query("select_app_comments", with_views(
    "SELECT comment_id, comment_text, comment_rating FROM app_comments_v WHERE app_id = 3 AND sentiment_score IS NULL", "app_comments_v"))
def q_select_app_comments(spark, sf_dir):
    return selection.select_app_comments(app_comments(spark, sf_dir), 3)


@query("select_unanalyzed", with_views(
    f"""SELECT id AS comment_id, description AS comment_text, sentiment_result, {sq.stamp('created_at')} AS created_at, title
FROM comments_v c WHERE is_repetitive IS FALSE AND description IS NOT NULL AND trim(description) <> '' AND sentiment_score IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM analysis_v a WHERE a.comment_id = c.id AND a.ai_title IS NOT NULL)""", "comments_v", "analysis_v"))
def q_select_unanalyzed(spark, sf_dir):
    return shown(selection.select_unanalyzed(comments(spark, sf_dir), analysis(spark, sf_dir)))


@query("select_for_summary", with_views(
    "SELECT type, category, title, sentiment_result, normalized_title FROM analysis_v WHERE type = 'issue' AND category = 'ui' "
    "AND title = 'error' AND sentiment_result = 'positive'", "analysis_v"))
def q_select_for_summary(spark, sf_dir):
    return selection.select_for_summary(analysis(spark, sf_dir), type="issue", category="ui", title="error", sentiment="positive")


@query("select_for_summary_range", with_views(
    "SELECT type, category, title, sentiment_result, normalized_title FROM analysis_v WHERE type = 'issue' AND category = 'auth' "
    "AND title = 'view' AND sentiment_result IN ('very negative', 'negative', 'mixed') "
    "AND created_at BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-20'", "analysis_v"))
def q_select_for_summary_range(spark, sf_dir):
    return selection.select_for_summary(
        analysis(spark, sf_dir), type="issue", category="auth", title="view",
        sentiment=["very negative", "negative", "mixed"], start="2024-01-04", end="2024-01-20")


@query("apps_to_scan", with_views(
    """SELECT 'kept' AS form, app_id, nickname, url FROM apps_v WHERE NOT deleted
UNION ALL SELECT 'listed', app_id, nickname, url FROM apps_v WHERE app_id IN (1, 2, 3, 4, 5, 8) AND active AND NOT deleted
UNION ALL SELECT 'every', app_id, nickname, url FROM apps_v""", "apps_v"))
def q_apps_to_scan(spark, sf_dir):
    all_apps = apps(spark, sf_dir)
    forms = {
        "kept": selection.apps_to_scan(all_apps),
        "listed": selection.apps_to_scan(all_apps, [1, 2, 3, 4, 5, 8]),
        "every": selection.apps_to_scan(all_apps, every=True),
    }
    return reports.stack_reports(forms, label="form")


@query("limit_period", with_views(
    "SELECT 'after' AS form, * FROM labels_v WHERE year = 1377 AND month > 4 AND rating < 6 AND sentiment IN ('very negative', 'negative') "
    "UNION ALL SELECT 'in', * FROM labels_v WHERE year = 1377 AND month = 4", "labels_v"))
def q_limit_period(spark, sf_dir):
    rows = labels(spark, sf_dir).drop("Unnamed: 0")
    return reports.stack_reports({
        "after": selection.limit_period(rows, year=1377, month=4),
        "in": selection.limit_period(rows, year=1377, month=4, after=False, sentiments=None, rating_below=None),
    }, label="form")


# --- reports -------------------------------------------------------------------------------------------
@query("load_exports", with_views(
    "SELECT * FROM labels_v WHERE year >= 1376 UNION ALL SELECT * FROM labels_v WHERE year >= 1376", "labels_v"))
def q_load_exports(spark, sf_dir):
    export = labels(spark, sf_dir)
    return reports.load_exports([export, export], from_year=1376)


MONTHLY = "monthly AS (SELECT year, month, sentiment, count(rating) AS rating_count FROM labels_v GROUP BY year, month, sentiment)"


@query("sentiment_by_month", with_views(f", {MONTHLY} SELECT * FROM monthly", "labels_v"))
def q_sentiment_by_month(spark, sf_dir):
    return reports.sentiment_by_month(labels(spark, sf_dir))


@query("sentiment_by_year", with_views(
    f", {MONTHLY} SELECT year, sentiment, round(avg(rating_count), 6) AS mean_count, CAST(sum(rating_count) AS BIGINT) AS sum_count FROM monthly GROUP BY year, sentiment", "labels_v"))
def q_sentiment_by_year(spark, sf_dir):
    yearly = reports.sentiment_by_year(reports.sentiment_by_month(labels(spark, sf_dir)))
    return yearly.withColumn("mean_count", F.round("mean_count", 6))


# --- repeats ----------------------------------------------------------------------------------------------
def sql_repeats(text: str, window: int, user: str = "user_id", time: str = "ts") -> str:
    """The chain followed row by row."""
    return f"""WITH RECURSIVE r AS (
  SELECT event_id AS id, {user} AS u, {time} AS ts, {text} AS x, row_number() OVER (PARTITION BY {user} ORDER BY {time}, event_id) AS rn FROM events),
f AS (
  SELECT id, u, ts, x, rn, id AS a_id, ts AS a_ts, CAST(NULL AS BIGINT) AS duplicate_of FROM r WHERE rn = 1
  UNION ALL
  SELECT r.id, r.u, r.ts, r.x, r.rn,
         CASE WHEN r.x = f.x AND r.ts - f.a_ts <= INTERVAL {window} SECOND THEN f.a_id ELSE r.id END,
         CASE WHEN r.x = f.x AND r.ts - f.a_ts <= INTERVAL {window} SECOND THEN f.a_ts ELSE r.ts END,
         CASE WHEN r.x = f.x AND r.ts - f.a_ts <= INTERVAL {window} SECOND THEN f.a_id END
  FROM f JOIN r ON r.u = f.u AND r.rn = f.rn + 1)
SELECT id, duplicate_of IS NOT NULL AS is_repetitive, duplicate_of FROM f"""


def _repeat_rows(spark, sf_dir, text, user="user_id", time="ts"):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.expr(user).alias("national_code_hash"), F.expr(text).alias("description"),
        F.expr(text).alias("title"), F.expr(time).alias("created_at"))


DENSE = "CASE WHEN event_type = 'error' THEN 'b' ELSE ' a' END"


@query("flag_repetitive", sql_repeats("event_type", 3600))
def q_flag_repetitive(spark, sf_dir):
    return repeats.flag_repetitive(_repeat_rows(spark, sf_dir, "event_type"))


@query("flag_repetitive_chains", sql_repeats(DENSE, 86400))
def q_flag_repetitive_chains(spark, sf_dir):
    return repeats.flag_repetitive(_repeat_rows(spark, sf_dir, DENSE), window_seconds=86400, slot_seconds=43200)


# All events of eight users inside one hour, to the microsecond: a slot of time holds an eighth of the table.
BURST = ("timestampadd(MICROSECOND, timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) % 3600000000, "
         "timestamp_ntz'2025-01-01 00:00:00')")


@query("flag_repetitive_burst", sql_repeats(DENSE, 240, user="user_id % 8", time="TIMESTAMP '2025-01-01 00:00:00' + to_microseconds(epoch_us(ts) % 3600000000)"))
def q_flag_repetitive_burst(spark, sf_dir):
    return repeats.flag_repetitive(_repeat_rows(spark, sf_dir, DENSE, user="user_id % 8", time=BURST), window_seconds=240, slot_rows=500)


@query("apply_flags", with_views(
    f""", f AS ({sql_repeats('event_type', 3600)})
SELECT id, CASE WHEN f.id IS NOT NULL THEN f.is_repetitive ELSE c.is_repetitive END AS is_repetitive,
       CASE WHEN f.id IS NOT NULL THEN f.duplicate_of ELSE c.duplicate_of END AS duplicate_of
FROM comments_v c LEFT JOIN f USING (id)""", "comments_v"))
def q_apply_flags(spark, sf_dir):
    flags = repeats.flag_repetitive(_repeat_rows(spark, sf_dir, "event_type"))
    return repeats.apply_flags(comments(spark, sf_dir), flags).select("id", "is_repetitive", "duplicate_of")


@query("reset_flags", with_views("SELECT id, FALSE AS is_repetitive, CAST(NULL AS BIGINT) AS duplicate_of FROM comments_v", "comments_v"))
def q_reset_flags(spark, sf_dir):
    return repeats.reset_flags(comments(spark, sf_dir)).select("id", "is_repetitive", "duplicate_of")


# --- feedback files ------------------------------------------------------------------------------------------
GRADES = ["5", " ۴ ", "+3", "bad", "", "2.5", "-1"]
TIME_FORMS = [
    "yyyy-MM-dd-HH.mm.ss.SSSSSS", "MM/dd/yy hh:mm a", "MM/dd/yyyy hh:mm a", "MM/dd/yy HH:mm", "MM/dd/yyyy HH:mm",
    "M/d/yy H:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm",
]
SQL_TIME_FORMS = [
    "%Y-%m-%d-%H.%M.%S.%f", "%m/%d/%y %I:%M %p", "%m/%d/%Y %I:%M %p", "%m/%d/%y %H:%M", "%m/%d/%Y %H:%M",
    "%-m/%-d/%y %-H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y-%m-%d %H:%M",
]


def written_time(time, form):
    """A time in one of the forms seen in feedback files; the last one is not understood."""
    made = F.when(F.lit(False), "")
    for i, pattern in enumerate(TIME_FORMS):
        made = made.when(form == i, F.date_format(time, pattern))
    return made


SQL_WRITTEN_TIME = "CASE event_id % 8 " + " ".join(
    f"WHEN {i} THEN strftime(ts, {sq.lit(p)})" for i, p in enumerate(SQL_TIME_FORMS)) + " END"


def feedback_file(spark, sf_dir):
    """Columns of a feedback file, made from events."""
    e = F.col("event_id")
    from .views import REMARKS, pick
    return table(spark, sf_dir, "events").select(
        e.alias("seq"), "event_type", pick(REMARKS, e % len(REMARKS)).alias("remark"), pick(GRADES, e % len(GRADES)).alias("grade"),
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("national_code"),
        F.when(e % 3 == 0, " ").otherwise(F.concat(F.lit("0912"), e.cast("string"), F.lit("000000"))).alias("mobile_no"),
        written_time(F.col("ts"), e % 8).alias("created_at"),
        F.when(e % 4 == 0, " ").otherwise(F.concat(F.lit(" c"), (e % 4).cast("string"), F.lit(" "))).alias("channel_code"))


def _remark(alias):
    from .views import REMARKS
    return f"{sql_pick(REMARKS, f'event_id % {len(REMARKS)}')} AS {alias}"


SQL_FEEDBACK = f"""file_v AS (SELECT event_id AS seq, event_type, ts, {_remark('remark')}, {sql_pick(GRADES, f'event_id % {len(GRADES)}')} AS grade,
  ' ' || CAST(user_id AS VARCHAR) AS national_code, CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '0912' || CAST(event_id AS VARCHAR) || '000000' END AS mobile_no,
  {SQL_WRITTEN_TIME} AS created_at, CASE WHEN event_id % 4 = 0 THEN ' ' ELSE ' c' || CAST(event_id % 4 AS VARCHAR) || ' ' END AS channel_code,
  event_id % 8 AS form FROM events)"""
SQL_PAD = "CASE WHEN length({0}) < 10 THEN lpad({0}, 10, '0') ELSE {0} END"
SQL_CLEAN = f"""clean_v AS (SELECT seq, coalesce(TRY_CAST(replace(trim({sq.fa_digits('grade')}), '2.5', 'x') AS INTEGER), 0) AS grade, event_type AS title,
  coalesce(remark, '') AS description, sha256({SQL_PAD.format('trim(national_code)')}) AS national_code_hash,
  CASE WHEN trim(mobile_no) <> '' THEN sha256({SQL_PAD.format('trim(mobile_no)')}) END AS mobile_no_hash,
  CASE WHEN form IN (0, 5, 6) THEN date_trunc('second', ts) ELSE date_trunc('minute', ts) END AS created_at,
  nullif(trim(channel_code), '') AS channel_code FROM file_v WHERE form <> 7)"""


def write_feedback(spark, sf_dir, path, part=None, mark=""):
    rows = feedback_file(spark, sf_dir)
    if part is not None:
        rows = rows.filter(part)
    columns = [
        F.concat("event_type", F.lit(mark)).alias("TITLE"), F.col("grade").alias("GRADE"), F.col("remark").alias("DESCRIPTION"),
        F.col("national_code").alias("NATIONAL_CODE"), F.lit("first, name").alias("REAL_FIRST_NAME"), F.lit('"last"').alias("REAL_LAST_NAME"),
        F.col("mobile_no").alias("MOBILE_NO"), F.col("created_at").alias("CREATED_AT"), F.col("channel_code").alias("Channel"),
    ]
    # Files by ranges of the order: as many tasks as there is data for, each file in order.
    rows.orderBy("seq").select(*columns).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="").csv(path)
    return path


@query("read_feedback_csv", f"""WITH {SQL_FEEDBACK} SELECT event_type AS title, grade, coalesce(remark, '') AS description, national_code, mobile_no,
  created_at, channel_code FROM file_v""")
def q_read_feedback_csv(spark, sf_dir):
    return files.read_feedback_csv(spark, write_feedback(spark, sf_dir, scratch_folder(spark))).drop("seq")


# Three folders of unlike size: a small one, all rows, and one between; a later file wins, the first channel stays.
FILE_PARTS = {"1": "seq % 7 = 0", "2": "seq >= 0", "3": "seq % 5 = 0"}
SQL_FILES = " UNION ALL ".join(f"SELECT {n} AS file, * FROM clean_v WHERE {part}" for n, part in FILE_PARTS.items())


@query("upsert_from_files", f"""WITH {SQL_FEEDBACK}, {SQL_CLEAN}, f AS ({SQL_FILES})
SELECT national_code_hash, {sq.stamp('created_at')} AS created_at, arg_max(title || file, CAST(file AS BIGINT) * 1000000000 + seq) AS title,
  arg_min(channel_code, CAST(file AS BIGINT) * 1000000000 + seq) FILTER (WHERE channel_code IS NOT NULL) AS channel_code
FROM (SELECT file, seq, title, channel_code, national_code_hash, created_at FROM f) GROUP BY national_code_hash, f.created_at""".replace("f.created_at", "created_at"))
def q_upsert_from_files(spark, sf_dir):
    from ..schemas import COMMENTS
    folder = scratch_folder(spark)
    for n, part in FILE_PARTS.items():
        write_feedback(spark, sf_dir, f"{folder}/{n}", F.expr(part), mark=n)
    batch = files.clean_feedback(files.read_feedback_csv(spark, f"{folder}/*"))
    merged = merges.upsert_comments(spark.createDataFrame([], COMMENTS), batch, imported_at=F.lit("2024-07-01").cast("timestamp"))
    return shown(merged.select("national_code_hash", "created_at", "title", "channel_code"))


@query("clean_feedback", f"""WITH {SQL_FEEDBACK}, {SQL_CLEAN} SELECT seq, title, grade, description, national_code_hash, mobile_no_hash,
  {sq.stamp('created_at')} AS created_at, channel_code FROM clean_v""")
def q_clean_feedback(spark, sf_dir):
    raw = feedback_file(spark, sf_dir).select(
        "seq", F.col("event_type").alias("title"), "grade", F.coalesce("remark", F.lit("")).alias("description"),
        "national_code", "mobile_no", "created_at", "channel_code")
    return shown(files.clean_feedback(raw))


LIKES = ["LIKE", " dislike ", "", None, "meh", "TRUE", "false", "True "]


@query("parse_like", with_views(
    f"""SELECT id, CASE upper(trim(v)) WHEN 'LIKE' THEN TRUE WHEN 'DISLIKE' THEN FALSE END AS layout1, coalesce(lower(v) = 'true', FALSE) AS layout0
FROM (SELECT id, {sql_pick(LIKES, 'id % 8')} AS v FROM comments_v)""", "comments_v"))
def q_parse_like(spark, sf_dir):
    from .views import pick
    value = pick(LIKES, F.col("id") % 8)
    return comments(spark, sf_dir).select("id", files.parse_like(value, 1).alias("layout1"), files.parse_like(value, 0).alias("layout0"))


# Assistant turns: a user turn and the answer after it.
def assistant_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    answers = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    asked = turns.filter(F.col("role") == "user").join(answers, ["conv_id", "turn"], "left")
    return asked.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), F.col("text").alias("user_message"),
        F.coalesce("answer", F.lit("")).alias("assistant_message"),
        F.when(F.col("turn") % 3 == 0, "LIKE").when(F.col("turn") % 3 == 1, "").otherwise("DISLIKE").alias("liked"),
        F.when(F.col("conv_id") % 2 == 0, "").otherwise("q1").alias("q1"), F.lit("q2").alias("q2"), F.lit("").alias("q3"),
        F.date_format(F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, cast(conv_id % 50 as int), 0)"), "yyyy-MM-dd HH:mm:ss").alias("created_at"))


SQL_TURNS = """turns_v AS (SELECT q.conv_id * 1000 + q.turn AS seq, q.text AS user_message, coalesce(a.text, '') AS assistant_message,
  CASE q.turn % 3 WHEN 0 THEN 'LIKE' WHEN 1 THEN '' ELSE 'DISLIKE' END AS liked, CASE WHEN q.conv_id % 2 = 0 THEN '' ELSE 'q1' END AS q1,
  'q2' AS q2, '' AS q3, TIMESTAMP '2025-01-01' + to_minutes(CAST(q.conv_id % 50 AS BIGINT)) AS created_at
  FROM conversations q LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 WHERE q.role = 'user')"""


@query("read_assistant_csv", f"""WITH {SQL_TURNS} SELECT layout, user_message, assistant_message, q1, q2, q3, {sq.stamp('created_at')} AS created_at,
  CASE WHEN layout = 1 THEN CASE liked WHEN 'LIKE' THEN TRUE WHEN 'DISLIKE' THEN FALSE END ELSE FALSE END AS is_liked
FROM turns_v, (SELECT unnest([0, 1]) AS layout)""")
def q_read_assistant_csv(spark, sf_dir):
    turns = assistant_turns(spark, sf_dir)
    read = {}
    for layout, places in files.ASSISTANT_LAYOUTS.items():
        path = scratch_folder(spark)
        sources = {places[n]: ("liked" if n == "is_liked" else n) for n in places}
        columns = [F.col(sources[i]).alias(f"h{i}") if i in sources else F.lit("-").alias(f"h{i}") for i in range(max(sources) + 1)]
        turns.select(*columns).write.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="").csv(path)
        read[layout] = files.read_assistant_csv(spark, path, layout).drop("seq").withColumn("layout", F.lit(layout))
    return shown(read[0].unionByName(read[1]))


# --- upserts ---------------------------------------------------------------------------------------------------
def comments_table(spark, sf_dir):
    """Table content before a load: one row per user and time."""
    rows = comments(spark, sf_dir)
    return rows.select(*COMMENTS.fieldNames())


def comments_batch(spark, sf_dir):
    """A load from the same events: some keys of the table again, some new, many twice."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("new "), "event_type").alias("title"), F.lit(9).alias("grade"),
        F.concat(F.lit("text "), F.col("event_id").cast("string")).alias("description"),
        F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("m"), F.col("event_id").cast("string"))).alias("mobile_no_hash"),
        F.col("user_id").cast("string").alias("national_code_hash"),
        F.when(F.col("event_id") % 3 == 0, F.col("ts")).otherwise(F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("created_at"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("b"), F.col("event_id").cast("string"))).alias("channel_code"))


SQL_BATCH = """batch_v AS (SELECT event_id AS seq, 'new ' || event_type AS title, 9 AS grade, 'text ' || CAST(event_id AS VARCHAR) AS description,
  CASE WHEN event_id % 5 > 0 THEN 'm' || CAST(event_id AS VARCHAR) END AS mobile_no_hash, CAST(user_id AS VARCHAR) AS national_code_hash,
  CASE WHEN event_id % 3 = 0 THEN ts ELSE date_trunc('day', ts) END AS created_at,
  CASE WHEN event_id % 2 = 0 THEN 'b' || CAST(event_id AS VARCHAR) END AS channel_code FROM events),
last_v AS (SELECT *, min(seq) OVER (PARTITION BY national_code_hash, created_at) AS first_seq,
  row_number() OVER (PARTITION BY national_code_hash, created_at ORDER BY seq DESC) AS r FROM batch_v),
one_v AS (SELECT national_code_hash, created_at, title, grade, description, mobile_no_hash, first_seq AS seq,
  (SELECT b.channel_code FROM batch_v b WHERE b.national_code_hash = l.national_code_hash AND b.created_at = l.created_at
   AND b.channel_code IS NOT NULL ORDER BY b.seq LIMIT 1) AS channel_code FROM (SELECT * FROM last_v WHERE r = 1) l)"""


@query("upsert_comments", with_views(f""", {SQL_BATCH},
fresh AS (SELECT o.*, (SELECT max(id) FROM comments_v) + row_number() OVER (ORDER BY seq) AS id FROM one_v o
  WHERE NOT EXISTS (SELECT 1 FROM comments_v c WHERE c.national_code_hash = o.national_code_hash AND c.created_at = o.created_at))
SELECT c.id, national_code_hash, {sq.stamp('created_at')} AS created_at, CASE WHEN o.seq IS NULL THEN c.title ELSE o.title END AS title,
  CASE WHEN o.seq IS NULL THEN c.grade ELSE o.grade END AS grade, CASE WHEN o.seq IS NULL THEN c.description ELSE o.description END AS description,
  CASE WHEN o.seq IS NULL THEN c.mobile_no_hash ELSE o.mobile_no_hash END AS mobile_no_hash, coalesce(c.channel_code, o.channel_code) AS channel_code,
  CASE WHEN o.seq IS NULL THEN '2024-06-01' ELSE '2024-07-01' END AS imported, c.sentiment_result
FROM comments_v c LEFT JOIN one_v o USING (national_code_hash, created_at)
UNION ALL SELECT id, national_code_hash, {sq.stamp('created_at')}, title, grade, description, mobile_no_hash, channel_code, '2024-07-01', NULL FROM fresh""", "comments_v"))
def q_upsert_comments(spark, sf_dir):
    merged = merges.upsert_comments(
        comments_table(spark, sf_dir), comments_batch(spark, sf_dir), imported_at=F.lit("2024-07-01").cast("timestamp"))
    return shown(merged.select(
        "id", "national_code_hash", "created_at", "title", "grade", "description", "mobile_no_hash", "channel_code",
        F.date_format("imported_at", "yyyy-MM-dd").alias("imported"), "sentiment_result"))


@query("upsert_assistant", f"""WITH {SQL_TURNS},
old AS (SELECT min(seq) AS turn_id, user_message, created_at FROM turns_v GROUP BY user_message, created_at HAVING max(assistant_message) <> ''),
batch AS (SELECT *, row_number() OVER (PARTITION BY user_message, created_at ORDER BY seq DESC) AS r,
  min(seq) OVER (PARTITION BY user_message, created_at) AS first_seq FROM turns_v),
one AS (SELECT * FROM batch WHERE r = 1),
fresh AS (SELECT one.*, (SELECT max(turn_id) FROM old) + row_number() OVER (ORDER BY first_seq) AS turn_id FROM one
  WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.user_message = one.user_message AND old.created_at = one.created_at)),
every AS (SELECT old.turn_id, old.user_message, old.created_at, one.assistant_message, one.liked, one.q1, '2024-06-01' AS imported
  FROM old JOIN one USING (user_message, created_at)
  UNION ALL SELECT turn_id, user_message, created_at, assistant_message, liked, q1, '2024-07-01' FROM fresh)
SELECT turn_id, user_message, {sq.stamp('created_at')} AS created_at, assistant_message,
  CASE liked WHEN 'LIKE' THEN TRUE WHEN 'DISLIKE' THEN FALSE END AS is_liked, nullif(q1, '') AS q1, 'q2' AS q2, CAST(NULL AS VARCHAR) AS q3, imported FROM every""")
def q_upsert_assistant(spark, sf_dir):
    batch = assistant_turns(spark, sf_dir).select(
        "seq", "user_message", "assistant_message", files.parse_like(F.col("liked"), 1).alias("is_liked"), "q1", "q2", "q3",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"))
    answered = F.max("assistant_message") != ""  # the answered turns are in the table already
    known = batch.groupBy("user_message", "created_at").agg(F.min("seq").alias("turn_id"), answered.alias("_known")).filter("_known")
    target = known.select(
        "turn_id", "user_message", F.lit("old").alias("assistant_message"), F.lit("2024-06-01").cast("timestamp").alias("imported_at"),
        F.lit(None).cast("boolean").alias("is_liked"), "created_at",
        *[F.lit(None).cast("string").alias(q) for q in ("q1", "q2", "q3")])
    merged = merges.upsert_assistant(target, batch, imported_at=F.lit("2024-07-01").cast("timestamp"))
    return shown(merged.withColumn("imported", F.date_format("imported_at", "yyyy-MM-dd")).drop("imported_at"))


@query("insert_if_absent", with_views(
    """SELECT o_orderkey AS comment_idd, o_orderpriority AS comment_text FROM orders
WHERE NOT EXISTS (SELECT 1 FROM app_comments_v a WHERE a.comment_idd = o_orderkey)""", "app_comments_v"))
def q_insert_if_absent(spark, sf_dir):
    batch = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("comment_idd"), F.col("o_orderpriority").alias("comment_text"))
    later = batch.withColumn("comment_text", F.lit("later"))
    both = batch.withColumn("seq", F.lit(1)).unionByName(later.withColumn("seq", F.lit(2)))
    return merges.insert_if_absent(app_comments(spark, sf_dir), both, order="seq").drop("seq")


@query("upsert_analysis", with_views(
    f"""SELECT comment_id, {sq.stamp('coalesce(a.created_at, n.created_at)')} AS created_at, CASE WHEN n.comment_id IS NULL THEN a.type ELSE 'praise' END AS type,
CASE WHEN n.comment_id IS NULL THEN a.category ELSE 'ui' END AS category, CASE WHEN n.comment_id IS NULL THEN array_to_string(a.keywords, '|') ELSE 'k' END AS keywords,
CASE WHEN n.comment_id IS NULL THEN a.ai_title ELSE 'card' END AS ai_title, CASE WHEN n.comment_id IS NULL THEN a.title ELSE n.title END AS title,
CASE WHEN n.comment_id IS NULL THEN '2024-06-01' ELSE '2024-07-01' END AS processed
FROM analysis_v a FULL JOIN (SELECT o_orderkey AS comment_id, o_orderdate AS created_at, o_orderpriority AS title FROM orders) n USING (comment_id)""", "analysis_v"))
def q_upsert_analysis(spark, sf_dir):
    target = analysis(spark, sf_dir)
    text = {c: F.lit("new") for c in ("sentiment_result", "short_title", "normalized_title", "evidence", "model")}
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("comment_id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderpriority").alias("title"),
        F.lit("praise").alias("type"), F.lit("ui").alias("category"), F.array(F.lit("k")).alias("keywords"), F.lit("card").alias("ai_title"),
        *[v.alias(c) for c, v in text.items()])
    merged = merges.upsert_analysis(target, rows, processed_at=F.lit("2024-07-01").cast("timestamp"))
    return shown(merged.select(
        "comment_id", "created_at", "type", "category", "keywords", "ai_title", "title",
        F.date_format("processed_at", "yyyy-MM-dd").alias("processed")))


@query("mark_analyzed", with_views(
    "SELECT id, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.id) THEN TRUE ELSE is_analyzed END AS is_analyzed FROM comments_v c", "comments_v"))
def q_mark_analyzed(spark, sf_dir):
    written = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return merges.mark_analyzed(comments(spark, sf_dir), written).select("id", "is_analyzed")


@query("import_audit", "SELECT (SELECT count(*) FROM events) AS rows_before, (SELECT count(*) FROM orders) AS rows_after")
def q_import_audit(spark, sf_dir):
    return merges.import_audit(table(spark, sf_dir, "events"), table(spark, sf_dir, "orders"))


# --- JSON lines and report files -----------------------------------------------------------------------------------
@query("jsonl_roundtrip", with_views(
    "SELECT CAST(id AS VARCHAR) AS comment_id, description AS evidence, title AS short_title, grp AS sentiment_group, "
    "CASE WHEN id % 2 = 0 THEN 'high' END AS severity, grp || '|' || 'x' AS keywords FROM texts_v", "texts_v"))
def q_jsonl_roundtrip(spark, sf_dir):
    path = scratch_folder(spark)
    rows = texts(spark, sf_dir).select(
        F.col("id").cast("string").alias("comment_id"), F.col("description").alias("evidence"), F.col("title").alias("short_title"),
        F.col("grp").alias("sentiment_group"), F.when(F.col("id") % 2 == 0, "high").alias("severity"), F.array("grp", F.lit("x")).alias("keywords"))
    files.append_jsonl(rows, path)
    back = files.read_jsonl(spark, path, COMMENT_RECORD)
    return shown(back.select("comment_id", "evidence", "short_title", "sentiment_group", "severity", "keywords"))


# --- apps ------------------------------------------------------------------------------------------------------------
UPDATED = merges.SCRAPED_ATTRIBUTES


@query("upsert_app_info", with_views(
    f"""SELECT app_id, a.nickname, a.app_name, {', '.join(f'CASE WHEN s.seq IS NULL THEN a.{c} ELSE s.{c} END AS {c}' for c in UPDATED)}
FROM apps_v a LEFT JOIN scrapes_v s USING (nickname)""", "apps_v"))
def q_upsert_app_info(spark, sf_dir):
    return merges.upsert_app_info(apps(spark, sf_dir), scrapes(spark, sf_dir)).select("app_id", "nickname", "app_name", *UPDATED)


@query("unknown_apps", with_views("SELECT seq, nickname FROM scrapes_v s WHERE NOT EXISTS (SELECT 1 FROM apps_v a WHERE a.nickname = s.nickname)", "apps_v"))
def q_unknown_apps(spark, sf_dir):
    return merges.unknown_apps(apps(spark, sf_dir), scrapes(spark, sf_dir)).select("seq", "nickname")


JUDGED = f"""judged AS (SELECT s.*, a.app_id, CASE WHEN a.app_id IS NOT NULL AND a.deleted THEN 'deleted-back' WHEN a.app_id IS NOT NULL THEN 'Duplicate'
  WHEN s.category IN {sq.in_list(lx.ACCEPTED_APP_CATEGORIES)} THEN 'Valid' ELSE 'Irrelevant' END AS status
  FROM scrapes_v s LEFT JOIN apps_v a ON a.app_name = s.app_name AND a.nickname = s.nickname)"""


@query("registration_status", with_views(f", {JUDGED} SELECT seq, nickname, app_id, status FROM judged", "apps_v"))
def q_registration_status(spark, sf_dir):
    return merges.registration_status(apps(spark, sf_dir), scrapes(spark, sf_dir)).select("seq", "nickname", "app_id", "status")


@query("register_app", with_views(
    f""", {JUDGED}
SELECT a.app_id, a.nickname, a.app_name, CASE WHEN j.seq IS NULL THEN a.company ELSE j.company END AS company, CASE WHEN j.seq IS NULL THEN a.url ELSE j.url END AS url,
  CASE WHEN j.seq IS NULL THEN a.category ELSE j.category END AS category, CASE WHEN j.seq IS NULL THEN a.deleted ELSE FALSE END AS deleted
FROM apps_v a LEFT JOIN (SELECT * FROM judged WHERE status = 'deleted-back') j ON j.app_id = a.app_id
UNION ALL SELECT (SELECT max(app_id) FROM apps_v) + row_number() OVER (ORDER BY seq), nickname, app_name, company, url, category, FALSE FROM judged WHERE status = 'Valid'""", "apps_v"))
def q_register_app(spark, sf_dir):
    return merges.register_app(apps(spark, sf_dir), scrapes(spark, sf_dir)).select(
        "app_id", "nickname", "app_name", "company", "url", "category", "deleted")


@query("append_snapshot", with_views(
    "SELECT app_id, nickname, company, category, '2025-12-13 07:33:00.000000' AS app_scraped_time, 14040922 AS app_scraped_time_jalali FROM apps_v", "apps_v"))
def q_append_snapshot(spark, sf_dir):
    rows = merges.append_snapshot(apps(spark, sf_dir), F.lit("2025-12-13 07:33:00").cast("timestamp_ntz"))
    return shown(rows.select("app_id", "nickname", "company", "category", "app_scraped_time", "app_scraped_time_jalali"))


@query("daily_snapshot", with_views(
    """SELECT app_id, nickname, app_name, s.company, s.category, '2025-03-20 07:33:00.000000' AS app_scraped_time, 14031230 AS app_scraped_time_jalali
FROM (SELECT app_id, nickname, app_name FROM apps_v WHERE NOT deleted) a JOIN (SELECT nickname, company, category FROM scrapes_v) s USING (nickname)""", "apps_v"))
def q_daily_snapshot(spark, sf_dir):
    rows = merges.daily_snapshot(apps(spark, sf_dir), scrapes(spark, sf_dir), F.lit("2025-03-20 07:33:00").cast("timestamp_ntz"))
    return shown(rows.select("app_id", "nickname", "app_name", "company", "category", "app_scraped_time", "app_scraped_time_jalali"))


STATS = """stats AS (SELECT CAST(o_custkey AS BIGINT) AS app_id, count(*) AS seen, CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS fresh FROM orders GROUP BY o_custkey)"""


@query("update_scrape_stats", with_views(
    f""", {STATS} SELECT app_id, nickname, seen AS count_scraped_comments, fresh AS count_new_comments,
CASE WHEN seen IS NOT NULL THEN 14040922 END AS last_update_comment_scraping FROM apps_v FULL JOIN stats USING (app_id)""", "apps_v"))
def q_update_scrape_stats(spark, sf_dir):
    stats = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("long").alias("app_id")).agg(
        F.count(F.lit(1)).alias("count_scraped_comments"), F.count_if(F.col("o_orderstatus") == "O").alias("count_new_comments"),
    ).withColumn("last_update_comment_scraping", F.lit(14040922))
    return merges.update_scrape_stats(apps(spark, sf_dir), stats).select(
        "app_id", "nickname", "count_scraped_comments", "count_new_comments", "last_update_comment_scraping")


STYLES = ["width: 80%;", "width: 100%; x", "width:60%", "", None, "width: 45.5%;", "  width:   20% "]


@query("normalize_scraped", f"""SELECT o_custkey AS app_id, o_orderpriority AS comment_text, o_orderkey AS comment_idd,
  coalesce(CASE o_orderkey % 7 WHEN 0 THEN 4.0 WHEN 1 THEN 5.0 WHEN 6 THEN 1.0 END, 0.0) AS comment_rating, strftime(d, '%Y-%m-%d') AS comment_date,
  {sq.jalali_int('d')} AS comment_date_jalali
FROM (SELECT *, CASE WHEN o_orderkey % 4 = 1 THEN DATE '2025-12-13' ELSE CAST(o_orderdate AS DATE) END AS d FROM orders) WHERE o_orderkey % 10 < 9""")
def q_normalize_scraped(spark, sf_dir):
    from .views import pick
    o, day = F.col("o_orderkey"), F.col("o_orderdate")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("app_id"), F.lit("u").alias("user_name"), F.col("o_orderpriority").alias("comment_text"),
        F.when(o % 10 < 9, o.cast("string")).alias("raw_id"), pick(STYLES, o % 7).alias("style"),
        F.when(o % 4 == 0, F.date_format(day, "yyyy/MM/dd")).when(o % 4 == 1, "yesterday").otherwise(F.date_format(day, "yyyy/M/d")).alias("date"))
    rows = merges.normalize_scraped(raw, today=F.lit("2025-12-13").cast("date"))
    return shown(rows.select("app_id", "comment_text", "comment_idd", "comment_rating", "comment_date", "comment_date_jalali"))


# --- dates -----------------------------------------------------------------------------------------------------------
@query("to_jalali", f"SELECT o_orderkey AS id, {sq.jalali_int('CAST(o_orderdate AS DATE)')} AS jalali FROM orders")
def q_to_jalali(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), dates.to_jalali_int(F.col("o_orderdate").cast("date")).alias("jalali"))


@query("from_jalali", "SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, NULL AS bad FROM orders")
def q_from_jalali(spark, sf_dir):
    year, month, day = dates.to_jalali_parts(F.col("o_orderdate").cast("date"))
    return shown(table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), dates.from_jalali(year, month, day).alias("day"),
        dates.from_jalali(year, F.lit(13), day).cast("string").alias("bad")))


@query("backfill_jalali", with_views(
    f"SELECT comment_id, {sq.jalali_int('comment_date')} AS comment_date_jalali FROM app_comments_v WHERE (comment_date_jalali IS NULL OR comment_date_jalali = 0)", "app_comments_v"))
def q_backfill_jalali(spark, sf_dir):
    return merges.backfill_jalali(app_comments(spark, sf_dir))


@query("parse_timestamp", f"""WITH {SQL_FEEDBACK} SELECT seq, {sq.stamp("CASE WHEN form IN (0, 5, 6) THEN date_trunc('second', ts) WHEN form < 7 THEN date_trunc('minute', ts) END")} AS parsed FROM file_v""")
def q_parse_timestamp(spark, sf_dir):
    return shown(feedback_file(spark, sf_dir).select("seq", dates.parse_timestamp(F.col("created_at")).alias("parsed")))


@query("parse_timestamp_jalali", f"""WITH {SQL_FEEDBACK} SELECT seq, {sq.stamp("CASE WHEN form = 0 THEN ts WHEN form IN (5, 6) THEN date_trunc('second', ts) ELSE date_trunc('minute', ts) END")} AS parsed FROM file_v""")
def q_parse_timestamp_jalali(spark, sf_dir):
    """As before; the eighth form is now the Jalali one."""
    year, month, day = dates.to_jalali_parts(F.col("ts").cast("date"))
    jalali = F.format_string("%04d/%02d/%02d-%s", year, month, day, F.date_format("ts", "HH:mm"))
    written = F.when(F.col("event_id") % 8 == 7, jalali).otherwise(written_time(F.col("ts"), F.col("event_id") % 8))
    return shown(table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), dates.parse_timestamp_jalali(F.concat(F.lit(" "), written)).alias("parsed")))


# --- identifiers and addresses ------------------------------------------------------------------------------------------
@query("hash_id", f"""SELECT c_custkey AS id, sha256({SQL_PAD.format("trim(' ' || CAST(c_custkey * c_custkey * c_custkey * 7 AS VARCHAR) || ' ')")}) AS hashed,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE sha256('000000007x') END AS phone FROM customer""")
def q_hash_id(spark, sf_dir):
    c = F.col("c_custkey")
    value = F.concat(F.lit(" "), (c * c * c * 7).cast("string"), F.lit(" "))
    return table(spark, sf_dir, "customer").select(
        c.alias("id"), ids.hash_id(value).alias("hashed"), ids.hash_id_or_null(F.when(c % 2 == 0, "  ").otherwise(" 7x")).alias("phone"))


URL_FORMS = """forms AS (SELECT page_id * 4 + f AS id, CASE f WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN upper(url)
  ELSE NULL END AS url, url AS plain, f FROM pages, (SELECT unnest([0, 1, 2, 3]) AS f))"""


@query("package_name", f"""WITH {URL_FORMS},
p AS (SELECT id, f, regexp_extract(plain, '://([^/?#]*)', 1) AS host, regexp_replace(regexp_extract(plain, '://[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM forms)
SELECT id, CASE WHEN f IN (0, 1) AND host = '{STORE_HOST}' THEN regexp_extract(path, '([^/]*)$', 1) END AS package,
  CASE WHEN f = 3 THEN 'url-error' WHEN f = 2 OR host <> '{STORE_HOST}' THEN 'host-error' END AS status,
  CASE WHEN NOT (f = 0 AND host = '{STORE_HOST}') THEN 'Bad-URL' END AS gate FROM p""")
def q_package_name(spark, sf_dir):
    """Each address as it is, without its scheme, in capitals, and missing."""
    url = F.col("url")
    forms = F.array(url, F.regexp_replace(url, "^https?://", ""), F.upper(url), F.lit(None).cast("string"))
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(forms).alias("f", "url"))
    return rows.select(
        (F.col("page_id") * 4 + F.col("f")).alias("id"), ids.package_name(url, STORE_HOST).alias("package"),
        ids.package_status(url, STORE_HOST).alias("status"), ids.domain_gate(url, STORE_HOST).alias("gate"))


@query("canonical_url", with_views("SELECT app_id, split_part(url, '?l=', 1) || '?l=en' AS url FROM apps_v", "apps_v"))
def q_canonical_url(spark, sf_dir):
    return apps(spark, sf_dir).select("app_id", ids.canonical_url(F.col("url")).alias("url"))


# --- streaming import ------------------------------------------------------------------------------------------------------
@query("stream_import", f"""WITH {SQL_FEEDBACK}, {SQL_CLEAN},
one AS (SELECT *, row_number() OVER (PARTITION BY national_code_hash, created_at ORDER BY seq DESC) AS r FROM clean_v)
SELECT national_code_hash, {sq.stamp('created_at')} AS created_at, title, grade, description, mobile_no_hash,
  (SELECT c.channel_code FROM clean_v c WHERE c.national_code_hash = one.national_code_hash AND c.created_at = one.created_at AND c.channel_code IS NOT NULL
   ORDER BY c.seq LIMIT 1) AS channel_code FROM one WHERE r = 1""")
def q_stream_import(spark, sf_dir):
    """All feedback files through the stream, one file per micro-batch, in two files by time."""
    folder = scratch_folder(spark)
    half = table(spark, sf_dir, "events").agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    for name, part in (("a", F.col("seq") <= half), ("b", F.col("seq") > half)):
        write_feedback(spark, sf_dir, f"{folder}/in/{name}", part)
    target = f"{folder}/table"
    intake.start_table(spark, target)
    stream = intake.import_stream(spark, f"{folder}/in/*", target, f"{folder}/state", files_per_batch=1)
    stream.awaitTermination()
    rows = intake.read_table(spark, target)
    return shown(rows.select("national_code_hash", "created_at", "title", "grade", "description", "mobile_no_hash", "channel_code"))


@query("flag_stream", sql_repeats("event_type", 3600))
def q_flag_stream(spark, sf_dir):
    """Flags of comments that arrive in three parts by time; the stream is started again for each."""
    folder = scratch_folder(spark)
    rows = _repeat_rows(spark, sf_dir, "event_type")
    times = F.unix_micros(F.col("created_at").cast("timestamp"))
    low, high = rows.agg(F.percentile_approx(times, [0.3, 0.6])).first()[0]
    for part in (times <= low, (times > low) & (times <= high), times > high):
        rows.filter(part).write.mode("append").parquet(f"{folder}/in")
        flags = repeats_stream.flag_stream(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
        stream = flags.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
        stream.outputMode("append").format("parquet").start(f"{folder}/flags").awaitTermination()
    return spark.read.schema(repeats_stream.FLAGS).parquet(f"{folder}/flags")
