"""Feedback tables derived from the tables given, once for Spark and once as SQL.

The given tables hold no feedback and no Persian. Every view covers the whole table it
is made from; texts are spelled with Persian letters by a fixed substitution, so that
word lists, suffixes, digits and half-spaces occur in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from . import sqltext as sq

# Latin letter (and some marks) -> Persian letter, Arabic letter, digit, diacritic,
# half-space or no-break space.
SPELLING = {
    "a": "ی", "b": "ب", "c": "ک", "d": "د", "e": "ا", "f": "ف", "g": "گ", "h": "ه", "i": "ی", "j": "ة",
    "k": "ك", "l": "م", "m": "ن", "n": "ز", "o": "ا", "p": "پ", "q": "ي", "r": "ر", "s": "س", "t": "ت",
    "u": "ب", "v": "ؤ", "w": "و", "x": "أ", "y": "ی", "z": "ً", "é": "ئ", "è": "إ", "ê": "ى", "ç": "چ",
    "5": "۵", "6": "۶", "7": "٧", "#": "‌", "*": "‌", "%": " ", ",": "،", ";": "؛",
}
LATIN, PERSIAN = "".join(SPELLING), "".join(SPELLING.values())

TITLES = [*lx.FEATURE_OF_TITLE, "بخش خرید  شارژ‌ و بسته", "متفرقه", None]
LABELS = list(lx.SCORES_FIVE_POINT)
REMARKS = [
    "بد نیست", "عالیه", "بابت تاخیر عذر خواهی", "خیلی خوبه", "", "   ", None, " عالیه ", "خوب",
    "برنامه کند است و کارت‌ها باز نمی شود", "لطفا امکان انتقال وجه را اضافه کنید",
    "نظر خاصی ندارم ولی ممنون", "کاش قابلیت  پرداخت\nقبض بهتر شود", "error 123 در پرداخت",
    "معمولی است", "ها", "حرف نداره این برنامه",
]
SECOND_LABELS = ["NEGATIVE", "POSITIVE", "no sentiment expressed"]
STORE_HOST = "m.ththth.example.net"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan in at least as many partitions as there are cores: the tables given are
    single small files. A table of as many files stays as it is."""
    cores, files = scan.sparkSession.sparkContext.defaultParallelism, len(scan.inputFiles())
    return scan if files >= cores else scan.repartition(cores)


def pick(values: list, index: Column) -> Column:
    """Element of a fixed list, 0-based."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def sql_pick(values: list, index: str) -> str:
    return f"({sq.lit_list(values)})[CAST({index} AS BIGINT) + 1]"


def persian(text: Column) -> Column:
    return F.translate(F.lower(text), LATIN, PERSIAN)


SQL_PERSIAN = f"translate(lower(text), {sq.lit(LATIN)}, {sq.lit(PERSIAN)})"
def number_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


# --- texts: documents -------------------------------------------------------------------------
def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        d.alias("id"), persian(F.col("text")).alias("description"), F.col("text").alias("latin"), "lang",
        pick(TITLES, d % len(TITLES)).alias("title"),
        pick(["negative", "positive", "neutral"], d % 3).alias("grp"),
    )


SQL_TEXTS = f"""texts_v AS (
  SELECT doc_id AS id, {SQL_PERSIAN} AS description, text AS latin, lang,
         {sql_pick(TITLES, f'doc_id % {len(TITLES)}')} AS title,
         {sql_pick(['negative', 'positive', 'neutral'], 'doc_id % 3')} AS grp
  FROM documents)"""


# --- comments: events ---------------------------------------------------------------------------
def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    rows = spread(table(spark, sf_dir, "events").drop("value")).withColumn("k", number_k())
    label = pick(LABELS, F.col("k") % 7)
    state = F.col("k") % 9
    result = F.when(state == 0, None).when(state == 1, "").when(state == 2, "no comments").otherwise(label)
    score = F.create_map(*[F.lit(v) for p in lx.SCORES_FIVE_POINT.items() for v in p])[label]
    return rows.select(
        e.alias("id"),
        pick(TITLES, e % len(TITLES)).alias("title"),
        (1 + e % 5).cast("int").alias("grade"),
        pick(REMARKS, e % len(REMARKS)).alias("description"),
        F.col("user_id").cast("string").alias("national_code_hash"),
        F.lit(None).cast("string").alias("mobile_no_hash"),
        F.col("ts").alias("created_at"),
        F.lit("2024-06-01").cast("timestamp").alias("imported_at"),
        result.alias("sentiment_result"),
        F.when(state < 2, None).when(state == 2, 0).when(state == 3, 11).otherwise(score).alias("sentiment_score"),
        (F.col("k") % 4 == 0).alias("second_model_processed"),
        F.when(F.col("k") % 5 == 0, None).otherwise(F.col("k") % 5 == 1).alias("is_repetitive"),
        F.lit(None).cast("long").alias("duplicate_of"),
        F.when(F.col("k") % 3 > 0, F.concat(F.lit("ch"), (F.col("k") % 3).cast("string"))).alias("channel_code"),
        F.when(F.col("k") % 2 == 0, F.lit(False)).alias("is_analyzed"),
        pick([*LABELS, "", None, "Unheard Of", "NEUTRAL"], F.col("k") % 11).alias("model1"),
        pick(SECOND_LABELS, F.col("k") % 3).alias("model2"),
        "k",
        "event_type",
    )


SQL_COMMENTS = f"""comments_v AS (
  SELECT event_id AS id, {sql_pick(TITLES, f'event_id % {len(TITLES)}')} AS title,
         CAST(1 + event_id % 5 AS INTEGER) AS grade,
         {sql_pick(REMARKS, f'event_id % {len(REMARKS)}')} AS description,
         CAST(user_id AS VARCHAR) AS national_code_hash, CAST(NULL AS VARCHAR) AS mobile_no_hash, ts AS created_at,
         TIMESTAMP '2024-06-01' AS imported_at,
         CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'no comments'
              ELSE {sql_pick(LABELS, 'k % 7')} END AS sentiment_result,
         CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 0 WHEN 3 THEN 11
              ELSE {sq.case_map(sql_pick(LABELS, 'k % 7'), lx.SCORES_FIVE_POINT)} END AS sentiment_score,
         k % 4 = 0 AS second_model_processed,
         CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN TRUE ELSE FALSE END AS is_repetitive,
         CAST(NULL AS BIGINT) AS duplicate_of,
         CASE WHEN k % 3 > 0 THEN 'ch' || CAST(k % 3 AS VARCHAR) END AS channel_code,
         CASE WHEN k % 2 = 0 THEN FALSE END AS is_analyzed,
         {sql_pick([*LABELS, '', None, 'Unheard Of', 'NEUTRAL'], 'k % 11')} AS model1,
         {sql_pick(SECOND_LABELS, 'k % 3')} AS model2, k, event_type
  FROM (SELECT *, {SQL_K} AS k FROM events))"""


# --- analysed comments: events -------------------------------------------------------------------
KEYWORDS = ["کارت", "speed", "انتقال", "وجه", "app", "خطا", "کند", "پیامک", "شعبه"]


def analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = F.col("event_id"), F.col("k")
    return spread(table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "props")).withColumn("k", number_k()).select(
        e.alias("comment_id"), F.col("ts").alias("created_at"),
        pick(LABELS, k % 7).alias("sentiment_result"),
        F.col("event_type").alias("title"),
        pick(lx.TYPES, k % 6).alias("type"),
        pick(lx.CATEGORIES, k % 8).alias("category"),
        F.col("event_type").alias("short_title"),
        F.when(e % 17 == 0, None).when(e % 17 == 1, "").otherwise(F.concat("event_type", F.lit(" "), k.cast("string"))).alias("normalized_title"),
        F.slice(F.array(*[F.lit(w) for w in KEYWORDS]), (1 + k % 5).cast("int"), 4).alias("keywords"),
        F.concat(F.lit("evidence "), k.cast("string")).alias("evidence"),
        F.lit("m").alias("model"),
        F.lit("2024-06-01").cast("timestamp").alias("processed_at"),
        F.when(e % 3 > 0, pick(lx.FEATURES, k % 11)).alias("ai_title"),
    )


SQL_ANALYSIS = f"""analysis_v AS (
  SELECT event_id AS comment_id, ts AS created_at, {sql_pick(LABELS, 'k % 7')} AS sentiment_result,
         event_type AS title, {sql_pick(lx.TYPES, 'k % 6')} AS type, {sql_pick(lx.CATEGORIES, 'k % 8')} AS category,
         event_type AS short_title,
         CASE event_id % 17 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE event_type || ' ' || CAST(k AS VARCHAR) END AS normalized_title,
         list_slice({sq.lit_list(KEYWORDS)}, CAST(1 + k % 5 AS BIGINT), CAST(4 + k % 5 AS BIGINT)) AS keywords,
         'evidence ' || CAST(k AS VARCHAR) AS evidence, 'm' AS model, TIMESTAMP '2024-06-01' AS processed_at,
         CASE WHEN event_id % 3 > 0 THEN {sql_pick(lx.FEATURES, 'k % 11')} END AS ai_title
  FROM (SELECT *, {SQL_K} AS k FROM events))"""


# --- summary jobs: nations ---------------------------------------------------------------------------
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
JOB_SENTIMENTS = ["negative", "positive", "neutral", "unheard"]


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per nation: two titles, one or two types and categories, one or two
    sentiments; some lack a filter, some ask for a sentiment that does not exist."""
    n = F.col("n_nationkey").cast("long")
    two = lambda values, i: F.array(pick(values, i % len(values)), pick(values, (i + 1) % len(values)))
    none = F.array().cast("array<string>")
    return table(spark, sf_dir, "nation").select(
        n.alias("summarized_id"),
        F.struct(
            two(EVENT_TYPES, n).alias("titles"),
            F.when(n % 7 == 3, none).otherwise(F.array(pick(lx.TYPES, n % 6))).alias("types"),
            F.when(n % 7 == 4, None).otherwise(F.array(pick(lx.CATEGORIES, n % 6))).alias("categories"),
            F.when(n % 8 == 7, F.array(F.lit("unheard"))).otherwise(two(JOB_SENTIMENTS[:3], n)).alias("sentiments"),
            F.when(n % 4 == 1, "2024-1-2").when(n % 4 == 3, "-infinity").otherwise("2024-01-01").alias("start_date"),
            F.when(n % 11 == 5, "").when(n % 5 == 1, "2024-1-12").when(n % 5 == 2, "infinity").when(n % 5 == 3, "2024-01-9 12:30").otherwise("2024-02-01").alias("end_date"),
        ).alias("filter"),
        F.lit(None).cast("string").alias("summarized_comment"),
        F.lit(None).cast("long").alias("comment_count"),
        F.lit("waiting").alias("status"),
        F.lit(None).cast("decimal(10,2)").alias("duration_seconds"),
        F.lit(None).cast("string").alias("model"),
    )


def _sql_two(values: list, i: str) -> str:
    return f"[{sql_pick(values, f'({i}) % {len(values)}')}, {sql_pick(values, f'({i} + 1) % {len(values)}')}]"


SQL_JOBS = f"""jobs_v AS (
  SELECT CAST(n_nationkey AS BIGINT) AS summarized_id, {_sql_two(EVENT_TYPES, 'n_nationkey')} AS titles,
         CASE WHEN n_nationkey % 7 = 3 THEN [] ELSE [{sql_pick(lx.TYPES, 'n_nationkey % 6')}] END AS types,
         CASE WHEN n_nationkey % 7 = 4 THEN NULL ELSE [{sql_pick(lx.CATEGORIES, 'n_nationkey % 6')}] END AS categories,
         CASE WHEN n_nationkey % 8 = 7 THEN ['unheard'] ELSE {_sql_two(JOB_SENTIMENTS[:3], 'n_nationkey')} END AS sentiments,
         CASE n_nationkey % 4 WHEN 1 THEN '2024-1-2' WHEN 3 THEN '-infinity' ELSE '2024-01-01' END AS start_date,
         CASE WHEN n_nationkey % 11 = 5 THEN '' WHEN n_nationkey % 5 = 1 THEN '2024-1-12' WHEN n_nationkey % 5 = 2 THEN 'infinity'
           WHEN n_nationkey % 5 = 3 THEN '2024-01-9 12:30' ELSE '2024-02-01' END AS end_date
  FROM nation),
ready_v AS (SELECT * FROM jobs_v WHERE len(titles) > 0 AND len(coalesce(types, [])) > 0
  AND len(coalesce(categories, [])) > 0 AND len(sentiments) > 0 AND start_date <> '' AND end_date <> ''),
groups_v AS (
  SELECT summarized_id, CAST(((i1 - 1) * len(types) + i2 - 1) * len(categories) * len(sentiments)
         + (i3 - 1) * len(sentiments) + i4 - 1 AS BIGINT) AS group_no,
         titles[i1] AS title, types[i2] AS type, categories[i3] AS category, sentiments[i4] AS sentiment, start_date, end_date
  FROM (SELECT *, unnest(range(1, len(sentiments) + 1)) AS i4 FROM (SELECT *, unnest(range(1, len(categories) + 1)) AS i3
  FROM (SELECT *, unnest(range(1, len(types) + 1)) AS i2 FROM (SELECT *, unnest(range(1, len(titles) + 1)) AS i1 FROM ready_v)))))"""


# --- evaluation: embeddings ----------------------------------------------------------------------------
def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth is the label; one prediction is wrong for every fourth vector, the title
    stands for the label of every fifth."""
    v, label = F.col("vec_id"), F.col("label")
    return table(spark, sf_dir, "embeddings").select(
        pick(lx.FEATURES, label).alias("Annot_title"),
        F.when(v % 10 == 9, None).otherwise(pick(lx.FEATURES, F.when(v % 4 == 0, (label + 1) % 10).otherwise(label))).alias("ai_title"),
        pick(TITLES[:12], F.when(v % 5 == 0, (label + 3) % 12).otherwise(label)).alias("title"),
    )


SQL_EVALUATION = f"""eval_v AS (
  SELECT Annot_title AS truth, ai_title AS predicted,
         {sq.case_map('title', lx.FEATURE_OF_TITLE, "'unmapped'")} AS baseline
  FROM (SELECT {sql_pick(lx.FEATURES, 'label')} AS Annot_title,
         CASE WHEN vec_id % 10 = 9 THEN NULL
              ELSE {sql_pick(lx.FEATURES, 'CASE WHEN vec_id % 4 = 0 THEN (label + 1) % 10 ELSE label END')} END AS ai_title,
         {sql_pick(TITLES[:12], 'CASE WHEN vec_id % 5 = 0 THEN (label + 3) % 12 ELSE label END')} AS title
  FROM embeddings) WHERE Annot_title IS NOT NULL AND ai_title IS NOT NULL AND title IS NOT NULL)"""


# --- apps: suppliers; what was scraped: customers --------------------------------------------------------
APP_CATEGORIES = [*lx.ACCEPTED_APP_CATEGORIES, "بازی"]
APP_TEXTS = ["app_img", "company", "version", "total_rate", "average_rate", "install", "size", "last_update", "img_base64"]


def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.alias("app_id"), F.concat(F.lit("app "), F.col("s_name")).alias("app_name"), F.col("s_name").alias("nickname"),
        pick(APP_CATEGORIES, s % 3).alias("category"),
        F.concat(F.lit("https://store.example/app/"), F.col("s_name"), F.lit("?l=fa")).alias("url"),
        *[F.concat(F.lit(f"old {c} "), s.cast("string")).alias(c) for c in APP_TEXTS],
        (s % 4 > 0).alias("active"), (s % 3 == 0).alias("deleted"),
        F.lit(None).cast("int").alias("count_scraped_comments"), F.lit(None).cast("int").alias("count_new_comments"),
        F.lit(None).cast("int").alias("last_update_comment_scraping"),
    )


def scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    name = F.replace("c_name", F.lit("Customer"), F.lit("Supplier"))
    return table(spark, sf_dir, "customer").select(
        c.alias("seq"), name.alias("nickname"),
        F.concat(F.lit("app "), name).alias("app_name"), pick(APP_CATEGORIES, F.col("c_nationkey") % 3).alias("category"),
        F.concat(F.lit("https://store.example/app/"), name).alias("url"),
        *[F.concat(F.lit(f"new {t} "), c.cast("string")).alias(t) for t in APP_TEXTS],
    )


SQL_APPS = f"""apps_v AS (
  SELECT s_suppkey AS app_id, 'app ' || s_name AS app_name, s_name AS nickname,
         {sql_pick(APP_CATEGORIES, 's_suppkey % 3')} AS category,
         'https://store.example/app/' || s_name || '?l=fa' AS url,
         {', '.join(f"'old {c} ' || CAST(s_suppkey AS VARCHAR) AS {c}" for c in APP_TEXTS)},
         s_suppkey % 4 > 0 AS active, s_suppkey % 3 = 0 AS deleted
  FROM supplier),
scrapes_v AS (
  SELECT c_custkey AS seq, replace(c_name, 'Customer', 'Supplier') AS nickname,
         'app ' || replace(c_name, 'Customer', 'Supplier') AS app_name,
         {sql_pick(APP_CATEGORIES, 'c_nationkey % 3')} AS category,
         'https://store.example/app/' || replace(c_name, 'Customer', 'Supplier') AS url,
         {', '.join(f"'new {c} ' || CAST(c_custkey AS VARCHAR) AS {c}" for c in APP_TEXTS)}
  FROM customer)"""


# --- comments on apps: events -----------------------------------------------------------------------------
def app_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = comments(spark, sf_dir)
    return base.select(
        F.col("id").alias("comment_id"), (F.col("id") % 10).alias("app_id"), F.col("national_code_hash").alias("user_name"),
        F.col("description").alias("comment_text"), F.col("grade").cast("double").alias("comment_rating"),
        F.col("created_at").cast("date").alias("comment_date"), F.lit(False).alias("second_model_processed"),
        F.col("id").alias("comment_idd"),
        F.when(F.col("k") % 4 == 0, None).when(F.col("k") % 4 == 1, 0).otherwise(14021011).alias("comment_date_jalali"),
        F.when(F.col("k") % 3 > 0, 1).alias("sentiment_score"), "model1", "model2",
    )


SQL_APP_COMMENTS = SQL_COMMENTS + """,
app_comments_v AS (
  SELECT id AS comment_id, id % 10 AS app_id, national_code_hash AS user_name, description AS comment_text,
         CAST(grade AS DOUBLE) AS comment_rating, CAST(created_at AS DATE) AS comment_date, FALSE AS second_model_processed,
         id AS comment_idd,
         CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 14021011 END AS comment_date_jalali,
         CASE WHEN k % 3 > 0 THEN 1 END AS sentiment_score, model1, model2
  FROM comments_v)"""


# --- labelled exports: orders --------------------------------------------------------------------------------
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with a Jalali day, as if exported: year, month, day, rating, sentiment."""
    from ..functions.dates import to_jalali_parts

    year, month, day = to_jalali_parts(F.col("o_orderdate").cast("date"))
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        o.alias("Unnamed: 0"), F.col("o_orderpriority").alias("comment"),
        F.when(o % 6 > 0, (o % 7).cast("int")).alias("rating"),
        year.alias("year"), month.alias("month"), day.alias("day"),
        pick(["very negative", "negative", "positive"], o % 3).alias("sentiment"),
    )


SQL_LABELS = f"""labels_v AS (
  SELECT comment, rating, j // 10000 AS year, (j // 100) % 100 AS month, j % 100 AS day, sentiment
  FROM (SELECT o_orderpriority AS comment, CASE WHEN o_orderkey % 6 > 0 THEN CAST(o_orderkey % 7 AS INTEGER) END AS rating,
         {sq.jalali_int('CAST(o_orderdate AS DATE)')} AS j,
         {sql_pick(['very negative', 'negative', 'positive'], 'o_orderkey % 3')} AS sentiment
  FROM orders))"""


VIEWS = {
    "texts_v": SQL_TEXTS, "comments_v": SQL_COMMENTS, "analysis_v": SQL_ANALYSIS, "jobs_v": SQL_JOBS,
    "eval_v": SQL_EVALUATION, "apps_v": SQL_APPS, "app_comments_v": SQL_APP_COMMENTS, "labels_v": SQL_LABELS,
}


def with_views(body: str, *names: str, recursive: bool = False) -> str:
    """``body`` behind the views it reads; ``body`` may start with further ``name AS (...)``
    definitions followed by its SELECT."""
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(VIEWS[n] for n in names) + "\n" + body
