"""Evaluation, summarisation jobs and run totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..operators import evaluation, merges, ngrams, repeats, reports, summaries
from ..session import cut_lineage
from ..sources import files
from . import sqltext as sq
from .registry import query
from .scratch import scratch_folder
from .table_queries import _repeat_rows, shown, sql_repeats
from .text_queries import STOP, sql_tfidf
from .views import analysis, comments, evaluation as evaluation_rows, jobs, table, texts, with_views

# --- evaluation ----------------------------------------------------------------------------------------
SQL_LABEL_STATS = """, pairs AS (SELECT 'AI' AS model, truth, predicted FROM eval_v UNION ALL SELECT 'Baseline', truth, baseline FROM eval_v),
stats AS (SELECT model, label, sum(hit) AS hits, sum(t) AS support, sum(p) AS predicted_count FROM (
  SELECT model, truth AS label, CASE WHEN truth = predicted THEN 1 ELSE 0 END AS hit, 1 AS t, 0 AS p FROM pairs
  UNION ALL SELECT model, predicted, 0, 0, 1 FROM pairs) GROUP BY model, label),
measures AS (SELECT *, CASE WHEN predicted_count > 0 THEN hits / predicted_count ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall, 2 * hits / (support + predicted_count) AS f1 FROM stats)"""
SCORES = """model, round(sum(hits) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
round(avg(f1), 6) AS f1_macro, round(sum(precision * support) / sum(support), 6) AS precision_weighted,
round(sum(recall * support) / sum(support), 6) AS recall_weighted, round(sum(f1 * support) / sum(support), 6) AS f1_weighted"""


def _evaluated(spark, sf_dir):
    return evaluation.annotated(evaluation_rows(spark, sf_dir))


@query("confusion_matrix", with_views(
    " SELECT truth, predicted, count(*) AS n FROM eval_v GROUP BY truth, predicted", "eval_v"))
def q_confusion_matrix_sparse(spark, sf_dir):
    return evaluation.confusion_matrix(_evaluated(spark, sf_dir), "truth", "predicted")


@query("confusion_matrix_full", with_views(
    """, labels AS (SELECT truth AS l FROM eval_v UNION SELECT predicted FROM eval_v UNION SELECT baseline FROM eval_v)
SELECT a.l AS truth, b.l AS predicted, (SELECT count(*) FROM eval_v WHERE truth = a.l AND predicted = b.l) AS n FROM labels a, labels b""", "eval_v"))
def q_confusion_matrix(spark, sf_dir):
    rows = _evaluated(spark, sf_dir)
    seen = rows.select(F.explode(F.array("truth", "predicted", "baseline")).alias("label")).distinct()
    return evaluation.confusion_matrix(rows, "truth", "predicted", labels=seen)


@query("eval_scores", with_views(SQL_LABEL_STATS + f" SELECT {SCORES} FROM measures WHERE model = 'AI' GROUP BY model", "eval_v"))
def q_eval_scores(spark, sf_dir):
    return evaluation.eval_scores(_evaluated(spark, sf_dir), "truth", "predicted", "AI")


@query("class_report", with_views(
    SQL_LABEL_STATS + " SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support "
    "FROM measures WHERE model = 'Baseline'", "eval_v"))
def q_class_report(spark, sf_dir):
    return evaluation.class_report(_evaluated(spark, sf_dir), "truth", "baseline")


@query("cohen_kappa", with_views(
    SQL_LABEL_STATS + """, k AS (SELECT sum(hits) / sum(support) AS po, sum(support * predicted_count) / (sum(support) * sum(support)) AS pe
FROM stats WHERE model = 'AI') SELECT round((po - pe) / (1 - pe), 6) AS kappa FROM k""", "eval_v"))
def q_cohen_kappa(spark, sf_dir):
    return evaluation.cohen_kappa(_evaluated(spark, sf_dir), "truth", "predicted")


@query("compare_models", with_views(SQL_LABEL_STATS + f" SELECT {SCORES} FROM measures GROUP BY model", "eval_v"))
def q_compare_models(spark, sf_dir):
    return evaluation.compare_models(_evaluated(spark, sf_dir), "truth", {"AI": "predicted", "Baseline": "baseline"})


# --- totals and groups ------------------------------------------------------------------------------------
@query("run_totals", f"""WITH f AS ({sql_repeats('event_type', 3600)}),
s AS (SELECT event_id AS id, CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'ok' END AS status FROM events)
SELECT count(*) FILTER (WHERE status = 'ok') AS processed, count(*) FILTER (WHERE status <> 'ok') AS failed,
  count(*) FILTER (WHERE is_repetitive) AS flagged FROM s JOIN f USING (id)""")
def q_run_totals(spark, sf_dir):
    flags = repeats.flag_repetitive(_repeat_rows(spark, sf_dir, "event_type"))
    return reports.run_totals(flags.withColumn("status", F.when(F.col("id") % 9 == 0, "failed").otherwise("ok")))


COUNTS = "SELECT title, type, category, sentiment_result, count(*) AS count FROM analysis_v GROUP BY title, type, category, sentiment_result"


@query("group_counts", with_views(f"SELECT * FROM ({COUNTS}) WHERE count >= 5", "analysis_v"))
def q_group_counts(spark, sf_dir):
    return summaries.group_counts(analysis(spark, sf_dir), 5)


@query("batch_groups", with_views(
    f"SELECT *, '2026-01-06 10:00:00.000000' AS processed_at FROM ({COUNTS}) WHERE count > 5 AND title IN ('error', 'view') AND type IN ('issue', 'suggestion') "
    "AND category IN ('auth', 'login', 'ui') AND sentiment_result IN ('very negative', 'negative', 'positive')", "analysis_v"))
def q_batch_groups(spark, sf_dir):
    return shown(summaries.batch_groups(
        analysis(spark, sf_dir), titles=["error", "view"], types=["issue", "suggestion"], categories=["auth", "login", "ui"],
        sentiments=["very negative", "negative", "positive"], processed_at=F.lit("2026-01-06 10:00:00").cast("timestamp_ntz")))


@query("chunk_groups", with_views(
    """SELECT comment_id, title, rn - 1 AS position, (rn - 1) // 80 AS chunk
FROM (SELECT comment_id, title, row_number() OVER (PARTITION BY title ORDER BY comment_id) AS rn FROM analysis_v)""", "analysis_v"))
def q_chunk_groups(spark, sf_dir):
    return summaries.chunk_groups(analysis(spark, sf_dir).select("comment_id", "title"), ["title"], "comment_id", slot_width=1000)


# --- jobs -----------------------------------------------------------------------------------------------------
@query("expand_jobs", with_views("SELECT * FROM groups_v", "jobs_v"))
def q_expand_jobs(spark, sf_dir):
    return summaries.expand_jobs(jobs(spark, sf_dir))


LABELLED = ", wanted AS (SELECT *, unnest(CASE sentiment " + " ".join(
    f"WHEN {sq.lit(g)} THEN {sq.lit_list(labels)}" for g, labels in lx.SENTIMENT_LABELS_OF_GROUP.items()
) + " ELSE CAST([] AS VARCHAR[]) END) AS sentiment_result FROM groups_v)"


@query("map_sentiment", with_views(LABELLED + " SELECT * FROM wanted", "jobs_v"))
def q_map_sentiment(spark, sf_dir):
    return summaries.map_sentiment(summaries.expand_jobs(jobs(spark, sf_dir)))


FOUND = LABELLED + """, found AS (SELECT w.summarized_id, w.group_no, a.comment_id, a.normalized_title FROM wanted w JOIN analysis_v a
  ON a.title = w.title AND a.type = w.type AND a.category = w.category AND a.sentiment_result = w.sentiment_result
  AND a.created_at BETWEEN CAST(w.start_date AS TIMESTAMP) AND CAST(w.end_date AS TIMESTAMP)),
placed AS (SELECT *, row_number() OVER (PARTITION BY summarized_id, group_no ORDER BY comment_id) AS rn FROM found WHERE coalesce(normalized_title, '') <> ''),
chunks AS (SELECT summarized_id, group_no, (rn - 1) // 80 AS chunk, string_agg(normalized_title, chr(10) ORDER BY rn) AS texts FROM placed GROUP BY summarized_id, group_no, (rn - 1) // 80),
few AS (SELECT summarized_id, group_no, (rn - 1) // 10 AS chunk, string_agg(normalized_title, chr(10) ORDER BY rn) AS texts FROM placed GROUP BY summarized_id, group_no, (rn - 1) // 10),
sizes AS (SELECT g.summarized_id, g.group_no, count(f.comment_id) AS comments,
  count(f.comment_id) FILTER (WHERE coalesce(normalized_title, '') <> '') AS usable FROM groups_v g LEFT JOIN found f USING (summarized_id, group_no)
  GROUP BY g.summarized_id, g.group_no),
status AS (SELECT j.summarized_id, CASE WHEN r.summarized_id IS NULL THEN 'One or more required filters are missing'
    WHEN min(comments) < 5 THEN 'Not enough comments for summarization' WHEN min(usable) < 1 THEN 'No usable text' END AS reason, sum(comments) AS total
  FROM jobs_v j LEFT JOIN ready_v r USING (summarized_id) LEFT JOIN sizes s USING (summarized_id) GROUP BY j.summarized_id, r.summarized_id),
done AS (SELECT summarized_id, CASE WHEN reason IS NULL THEN 'completed' ELSE 'failed' END AS status,
  CAST(CASE WHEN reason IS NULL THEN total ELSE 0 END AS BIGINT) AS comment_count, reason FROM status)"""


def _found(spark, sf_dir):
    groups = summaries.expand_jobs(jobs(spark, sf_dir))
    return groups, cut_lineage(summaries.group_comments(groups, analysis(spark, sf_dir)))


@query("group_texts", with_views(FOUND + " SELECT * FROM chunks", "jobs_v", "analysis_v"))
def q_group_texts(spark, sf_dir):
    return summaries.chunk_texts(_found(spark, sf_dir)[1])


@query("job_status", with_views(FOUND + " SELECT * FROM done", "jobs_v", "analysis_v"))
def q_job_status(spark, sf_dir):
    groups, found = _found(spark, sf_dir)
    return summaries.job_status(jobs(spark, sf_dir), summaries.group_sizes(groups, found))


FEW = 10  # texts in a chunk, so that groups of one and of many chunks occur
# A summary is a model's answer; here it is the first line and the length of what it is asked about.
def _answered(rows, text):
    return rows.withColumn("summary", F.concat(F.split_part(text, F.lit("\n"), F.lit(1)), F.lit(" ("), F.length(text).cast("string"), F.lit(")")))


def sql_answer(text):
    return f"split_part({text}, chr(10), 1) || ' (' || CAST(length({text}) AS VARCHAR) || ')'"


SQL_MERGED = FOUND + f""", merged AS (SELECT summarized_id, group_no, chunk // 2 AS part, count(*) AS chunks, string_agg({sql_answer('texts')}, chr(10) ORDER BY chunk) AS text
FROM few GROUP BY summarized_id, group_no, chunk // 2)"""
# One chunk keeps its summary, those of several are summarised once more.
SQL_ANSWERS = FOUND + f""", joined AS (SELECT summarized_id, group_no, count(*) AS chunks, string_agg({sql_answer('texts')}, chr(10) ORDER BY chunk) AS text FROM few GROUP BY summarized_id, group_no),
answers AS (SELECT summarized_id, group_no, CASE WHEN chunks = 1 THEN text ELSE {sql_answer('text')} END AS summary FROM joined)"""


@query("merge_chunks", with_views(SQL_MERGED + " SELECT * FROM merged", "jobs_v", "analysis_v"))
def q_merge_chunks(spark, sf_dir):
    return summaries.merge_chunks(_answered(summaries.chunk_texts(_found(spark, sf_dir)[1], FEW), F.col("texts")), fan_in=2)


def _answers(found):
    return summaries.merge_until_one(_answered(summaries.chunk_texts(found, FEW), F.col("texts")), lambda rows: _answered(rows, F.col("text")))


@query("merge_until_one", with_views(SQL_ANSWERS + " SELECT * FROM answers", "jobs_v", "analysis_v"))
def q_merge_until_one(spark, sf_dir):
    return _answers(_found(spark, sf_dir)[1])


@query("finish_jobs", with_views(
    SQL_ANSWERS + """, texts AS (SELECT summarized_id, string_agg(summary, chr(10) || chr(10) ORDER BY group_no) AS text FROM answers GROUP BY summarized_id)
SELECT summarized_id, status, comment_count, CASE WHEN status = 'completed' THEN text END AS summarized_comment, 1.5 AS duration_seconds, 'm' AS model
FROM done LEFT JOIN texts USING (summarized_id)""", "jobs_v", "analysis_v"))
def q_finish_jobs(spark, sf_dir):
    groups, found = _found(spark, sf_dir)
    waiting = jobs(spark, sf_dir)
    status = summaries.job_status(waiting, summaries.group_sizes(groups, found))
    results = status.join(summaries.merge_groups(_answers(found)), "summarized_id", "left").select(
        "summarized_id", F.when(F.col("status") == "completed", F.col("summarized_comment")).alias("summarized_comment"),
        "comment_count", "status", F.lit("1.50").cast("decimal(10,2)").alias("duration_seconds"), F.lit("m").alias("model"))
    done = merges.finish_jobs(waiting, results)
    return done.select(
        "summarized_id", "status", "comment_count", "summarized_comment", F.col("duration_seconds").cast("double").alias("duration_seconds"), "model")


@query("unknown_jobs", "SELECT s_suppkey AS summarized_id, 'completed' AS status FROM supplier WHERE s_suppkey NOT IN (SELECT n_nationkey FROM nation)")
def q_unknown_jobs(spark, sf_dir):
    results = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("summarized_id"), F.lit("completed").alias("status"))
    return merges.unknown_jobs(jobs(spark, sf_dir), results)


@query("append_summaries", with_views(
    f"SELECT title, type, category, sentiment_result, count, 's ' || title AS summarized_comment FROM ({COUNTS}) WHERE count > 5 AND type <> 'other'", "analysis_v"))
def q_append_summaries(spark, sf_dir):
    counts = summaries.group_counts(analysis(spark, sf_dir), 6)
    rows = counts.withColumn("summarized_comment", F.when(F.col("type") != "other", F.concat(F.lit("s "), "title")))
    path = scratch_folder(spark)
    merges.summaries_to_append(rows).write.mode("append").parquet(path)
    return spark.read.parquet(path)


TEMPLATE = "Comment:\n{comment_text}\n---"


@query("prompt_rows", with_views(
    f"""SELECT id, 'Comment:' || chr(10) || {sq.match_form('description')} || chr(10) || '---' || chr(10) || 'Likely ai_title based on title of app section: ' ||
CASE WHEN coalesce(title, '') = '' THEN 'other' """ + " ".join(
        f"WHEN contains(n, {sq.match_form(sq.lit(k))}) THEN {sq.lit(v)}" for k, v in lx.FEATURE_OF_TITLE.items()
    ) + f" ELSE 'other' END AS prompt FROM (SELECT *, {sq.match_form('title')} AS n FROM comments_v)", "comments_v"))
def q_prompt_rows(spark, sf_dir):
    return summaries.prompt_rows(comments(spark, sf_dir), TEMPLATE)


CATEGORY_TEMPLATE = "Comment:\n{comment_text}\nType: {type}\nFeature: {ai_title}\nCategory?"
SUMMARY_TEMPLATE = "{title} / {type} / {category} / {sentiment}\n{texts}\n---"


@query("category_prompt_rows", with_views(
    f"""SELECT comment_id, 'Comment:' || chr(10) || {sq.match_form('description')} || chr(10) || 'Type: ' || coalesce(type, '') || chr(10) || 'Feature: ' ||
coalesce(ai_title, '') || chr(10) || 'Category?' AS prompt FROM analysis_v JOIN comments_v ON id = comment_id""", "analysis_v", "comments_v"))
def q_category_prompt_rows(spark, sf_dir):
    return summaries.category_prompt_rows(analysis(spark, sf_dir), comments(spark, sf_dir), CATEGORY_TEMPLATE)


@query("summary_prompt_rows", with_views(
    FOUND + """ SELECT summarized_id, group_no, chunk, title || ' / ' || type || ' / ' || category || ' / ' || sentiment || chr(10) || texts || chr(10) || '---' AS prompt
FROM chunks JOIN groups_v USING (summarized_id, group_no)""", "jobs_v", "analysis_v"))
def q_summary_prompt_rows(spark, sf_dir):
    groups, found = _found(spark, sf_dir)
    return summaries.summary_prompt_rows(summaries.chunk_texts(found), groups, SUMMARY_TEMPLATE)


@query("ngram_csv_sink", sql_tfidf(
    [2, 3], 30, grouped=True, select="grp, rank, ngram, tfidf, n, CASE n WHEN 2 THEN 'bigram' ELSE 'trigram' END AS type, unnest(['0.2', '0.3']) AS version"))
def q_ngram_csv_sink(spark, sf_dir):
    path = scratch_folder(spark)
    report = cut_lineage(ngrams.tfidf_by_group(texts(spark, sf_dir), group="grp", stopwords=STOP))
    for version in ("0.2", "0.3", "0.2"):  # a version replaces itself and leaves the others
        files.write_ngram_csv(report, path, version)
    rows = spark.read.schema("rank int, ngram string, tfidf double, n int, type string, version string, grp string").option("header", True).csv(path)
    return rows
