"""Sentiment and classification rules, and the reading of model replies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from .. import schemas
from ..functions import lexicon as lx
from ..functions import model_output as mo
from ..functions import rules
from ..functions.text import normalize_for_match
from ..operators import classification, labelling, reports, scoring
from . import sqltext as sq
from .registry import query
from .views import analysis, app_comments, comments, texts, with_views

CASCADE = ("sentiment_result", "sentiment_score", "second_model_processed")


# --- sentiment ----------------------------------------------------------------------------------------------
def sql_validated(label, text):
    return (
        f"CASE WHEN {text} IN {sq.in_list(lx.NEUTRAL_PHRASES_SENTIMENT)} THEN 'no sentiment expressed' "
        f"WHEN {text} IN {sq.in_list(lx.POSITIVE_PHRASES)} THEN 'very positive' "
        f"WHEN lower({label}) IN {sq.in_list(lx.SCORES_FIVE_POINT)} THEN lower({label}) ELSE 'no sentiment expressed' END")


def sql_cascade(source, id, text, rating, scores, blank, failed):
    first = "CASE WHEN coalesce(model1, '') = '' THEN 'no sentiment expressed' ELSE model1 END"
    unclear = f"lower({first}) IN {sq.in_list(lx.UNCLEAR_LABELS)}"
    neg, pos = (f"({unclear} AND model2 = '{m}' AND {rating} = {r})" for m, r in (("NEGATIVE", 1), ("POSITIVE", 5)))
    empty = f"{sq.strip(f'''coalesce({text}, '')''')} = ''" if blank else "FALSE"
    return f"""casc AS (SELECT *, CASE WHEN empty THEN 'no comments' WHEN bad THEN 'Missed Value' ELSE v END AS s_result,
  CASE WHEN empty THEN 0 WHEN bad THEN 11 ELSE {sq.case_map('v', scores)} END AS s_score, NOT empty AND NOT bad AND second AS s_second
  FROM (SELECT *, {sql_validated('l', text)} AS v FROM (SELECT *, {empty} AS empty, {failed} AS bad, coalesce({neg} OR {pos}, FALSE) AS second,
    CASE WHEN {neg} THEN 'negative' WHEN {pos} THEN 'positive' ELSE {first} END AS l FROM {source})))"""


@query("sentiment_cascade", with_views(
    ", " + sql_cascade("comments_v", "id", "description", "grade", lx.SCORES_FIVE_POINT, True, "(k % 23 = 5)")
    + " SELECT id, s_result AS sentiment_result, s_score AS sentiment_score, s_second AS second_model_processed FROM casc", "comments_v"))
def q_sentiment_cascade(spark, sf_dir):
    label = rules.sentiment_cascade(
        F.col("description"), F.col("grade"), F.col("model1"), F.col("model2"), failed=F.col("k") % 23 == 5)
    return comments(spark, sf_dir).select("id", label.alias("l")).select("id", "l.*")


@query("sentiment_cascade_apps", with_views(
    ", " + sql_cascade("app_comments_v", "comment_id", "comment_text", "comment_rating", lx.SCORES_SIGNED, False, "FALSE")
    + " SELECT comment_id AS id, s_result AS sentiment_result, s_score AS sentiment_score, s_second AS second_model_processed FROM casc", "app_comments_v"))
def q_sentiment_cascade_apps(spark, sf_dir):
    label = rules.sentiment_cascade_apps(F.col("comment_text"), F.col("comment_rating"), F.col("model1"), F.col("model2"))
    return app_comments(spark, sf_dir).select(F.col("comment_id").alias("id"), label.alias("l")).select("id", "l.*")


@query("validate_and_score", with_views(
    f"SELECT id, v AS sentiment_result, {sq.case_map('v', lx.SCORES_FIVE_POINT)} AS sentiment_score FROM (SELECT id, {sql_validated('model1', 'description')} AS v FROM comments_v)", "comments_v"))
def q_validate_and_score(spark, sf_dir):
    return comments(spark, sf_dir).select("id", rules.validate_and_score(F.col("model1"), F.col("description")).alias("v")).select("id", "v.*")


@query("flag_then_label", with_views(
    ", " + sql_cascade("comments_v", "id", "description", "grade", lx.SCORES_FIVE_POINT, True, "FALSE") +
    """ SELECT id, CASE WHEN coalesce(sentiment_result, '') = '' THEN s_result ELSE sentiment_result END AS sentiment_result FROM casc""", "comments_v"))
def q_flag_then_label(spark, sf_dir):
    return labelling.flag_then_label(comments(spark, sf_dir)).select("id", "sentiment_result")


@query("label_pending", with_views(
    ", " + sql_cascade("comments_v", "id", "description", "grade", lx.SCORES_FIVE_POINT, True, "FALSE") +
    """ SELECT id, CASE WHEN coalesce(sentiment_result, '') = '' THEN s_result ELSE sentiment_result END AS sentiment_result,
  CASE WHEN coalesce(sentiment_result, '') = '' THEN s_score ELSE sentiment_score END AS sentiment_score,
  CASE WHEN coalesce(sentiment_result, '') = '' THEN s_second ELSE second_model_processed END AS second_model_processed FROM casc""", "comments_v"))
def q_label_pending(spark, sf_dir):
    return labelling.label_pending(comments(spark, sf_dir)).select("id", *CASCADE)


# --- classification -------------------------------------------------------------------------------------------
def sql_feature(title):
    cases = " ".join(
        f"WHEN contains({sq.match_form(title)}, {sq.match_form(sq.lit(k))}) THEN {sq.lit(v)}" for k, v in lx.FEATURE_OF_TITLE.items())
    return f"CASE WHEN coalesce({title}, '') = '' THEN 'other' {cases} ELSE 'other' END"


SQL_TYPE = ("CASE WHEN lower(trim({0})) IN ('positive', 'very positive') THEN 'praise' "
            "WHEN lower(trim({0})) IN ('negative', 'very negative') THEN 'criticism' ELSE 'other' END")
SQL_NEUTRAL = "coalesce(" + " OR ".join(f"contains(description, {sq.lit(p)})" for p in lx.NEUTRAL_PHRASES) + ", FALSE)"


@query("feature_from_title", with_views(f"SELECT id, {sql_feature('title')} AS feature FROM comments_v", "comments_v"))
def q_feature_from_title(spark, sf_dir):
    return comments(spark, sf_dir).select("id", rules.feature_from_title(F.col("title")).alias("feature"))


@query("type_from_sentiment", with_views(f"SELECT id, {SQL_TYPE.format('model1')} AS type FROM comments_v", "comments_v"))
def q_type_from_sentiment(spark, sf_dir):
    return comments(spark, sf_dir).select("id", rules.type_from_sentiment(F.col("model1")).alias("type"))


@query("force_neutral", with_views(f"SELECT id, {SQL_NEUTRAL} AS neutral FROM comments_v", "comments_v"))
def q_force_neutral(spark, sf_dir):
    return comments(spark, sf_dir).select("id", rules.has_neutral_phrase(F.col("description")).alias("neutral"))


SQL_SHORT = f"{sq.word_count(sq.match_form('description'))} < 3"


@query("short_comment", with_views(f"SELECT id, {SQL_SHORT} AS short FROM comments_v", "comments_v"))
def q_short_comment(spark, sf_dir):
    return comments(spark, sf_dir).select("id", rules.is_short(F.col("description")).alias("short"))


@query("classify_short", with_views(
    f"""SELECT id, CASE WHEN {SQL_NEUTRAL} THEN 'other' ELSE {SQL_TYPE.format('sentiment_result')} END AS type, 'other' AS category, title AS short_title,
{sq.match_form('title')} AS normalized_title, 'عمومی' AS keywords, description AS evidence, 'rule_based_short_comment' AS model, {sql_feature('title')} AS ai_title
FROM comments_v WHERE {SQL_SHORT}""", "comments_v"))
def q_classify_short(spark, sf_dir):
    fields = rules.short_comment_fields(F.col("description"), F.col("title"), F.col("sentiment_result"))
    rows = comments(spark, sf_dir).filter(rules.is_short(F.col("description")))
    made = rows.select("id", *[c.alias(n) for n, c in fields.items()])
    return made.withColumn("keywords", F.array_join("keywords", "|"))


# --- replies of a model: JSON texts made from the analysed events ------------------------------------------------
CATEGORY_VALUES = ["auth", " UI ", "Authentication", "customer support", "billing", ""]
FEATURE_VALUES = ["card", "AI", "ai_assistant", "ai assistant", "In General", "weather"]
WRAPPERS = ["{}", "```json\n{}\n```", "Sure: {} done {{}}", "no object", "", "[1] {}", "{} }}"]


def replies(spark, sf_dir):
    """Analysed events with a semantic and a category reply, well-formed and not."""
    from .views import pick
    k, e = F.col("k"), F.col("comment_id")
    base = analysis(spark, sf_dir).withColumn("k", F.regexp_extract("evidence", r"\d+", 0).cast("int"))
    body = F.concat(
        F.lit('{"type": "'), pick([*lx.TYPES, "rant"], k % 7), F.lit('", "ai_title": "'), pick(FEATURE_VALUES, k % 6),
        F.lit('", "short_title": "'), "short_title", F.lit('", "normalized_title": "'), F.coalesce("normalized_title", F.lit("")),
        F.lit('", "keywords": ["'), F.array_join("keywords", '", "'), F.lit('"], "evidence": "'), "evidence",
        F.when(e % 7 == 6, F.lit('"')).otherwise(F.lit('"}')))
    category = F.concat(F.lit('{"category": "'), pick(CATEGORY_VALUES, k % 6), F.lit('"}'))
    wrapped = F.when(F.lit(False), "")
    for i, shape in enumerate(WRAPPERS):
        head, _, tail = shape.replace("{{}}", "\x00").replace("}}", "\x01").partition("{}")
        tail = tail.replace("\x00", "{}").replace("\x01", "}")
        made = F.concat(F.lit(head), body, F.lit(tail)) if "{}" in shape.replace("{{}}", "") else F.lit(shape)
        wrapped = wrapped.when(e % 7 == i, made)
    text = F.concat(F.lit(" "), F.when(e % 4 == 0, "").otherwise(F.concat(F.lit("x "), "evidence", F.lit("‌  y "))), F.repeat(F.lit("متن "), 80))
    return base.select(
        e.alias("id"), "created_at", "sentiment_result", "title", "k", text.alias("description"),
        wrapped.alias("semantic_raw"), F.when(e % 13 == 0, "nothing").otherwise(category).alias("category_raw"))


def _sql_replies():
    from .views import sql_pick
    body = (
        f"""'{{"type": "' || {sql_pick([*lx.TYPES, 'rant'], 'k % 7')} || '", "ai_title": "' || {sql_pick(FEATURE_VALUES, 'k % 6')} || '", "short_title": "' || short_title
  || '", "normalized_title": "' || coalesce(normalized_title, '') || '", "keywords": ["' || array_to_string(keywords, '", "') || '"], "evidence": "' || evidence
  || CASE WHEN comment_id % 7 = 6 THEN '"' ELSE '"}}' END""")
    return f"""replies AS (SELECT comment_id AS id, created_at, sentiment_result, title, k,
  ' ' || CASE WHEN comment_id % 4 = 0 THEN '' ELSE 'x ' || evidence || chr(8204) || '  y ' END || repeat('متن ', 80) AS description,
  CASE comment_id % 7 WHEN 0 THEN body WHEN 1 THEN '```json' || chr(10) || body || chr(10) || '```' WHEN 2 THEN 'Sure: ' || body || ' done {{}}'
    WHEN 3 THEN 'no object' WHEN 4 THEN '' WHEN 5 THEN '[1] ' || body ELSE body || ' }}' END AS semantic_raw,
  CASE WHEN comment_id % 13 = 0 THEN 'nothing' ELSE '{{"category": "' || {sql_pick(CATEGORY_VALUES, 'k % 6')} || '"}}' END AS category_raw
  FROM (SELECT *, {body} AS body FROM (SELECT *, CAST(regexp_extract(evidence, '[0-9]+') AS INTEGER) AS k FROM analysis_v)))"""


SQL_REPLIES = ", " + _sql_replies()


def sql_json(raw, greedy=False):
    body = f"regexp_extract({sq.strip(sq.rx(raw, '```(?:json)?', ''))}, {sq.lit('(?s)' + chr(92) + '{.*' + ('' if greedy else '?') + chr(92) + '}')})"
    return f"CASE WHEN {body} <> '' AND json_valid({body}) THEN {body} END"


@query("extract_json", with_views(
    SQL_REPLIES + f", j AS (SELECT id, {sql_json('semantic_raw')} AS a, {sql_json('semantic_raw', True)} AS b FROM replies) "
    "SELECT id, json_extract_string(a, '$.type') AS type, json_extract_string(a, '$.evidence') AS evidence, json_extract_string(b, '$.short_title') AS greedy_title, "
    "a IS NULL AS failed FROM j", "analysis_v"))
def q_extract_json(spark, sf_dir):
    rows = replies(spark, sf_dir).select(
        "id", mo.extract_json(F.col("semantic_raw"), schemas.SEMANTIC_REPLY).alias("a"),
        mo.extract_json(F.col("semantic_raw"), schemas.SEMANTIC_REPLY, greedy=True).alias("b"))
    return rows.select("id", "a.type", "a.evidence", F.col("b.short_title").alias("greedy_title"), F.col("a").isNull().alias("failed"))


# Four spoilt spellings of one object: trailing comma, Python literal, fence, nothing.
@query("repair_json", with_views(
    "SELECT comment_id AS id, CASE WHEN comment_id % 4 < 3 THEN type END AS type, "
    "CASE WHEN comment_id % 4 < 3 THEN title || CASE WHEN comment_id % 4 = 1 THEN '' ELSE 'x' END END AS short_title, comment_id % 4 = 3 AS failed FROM analysis_v", "analysis_v"))
def q_repair_json(spark, sf_dir):
    e = F.col("comment_id")
    raw = (
        F.when(e % 4 == 0, F.concat(F.lit('Here: {"type": "'), "type", F.lit('", "short_title": "'), "title", F.lit('‌x", }')))
        .when(e % 4 == 1, F.concat(F.lit("{'type': '"), "type", F.lit("', 'short_title': '"), "title", F.lit("', 'evidence': None, 'ok': True}")))
        .when(e % 4 == 2, F.concat(F.lit('```json\n{"keywords": ["a", ], "type": "'), "type", F.lit('", "short_title": "'), "title", F.lit('x"}\n```')))
        .otherwise(F.concat(F.lit("{'type': "), "type", F.lit(", }"))))
    rows = analysis(spark, sf_dir).select(e.alias("id"), mo.repair_json(raw, schemas.SEMANTIC_REPLY).alias("a"))
    return rows.select("id", "a.type", "a.short_title", F.col("a").isNull().alias("failed"))


SQL_MERGE = SQL_REPLIES + f""", parsed AS (SELECT *, {sql_json('semantic_raw')} AS s, {sql_json('category_raw')} AS c FROM replies),
merged AS (SELECT id AS comment_id, title, description AS comment_text, json_extract_string(s, '$.type') AS type,
  CASE WHEN c IS NULL THEN 'other' ELSE json_extract_string(c, '$.category') END AS category, json_extract_string(s, '$.short_title') AS short_title,
  json_extract_string(s, '$.normalized_title') AS normalized_title, CAST(json_extract(s, '$.keywords') AS VARCHAR[]) AS keywords,
  json_extract_string(s, '$.evidence') AS evidence,
  CASE WHEN json_extract_string(s, '$.ai_title') = 'ai assistant' THEN 'ai' ELSE json_extract_string(s, '$.ai_title') END AS ai_title,
  CASE WHEN s IS NULL THEN 'no semantic object' WHEN json_extract_string(s, '$.ai_title') IS NULL THEN 'no ai_title' WHEN c IS NULL THEN 'no category object'
    WHEN json_extract_string(c, '$.category') IS NULL THEN 'no category' END AS failure
  FROM parsed)"""


@query("merge_llm", with_views(
    SQL_MERGE + " SELECT comment_id, title, type, category, short_title, normalized_title, array_to_string(keywords, '|') AS keywords, evidence, ai_title, failure FROM merged", "analysis_v"))
def q_merge_replies(spark, sf_dir):
    merged = mo.merge_replies(replies(spark, sf_dir), "semantic_raw", "category_raw").drop("created_at", "sentiment_result", "comment_text")
    return merged.withColumn("keywords", F.array_join("keywords", "|"))


def _sql_checked(value, aliases, allowed):
    normal = sq.case_map("x", aliases, "x")
    return f"(SELECT CASE WHEN {normal} IN {sq.in_list(allowed)} THEN v ELSE 'other' END FROM (SELECT {value} AS v, lower(trim(coalesce({value}, ''))) AS x))"


@query("validate_analysis", with_views(
    SQL_MERGE + f""" SELECT comment_id, CASE WHEN failure IS NOT NULL THEN failure WHEN evidence IS NULL THEN 'no evidence' WHEN normalized_title IS NULL THEN 'no normalized_title'
  WHEN keywords IS NULL OR len(list_filter(keywords, lambda w: w IS NULL)) > 0 THEN 'no keywords' WHEN short_title IS NULL THEN 'no short_title' ELSE 'ok' END AS status,
  CASE WHEN type IN {sq.in_list(lx.TYPES)} THEN type ELSE 'other' END AS type, {_sql_checked('category', lx.CATEGORY_ALIASES, lx.CATEGORIES)} AS category,
  {_sql_checked('ai_title', lx.FEATURE_ALIASES, lx.FEATURES)} AS ai_title,
  CASE WHEN contains({sq.match_form('comment_text')}, {sq.match_form('evidence')}) THEN evidence ELSE left({sq.strip('comment_text')}, 300) END AS evidence,
  coalesce(nullif(array_to_string(list_slice(list_filter(keywords, lambda w: NOT regexp_matches(w, '[A-Za-z]')), 1, 6), '|'), ''), 'عمومی') AS keywords
FROM merged""", "analysis_v"))
def q_validate_analysis(spark, sf_dir):
    merged = mo.merge_replies(replies(spark, sf_dir), "semantic_raw", "category_raw")
    valid = mo.validate_analysis(merged)
    return valid.select("comment_id", "status", "type", "category", "ai_title", "evidence", F.array_join("keywords", "|").alias("keywords"))


# Two of three analysed events have no finished analysis yet; every third waiting one has a text of two words.
SQL_WAITING = SQL_REPLIES.replace("replies AS (", "all_replies AS (", 1) + """, replies AS (SELECT * REPLACE (CASE WHEN id % 3 = 1 THEN 'خوب' || title ELSE description END AS description)
  FROM all_replies WHERE id % 3 <> 0)"""


def _waiting(spark, sf_dir):
    all_rows = replies(spark, sf_dir)
    text = F.when(F.col("id") % 3 == 1, F.concat(F.lit("خوب"), "title")).otherwise(F.col("description"))
    waiting = all_rows.select(
        "id", "title", "created_at", "sentiment_result", text.alias("description"), F.lit(False).alias("is_repetitive"),
        F.lit(1).alias("sentiment_score"), F.lit(False).alias("is_analyzed"))
    done = analysis(spark, sf_dir).filter(F.col("comment_id") % 3 == 0).withColumn("ai_title", F.lit("card"))
    return waiting, done, all_rows.select("id", "semantic_raw", "category_raw")


@query("classify_pending", with_views(
    SQL_WAITING + SQL_MERGE[len(SQL_REPLIES):] + f""", checked AS (SELECT comment_id, CASE WHEN {SQL_SHORT.replace('description', 'comment_text')} THEN 'ok' WHEN failure IS NOT NULL THEN failure
  WHEN evidence IS NULL THEN 'no evidence' WHEN normalized_title IS NULL THEN 'no normalized_title'
  WHEN keywords IS NULL OR len(list_filter(keywords, lambda w: w IS NULL)) > 0 THEN 'no keywords' WHEN short_title IS NULL THEN 'no short_title' ELSE 'ok' END AS status FROM merged)
SELECT comment_id, status, status = 'ok' AS is_analyzed, status = 'ok' AS written FROM checked""", "analysis_v"))
def q_classify_pending(spark, sf_dir):
    comments_now, written, outcomes = classification.classify_pending(*_waiting(spark, sf_dir), processed_at=F.lit("2026-01-06").cast("timestamp"))
    marked = comments_now.select(F.col("id").alias("comment_id"), "is_analyzed")
    ids = written.select("comment_id", F.lit(True).alias("written"))
    return outcomes.join(marked, "comment_id").join(ids, "comment_id", "left").select("comment_id", "status", "is_analyzed", F.coalesce("written", F.lit(False)).alias("written"))


@query("classify_pending_totals", with_views(
    SQL_WAITING + SQL_MERGE[len(SQL_REPLIES):] + f""", checked AS (SELECT CASE WHEN {SQL_SHORT.replace('description', 'comment_text')} THEN 'ok' WHEN failure IS NOT NULL THEN failure
  WHEN evidence IS NULL OR normalized_title IS NULL OR keywords IS NULL OR short_title IS NULL OR len(list_filter(keywords, lambda w: w IS NULL)) > 0 THEN 'no' ELSE 'ok' END AS status FROM merged)
SELECT count(*) FILTER (WHERE status = 'ok') AS processed, count(*) FILTER (WHERE status <> 'ok') AS failed, 0 AS flagged FROM checked""", "analysis_v"))
def q_classify_pending_totals(spark, sf_dir):
    outcomes = classification.classify_pending(*_waiting(spark, sf_dir))[2]
    return reports.run_totals(outcomes.withColumn("is_repetitive", F.lit(False)))


LEVEL_VALUES = ["high", None, "urgent"]


@query("validate_strict", with_views(
    SQL_REPLIES + f""", r AS (SELECT a.*, r.description AS text, r.k AS k FROM analysis_v a JOIN replies r ON r.id = a.comment_id)
SELECT comment_id AS id, array_to_string(list_filter([
  CASE WHEN type NOT IN {sq.in_list(lx.STRICT_TYPES)} THEN 'type' END, CASE WHEN category NOT IN {sq.in_list(lx.STRICT_CATEGORIES)} THEN 'category' END,
  CASE WHEN k % 3 = 2 THEN 'severity' END, CASE WHEN (k + 1) % 3 = 2 THEN 'priority' END,
  CASE WHEN NOT contains(text, evidence) THEN 'evidence_quote' END, 'evidence_latin', 'short_title_latin',
  CASE WHEN {sq.latin('normalized_title')} THEN 'normalized_title_latin' END,
  CASE WHEN len(list_filter(keywords, lambda w: regexp_matches(w, '[A-Za-z]'))) > 0 THEN 'keyword_latin' END], lambda f: f IS NOT NULL), '|') AS failed FROM r""", "analysis_v"))
def q_validate_strict(spark, sf_dir):
    from .views import pick
    text = replies(spark, sf_dir).select(F.col("id").alias("comment_id"), F.col("description").alias("comment_text"), "k")
    rows = analysis(spark, sf_dir).join(text, "comment_id").withColumns(
        {"severity": pick(LEVEL_VALUES, F.col("k") % 3), "priority": pick(LEVEL_VALUES, (F.col("k") + 1) % 3)})
    return rows.select(F.col("comment_id").alias("id"), F.array_join(mo.strict_failures(), "|").alias("failed"))


# --- structured summaries ---------------------------------------------------------------------------------------
def summary_parts(spark, sf_dir):
    """Replies of the three summary prompts, with gaps, from the analysed events."""
    e = F.col("comment_id")
    issue = F.concat(F.lit('[{"issue": "'), "title", F.lit('", "severity": "'), F.when(e % 3 == 0, "high").otherwise("severe"),
                     F.lit('"'), F.when(e % 2 == 0, ', "confidence": "low", "affected_titles": ["t"]').otherwise(""), F.lit("}]"))
    suggestion = F.when(e % 5 == 0, "{}").otherwise(F.concat(F.lit('[{"suggestion": "s", "priority": "'), F.when(e % 3 == 1, "low").otherwise(""), F.lit('"}]')))
    outlier = F.concat(F.lit('[{"item": "'), "short_title", F.lit('", "evidence": ["کند '), e.cast("string"),
                       F.when(e % 4 == 0, '", "other').otherwise(""), F.lit('"]}, {"item": "z", "evidence": []}]'))
    return analysis(spark, sf_dir).select(
        e.alias("id"), "sentiment_result", "title", issue.alias("issues"), suggestion.alias("suggestions"), outlier.alias("outliers"),
        F.array(F.concat(F.lit(" برنامه کند "), e.cast("string"), F.lit(" است")), F.lit(None).cast("string"), F.lit(" ")).alias("inputs"))


def _parsed_parts(spark, sf_dir):
    from pyspark.sql import types as T
    array = lambda name, item: F.from_json(name, T.ArrayType(item))
    return summary_parts(spark, sf_dir).withColumns({
        "issues": array("issues", schemas.ISSUE), "suggestions": array("suggestions", schemas.SUGGESTION),
        "outliers": array("outliers", schemas.OUTLIER)})



@query("complete_summary", with_views(
    """SELECT comment_id AS id, 'app' AS app, 'fa' AS language, 'm' AS model, CASE WHEN comment_id % 3 = 0 THEN 'high' ELSE 'medium' END AS severity,
  'medium' AS frequency, CASE WHEN comment_id % 2 = 0 THEN 'low' ELSE 'medium' END AS confidence, 'neutral' AS grp,
  CASE WHEN comment_id % 2 = 0 THEN 't' ELSE '' END AS titles, 0 AS actions FROM analysis_v""", "analysis_v"))
def q_complete_summary(spark, sf_dir):
    raw = F.concat(F.lit('{"top_issues": '), "issues", F.lit(', "outliers": "none", "meta": null}'))
    whole = mo.extract_json(raw, schemas.SUMMARY, greedy=True)
    rows = summary_parts(spark, sf_dir).select("id", whole.alias("s"))
    rows = rows.select("id", mo.complete_summary(F.col("s"), app="app", generated_at=F.lit("2026-01-01"), model="m").alias("s"))
    first = F.get("s.top_issues", F.lit(0))
    return rows.select(
        "id", "s.meta.app", "s.meta.language", "s.meta.model", first["severity"].alias("severity"), first["frequency_estimate"].alias("frequency"),
        first["confidence"].alias("confidence"), first["sentiment_group"].alias("grp"), F.array_join(first["affected_titles"], "|").alias("titles"),
        (F.size("s.outliers") + F.size("s.recommended_actions")).alias("actions"))


@query("fix_evidence", with_views(
    "SELECT comment_id AS id, CASE WHEN comment_id % 4 = 0 THEN short_title ELSE 'کند ' || CAST(comment_id AS VARCHAR) END AS first_evidence, 'z' AS second_evidence FROM analysis_v", "analysis_v"))
def q_fix_evidence(spark, sf_dir):
    fixed = _parsed_parts(spark, sf_dir).select("id", mo.fix_evidence(F.col("outliers"), F.col("inputs")).alias("o"))
    evidence = lambda i: F.array_join(F.get("o", F.lit(i))["evidence"], "|")
    return fixed.select("id", evidence(0).alias("first_evidence"), evidence(1).alias("second_evidence"))


@query("assemble_summary", with_views(
    """SELECT comment_id AS id, title AS title_hint, sentiment_result AS meta_group, sentiment_result AS issue_group, CASE WHEN comment_id % 5 > 0 THEN 'x' END AS has_suggestion,
  CASE WHEN comment_id % 5 = 0 THEN NULL WHEN comment_id % 3 = 1 THEN 'low' ELSE 'medium' END AS priority, 2 AS outliers, 0 AS actions FROM analysis_v""", "analysis_v"))
def q_assemble_summary(spark, sf_dir):
    c = F.col
    parsed = _parsed_parts(spark, sf_dir).withColumn("suggestions", F.when(c("id") % 5 > 0, c("suggestions")))
    whole = mo.assemble_summary(
        c("issues"), c("suggestions"), c("outliers"), c("inputs"), app="app", model="m", title_hint=c("title"),
        sentiment_hint=c("sentiment_result"), generated_at=F.lit("2026-01-01"))
    rows = parsed.select("id", whole.alias("s"))
    suggestion = F.get("s.top_suggestions", F.lit(0))
    return rows.select(
        "id", "s.meta.title_hint", F.col("s.meta.sentiment_group").alias("meta_group"),
        F.get("s.top_issues", F.lit(0))["sentiment_group"].alias("issue_group"),
        F.when(suggestion["suggestion"] == "s", "x").alias("has_suggestion"), suggestion["priority"].alias("priority"),
        F.size("s.outliers").alias("outliers"), F.size("s.recommended_actions").alias("actions"))


@query("bullet_list", with_views(
    f"""SELECT id, coalesce(nullif(array_to_string(list_transform(list_slice(list_filter(list_transform(string_split(description, '.'), lambda s: {sq.strip('s')}),
  lambda s: s <> ''), 1, 5), lambda s: '- ' || s), chr(10)), ''), '- (هیچ موردی)') AS bullets FROM texts_v""", "texts_v"))
def q_bullet_list(spark, sf_dir):
    return texts(spark, sf_dir).select("id", mo.bullet_list(F.split("description", r"\."), 5).alias("bullets"))


# --- a user's model -----------------------------------------------------------------------------------------------
def count_words(batch: pd.DataFrame) -> pd.DataFrame:
    """Stands for a model: words and characters of the comment."""
    text = batch["normal"].fillna("")
    return pd.DataFrame({"words": text.str.split().str.len(), "characters": text.str.len()})


@query("score_with", with_views(
    f"SELECT id, {sq.word_count(sq.match_form('description'))} AS words, length({sq.match_form('description')}) AS characters FROM comments_v", "comments_v"))
def q_score_with(spark, sf_dir):
    rows = comments(spark, sf_dir).select("id", normalize_for_match(F.col("description")).alias("normal"))
    return scoring.score_with(rows, count_words, "words long, characters long").drop("normal")
