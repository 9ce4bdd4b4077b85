"""Schemas of the tables and of the JSON that models return."""

from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
NTZ, TS = T.TimestampNTZType(), T.TimestampType()
WORDS = T.ArrayType(S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


COMMENTS = _struct(
    id=L, title=S, grade=I, description=S, national_code_hash=S, mobile_no_hash=S, created_at=NTZ,
    imported_at=TS, sentiment_result=S, sentiment_score=I, second_model_processed=B, is_repetitive=B,
    duplicate_of=L, channel_code=S, is_analyzed=B,
)
COMMENT_ANALYSIS = _struct(
    comment_id=L, created_at=NTZ, sentiment_result=S, title=S, type=S, category=S, short_title=S,
    normalized_title=S, keywords=WORDS, evidence=S, model=S, processed_at=TS, ai_title=S,
)
COMMENT_SUMMARIES = _struct(
    sentiment_result=S, title=S, type=S, category=S, summarized_comment=S, count=L, processed_at=TS,
)
JOB_FILTER = _struct(
    titles=WORDS, types=WORDS, categories=WORDS, sentiments=WORDS, start_date=S, end_date=S,
)
SUMMARY_JOBS = _struct(
    summarized_id=L, user_id=L, created_at=NTZ, filter=JOB_FILTER, summarized_comment=S, comment_count=L,
    status=S, duration_seconds=T.DecimalType(10, 2), model=S, is_deleted=B,
)
ASSISTANT_FEEDBACK = _struct(
    turn_id=L, user_message=S, assistant_message=S, imported_at=TS, is_liked=B, created_at=NTZ,
    q1=S, q2=S, q3=S,
)
APP_COMMENTS = _struct(
    comment_id=L, app_id=L, user_name=S, comment_text=S, comment_rating=T.DoubleType(),
    comment_date=T.DateType(), second_model_processed=B, comment_idd=L, comment_date_jalali=I,
    sentiment_result=S, sentiment_score=I,
)
# One analysed comment per line.
COMMENT_RECORD = _struct(
    comment_id=S, created_at=S, sentiment_group=S, type=S, category=S, short_title=S, normalized_title=S,
    keywords=WORDS, severity=S, priority=S, evidence=S, model=S, processed_at=S,
)

# What the two model stages return.
SEMANTIC_REPLY = _struct(
    type=S, ai_title=S, short_title=S, normalized_title=S, keywords=WORDS, evidence=S,
)
CATEGORY_REPLY = _struct(category=S)
SUMMARY_REPLY = _struct(summarized_comment=S)

# Structured summary.
ISSUE = _struct(
    issue=S, severity=S, frequency_estimate=S, confidence=S, sentiment_group=S, evidence=WORDS, impact=S,
    affected_titles=WORDS,
)
SUGGESTION = _struct(
    suggestion=S, priority=S, frequency_estimate=S, confidence=S, sentiment_group=S, evidence=WORDS,
    affected_titles=WORDS,
)
OUTLIER = _struct(item=S, risk_level=S, confidence=S, sentiment_group=S, evidence=WORDS, why_outlier=S)
ACTION = _struct(action=S, owner=S, priority=S, maps_to=S, related_issue_index=I, reference=S)
SUMMARY_META = _struct(app=S, language=S, generated_at=S, model=S, title_hint=S, sentiment_group=S)
SUMMARY = _struct(
    meta=SUMMARY_META, top_issues=T.ArrayType(ISSUE), top_suggestions=T.ArrayType(SUGGESTION),
    outliers=T.ArrayType(OUTLIER), recommended_actions=T.ArrayType(ACTION),
)
