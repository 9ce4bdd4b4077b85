"""Classification of comments as one job: select, rules or replies, checks, upsert, mark, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.model_output import merge_replies, validate_analysis
from ..functions.rules import is_short, short_comment_fields
from ..session import cut_lineage
from .merges import mark_analyzed, upsert_analysis
from .selection import select_unanalyzed


def classify(comments: DataFrame, analysis: DataFrame, replies: DataFrame, *, model: Column | str = "model") -> DataFrame:
    """Analysis rows, with ``status``, for every comment that waits for one.

    ``replies`` has id, semantic_raw and category_raw. Short comments are decided by rules; the others by
    their replies, checked and repaired; a comment without replies fails.
    """
    waiting = select_unanalyzed(comments, analysis)
    short = is_short(F.col("comment_text"))
    columns = ["comment_id", "created_at", "sentiment_result", "title", "type", "category", "short_title", "normalized_title", "keywords", "evidence", "ai_title", "model", "status"]
    fields = short_comment_fields(F.col("comment_text"), F.col("title"), F.col("sentiment_result"))
    by_rule = waiting.filter(short).withColumns(fields).withColumn("status", F.lit("ok")).select(*columns)
    asked = waiting.filter(~short).select(F.col("comment_id").alias("id"), F.col("comment_text").alias("description"), "sentiment_result", "created_at", "title")
    merged = merge_replies(asked.join(replies.select("id", "semantic_raw", "category_raw"), "id", "left"), "semantic_raw", "category_raw")
    named = F.lit(model) if isinstance(model, str) else model
    by_model = validate_analysis(merged).withColumn("model", named).select(*columns)
    return by_rule.unionByName(by_model)


def classify_pending(
    comments: DataFrame, analysis: DataFrame, replies: DataFrame, *, model: Column | str = "model", processed_at: Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(comments, analysis, outcomes) after every waiting comment was classified.

    Rows that did not fail are upserted and their comments marked; failed ones change nothing
    and wait for the next run. ``outcomes`` has comment_id and status; ``reports.run_totals`` sums it up.
    """
    rows = cut_lineage(classify(comments, analysis, replies, model=model))
    done = rows.filter(F.col("status") == "ok")
    written = upsert_analysis(analysis, done.drop("status"), processed_at=processed_at)
    marked = mark_analyzed(comments, done.select(F.col("comment_id").alias("id")))
    return marked, written, rows.select("comment_id", "status")
