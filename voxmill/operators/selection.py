"""Which rows a job works on. Plain filters, so that they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx


def _unlabelled() -> Column:
    return F.col("sentiment_result").isNull() | (F.col("sentiment_result") == "")


def select_for_ngrams(
    comments: DataFrame, *, title: str | None, sentiment: str | None = None, start=None, end=None,
    min_len: int = 2, limit: int | None = None,
) -> DataFrame:
    """Labelled, non-repeated comments with a text. The optional limit takes the first
    ids before texts below ``min_len`` are left out. ``title`` is a title or ``all``."""
    if not title:
        raise ValueError("title is not valid")
    rows = comments.filter(
        F.col("description").isNotNull() & (F.col("is_repetitive") == F.lit(False)) & (F.col("sentiment_score") > 0)
    )
    if sentiment:
        scores = lx.SCORES_OF_GROUP.get(sentiment.lower())
        if scores is None:
            raise ValueError("sentiment must be negative, neutral, positive or all")
        rows = rows.filter(F.col("sentiment_score").isin(scores))
    if start:
        rows = rows.filter(F.col("created_at") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        rows = rows.filter(F.col("created_at") <= F.lit(end).cast("timestamp_ntz"))
    if title.lower() != "all":
        rows = rows.filter(F.col("title") == title)
    if limit:
        rows = rows.orderBy("id").limit(limit)
    return rows.filter(F.char_length("description") >= min_len).select(
        "id", "title", "grade", "description",
        F.coalesce("sentiment_result", F.lit("")).alias("sentiment_result"),
    )


def select_for_duplicates(comments: DataFrame) -> DataFrame:
    return comments.filter(F.col("description").isNotNull() & (F.col("description") != "") & _unlabelled())


def select_for_sentiment(comments: DataFrame, limit: int | None = None) -> DataFrame:
    rows = comments.filter(_unlabelled()).select("id", "description", "grade")
    return rows.orderBy("id").limit(limit) if limit else rows


def select_app_comments(app_comments: DataFrame, app_id: int) -> DataFrame:
    rows = app_comments.filter((F.col("app_id") == app_id) & F.col("sentiment_score").isNull())
    return rows.select("comment_id", "comment_text", "comment_rating")


def select_unanalyzed(comments: DataFrame, analysis: DataFrame) -> DataFrame:
    """Scored, non-repeated, non-blank comments without a finished analysis."""
    done = analysis.filter(F.col("ai_title").isNotNull()).select(F.col("comment_id").alias("id"))
    open_rows = comments.filter(
        (F.col("is_repetitive") == F.lit(False))
        & F.col("description").isNotNull()
        & (F.trim("description") != "")  # U+0020 only, as in SQL
        & F.col("sentiment_score").isNotNull()
    )
    return open_rows.join(done, "id", "left_anti").select(
        F.col("id").alias("comment_id"), F.col("description").alias("comment_text"), "sentiment_result",
        "created_at", "title",
    )


def select_for_summary(
    analysis: DataFrame, *, type: str, category: str, title: str, sentiment: str | Sequence[str], start=None, end=None
) -> DataFrame:
    """Analysed comments of one (type, category, title) and one or several labels,
    optionally created between two times, both included."""
    rows = analysis.filter(
        (F.col("type") == type) & (F.col("category") == category) & (F.col("title") == title)
    )
    if isinstance(sentiment, str):
        rows = rows.filter(F.col("sentiment_result") == sentiment)
    else:
        rows = rows.filter(F.col("sentiment_result").isin(list(sentiment)))
    if start is not None and end is not None:
        rows = rows.filter(
            F.col("created_at").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
        )
    return rows.select("type", "category", "title", "sentiment_result", "normalized_title")


def apps_to_scan(apps: DataFrame, app_ids: Sequence[int] | None = None, *, every: bool = False) -> DataFrame:
    """Not deleted; or the active and not deleted among ``app_ids``; or every app."""
    if app_ids:
        apps = apps.filter(F.col("app_id").isin(list(app_ids)) & F.col("active") & ~F.col("deleted"))
    elif not every:
        apps = apps.filter(~F.col("deleted"))
    return apps.select("app_id", "nickname", "url")


def limit_period(
    labels: DataFrame, *, year: int, month: int, after: bool = True,
    sentiments: Sequence[str] | None = ("very negative", "negative"), rating_below: int | None = 6,
) -> DataFrame:
    """Rows of one year, after a month or in it; optionally of some labels and below a rating."""
    period = (F.col("year") == year) & ((F.col("month") > month) if after else (F.col("month") == month))
    if sentiments is not None:
        period = period & F.col("sentiment").isin(list(sentiments))
    if rating_below is not None:
        period = period & (F.col("rating") < rating_below)
    return labels.filter(period)


def missing_jalali(comments: DataFrame, app_id: int | None = None, column: str = "comment_date_jalali") -> DataFrame:
    rows = comments.filter(F.col(column).isNull() | (F.col(column) == 0))
    return rows.filter(F.col("app_id") == app_id) if app_id else rows
