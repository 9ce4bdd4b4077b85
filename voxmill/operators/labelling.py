"""Sentiment labels for the rows that have none yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import sentiment_cascade
from .repeats import apply_flags, flag_repetitive
from .selection import _unlabelled, select_for_duplicates

LABEL_COLUMNS = ("sentiment_result", "sentiment_score", "second_model_processed")


def label_pending(comments: DataFrame, *, model1: str = "model1", model2: str = "model2", failed: str | None = None) -> DataFrame:
    """Whole table after every unlabelled row got its label, in one pass; the end state
    is that of taking the rows batch by batch."""
    label = sentiment_cascade(
        F.col("description"), F.col("grade"), F.col(model1), F.col(model2),
        failed=F.col(failed) if failed else None,
    )
    changed = comments.withColumn("_label", F.when(_unlabelled(), label))
    for name in LABEL_COLUMNS:
        changed = changed.withColumn(
            name, F.when(F.col("_label").isNotNull(), F.col(f"_label.{name}")).otherwise(F.col(name))
        )
    return changed.drop("_label")


def flag_then_label(comments: DataFrame, *, window_seconds: int = 3600, **models) -> DataFrame:
    """Repeats are flagged first: they are looked for among unlabelled rows only."""
    flags = flag_repetitive(select_for_duplicates(comments), window_seconds=window_seconds)
    return label_pending(apply_flags(comments, flags), **models)
