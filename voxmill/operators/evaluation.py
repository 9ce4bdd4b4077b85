"""Predictions against annotation.

All measures come from the counts of (truth, prediction) pairs, which are as many as
there are label pairs; the rows themselves are aggregated once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx

UNMAPPED = "unmapped"


def annotated(rows: DataFrame, features: dict | None = None) -> DataFrame:
    """Rows with title, ai_title and Annot_title as (truth, predicted, baseline)."""
    pairs = [F.lit(v) for pair in (features or lx.FEATURE_OF_TITLE).items() for v in pair]
    complete = rows.dropna(subset=["title", "ai_title", "Annot_title"])
    return complete.select(
        F.col("Annot_title").alias("truth"),
        F.col("ai_title").alias("predicted"),
        F.coalesce(F.create_map(*pairs)[F.col("title")], F.lit(UNMAPPED)).alias("baseline"),
    )


def pair_counts(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    return rows.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(rows: DataFrame, truth: str, predicted: str, labels: DataFrame | None = None) -> DataFrame:
    """(truth, predicted, n) of the pairs that occur. With ``labels`` (one column ``label``, a short list of
    distinct labels) every pair of those, zero included: as many rows as labels by labels."""
    counts = pair_counts(rows, truth, predicted)
    if labels is None:
        return counts
    cells = labels.select(F.col("label").alias("truth")).join(labels.select(F.col("label").alias("predicted")))
    return cells.join(counts, ["truth", "predicted"], "left").select(
        "truth", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _per_label(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(label, hits, support, predicted_count) for every label seen on either side."""
    counts = pair_counts(rows, truth, predicted)
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    as_truth = counts.select(F.col("truth").alias("label"), hit.alias("hits"), F.col("n").alias("support"), F.lit(0).alias("predicted_count"))
    as_prediction = counts.select(F.col("predicted").alias("label"), F.lit(0).alias("hits"), F.lit(0).alias("support"), F.col("n").alias("predicted_count"))
    return as_truth.unionByName(as_prediction).groupBy("label").agg(
        F.sum("hits").alias("hits"), F.sum("support").alias("support"), F.sum("predicted_count").alias("predicted_count")
    )


def _with_measures(labels: DataFrame) -> DataFrame:
    return labels.withColumns(
        {
            "precision": _ratio(F.col("hits"), F.col("predicted_count")),
            "recall": _ratio(F.col("hits"), F.col("support")),
            "f1": _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted_count")),
        }
    )


def class_report(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per label."""
    return _with_measures(_per_label(rows, truth, predicted)).select(
        "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def eval_scores(rows: DataFrame, truth: str, predicted: str, name: str = "model") -> DataFrame:
    """Accuracy with macro and support-weighted precision, recall and F1, as one row."""
    labels = _with_measures(_per_label(rows, truth, predicted))
    weighted = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    measures = [F.round(_ratio(F.sum("hits"), F.sum("support")), 6).alias("accuracy")]
    measures += [F.round(F.avg(c), 6).alias(f"{c}_macro") for c in ("precision", "recall", "f1")]
    measures += [F.round(weighted(c), 6).alias(f"{c}_weighted") for c in ("precision", "recall", "f1")]
    return labels.agg(*measures).select(F.lit(name).alias("model"), "*")


def cohen_kappa(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Agreement beyond chance, as one row; 0 divided by 0 is null."""
    totals = _per_label(rows, truth, predicted).agg(
        F.sum("hits").alias("agree"), F.sum("support").alias("n"),
        F.sum(F.col("support").cast("double") * F.col("predicted_count")).alias("chance"),
    )
    observed, expected = F.col("agree") / F.col("n"), F.col("chance") / (F.col("n").cast("double") * F.col("n"))
    return totals.select(F.round(F.when(expected != 1, (observed - expected) / (1 - expected)), 6).alias("kappa"))


def compare_models(rows: DataFrame, truth: str, predictions: dict[str, str]) -> DataFrame:
    """One row of scores per predictor; ``predictions`` maps names to columns."""
    return reduce(
        lambda a, b: a.unionByName(b), [eval_scores(rows, truth, column, name) for name, column in predictions.items()]
    )
