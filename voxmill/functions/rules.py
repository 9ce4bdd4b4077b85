"""Sentiment and classification rules. What a model said is an input column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx
from .text import let, normalize_for_match, plain_pattern, strip, word_count


def _lookup(mapping: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])[key]


def validated_label(label: Column, text: Column) -> Column:
    """Whole-text phrases win over the model; unknown labels express no sentiment."""
    lowered = F.lower(label)
    return (
        F.when(text.isin(lx.NEUTRAL_PHRASES_SENTIMENT), lx.NO_SENTIMENT)
        .when(text.isin(lx.POSITIVE_PHRASES), "very positive")
        .when(lowered.isin(list(lx.SCORES_FIVE_POINT)), lowered)
        .otherwise(lx.NO_SENTIMENT)
    )


def validate_and_score(label: Column, text: Column, scores: dict | None = None) -> Column:
    """Struct (sentiment_result, sentiment_score)."""
    final = validated_label(label, text)
    score = _lookup(scores or lx.SCORES_FIVE_POINT, final)
    return F.struct(final.alias("sentiment_result"), score.alias("sentiment_score"))


def sentiment_cascade(
    text: Column,
    rating: Column,
    model1: Column,
    model2: Column,
    *,
    scores: dict | None = None,
    blank_rule: bool = True,
    failed: Column | None = None,
) -> Column:
    """Struct (sentiment_result, sentiment_score, second_model_processed).

    The second model counts only where the first is unclear and the rating agrees.
    Empty or failed model output means no sentiment; ``failed`` marks rows where
    anything else went wrong.
    """
    first = F.when(F.coalesce(model1, F.lit("")) == "", lx.NO_SENTIMENT).otherwise(model1)
    unclear = F.lower(first).isin(lx.UNCLEAR_LABELS)
    second = F.coalesce(model2, F.lit(lx.NO_SENTIMENT))
    to_negative = F.coalesce(unclear & (second == "NEGATIVE") & (rating == 1), F.lit(False))
    to_positive = F.coalesce(unclear & (second == "POSITIVE") & (rating == 5), F.lit(False))
    label = F.when(to_negative, "negative").when(to_positive, "positive").otherwise(first)
    checked = validate_and_score(label, text, scores)

    def row(label: Column, score: Column, used_second: Column) -> Column:
        return F.struct(
            label.alias("sentiment_result"),
            score.cast("int").alias("sentiment_score"),
            used_second.alias("second_model_processed"),
        )

    result = row(checked["sentiment_result"], checked["sentiment_score"], to_negative | to_positive)
    if failed is not None:
        missed = row(F.lit(lx.MISSED_LABEL), F.lit(lx.MISSED_SCORE), F.lit(False))
        result = F.when(F.coalesce(failed, F.lit(False)), missed).otherwise(result)
    if blank_rule:
        blank = strip(F.coalesce(text, F.lit(""))) == ""
        empty = row(F.lit(lx.EMPTY_LABEL), F.lit(lx.EMPTY_SCORE), F.lit(False))
        result = F.when(blank, empty).otherwise(result)
    return result


def sentiment_cascade_apps(text: Column, rating: Column, model1: Column, model2: Column, **options) -> Column:
    """The cascade on the signed scale and without the blank rule."""
    return sentiment_cascade(
        text, rating, model1, model2, scores=lx.SCORES_SIGNED, blank_rule=False, **options
    )


def sentiment_group(label: Column) -> Column:
    lowered = F.lower(label)
    return (
        F.when(lowered.isin("negative", "very negative"), "negative")
        .when(lowered.isin("positive", "very positive"), "positive")
        .otherwise("neutral")
    )


def labels_of_group(group: Column) -> Column:
    """Array of the labels behind a sentiment group; unknown groups have none."""
    arrays = {g: F.array(*[F.lit(v) for v in labels]) for g, labels in lx.SENTIMENT_LABELS_OF_GROUP.items()}
    found = F.create_map(*[part for g, a in arrays.items() for part in (F.lit(g), a)])[group]
    return F.coalesce(found, F.array().cast("array<string>"))


def feature_from_title(title: Column, features: dict | None = None) -> Column:
    """First keyword (map order) contained in the title decides; compared in match form."""

    def first_contained(normal: Column) -> Column:
        chain = F.when(normal == "", "other")
        for keyword, feature in (features or lx.FEATURE_OF_TITLE).items():
            chain = chain.when(F.contains(normal, normalize_for_match(F.lit(keyword))), feature)
        return chain.otherwise("other")

    return let(normalize_for_match(title), first_contained)


def type_from_sentiment(label: Column) -> Column:
    lowered = F.lower(strip(label))
    return (
        F.when(lowered.isin("positive", "very positive"), "praise")
        .when(lowered.isin("negative", "very negative"), "criticism")
        .otherwise("other")
    )


def has_neutral_phrase(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(plain_pattern(lx.NEUTRAL_PHRASES))), F.lit(False))


def is_short(text: Column, min_words: int = 3) -> Column:
    return word_count(normalize_for_match(text)) < min_words


def short_comment_fields(text: Column, title: Column, label: Column) -> dict[str, Column]:
    """Columns of an analysis row for a comment too short to ask a model about."""
    kind = F.when(has_neutral_phrase(text), "other").otherwise(type_from_sentiment(label))
    return {
        "type": kind,
        "category": F.lit("other"),
        "short_title": title,
        "normalized_title": normalize_for_match(title),
        "keywords": F.array(F.lit(lx.GENERAL_KEYWORD)),
        "evidence": text,
        "model": F.lit(lx.SHORT_COMMENT_MODEL),
        "ai_title": feature_from_title(title),
    }
