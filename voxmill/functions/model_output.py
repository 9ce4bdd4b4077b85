"""Reading, repairing and checking what a language model returned.

The replies are plain string columns; everything here is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import lexicon as lx
from .rules import has_neutral_phrase
from .text import SPACE, contains_latin, let, normalize_for_match, strip, word_count

EVIDENCE_LENGTH = 300
MAX_KEYWORDS = 6


def _no_words() -> Column:
    return F.array().cast("array<string>")


# --- JSON ---------------------------------------------------------------------------------------
def is_one_object(text: Column) -> Column:
    """Whether a text is exactly one JSON value: the parser alone would ignore what
    follows the first value, inside a list it cannot."""
    listed = F.concat(F.lit("["), text, F.lit("]"))
    return let(listed, lambda one: F.try_parse_json(one).isNotNull() & (F.json_array_length(one) == 1))


def json_text(raw: Column, greedy: bool = False) -> Column:
    """Text of the first JSON object outside markdown fences; null when there is none
    or it does not parse. Non-greedy ends at the first closing brace."""
    unfenced = strip(F.regexp_replace(raw, "```(?:json)?", ""))
    body = F.regexp_extract(unfenced, r"(?s)\{.*\}" if greedy else r"(?s)\{.*?\}", 0)
    return let(body, lambda b: F.when((b != "") & is_one_object(b), b))


def extract_json(raw: Column, schema: T.StructType, greedy: bool = False) -> Column:
    """The object as a struct; null is the error value."""
    return F.from_json(json_text(raw, greedy), schema)


def repaired_json_text(raw: Column) -> Column:
    """Greedy object with trailing commas and half-spaces removed, not yet parsed."""
    unfenced = F.regexp_replace(raw, rf"```(?:json)?{SPACE}*\n?", "")
    unfenced = strip(F.regexp_replace(unfenced, r"\n?```", ""))
    body = F.regexp_extract(unfenced, r"(?s)\{.*\}", 0)
    body = F.regexp_replace(body, rf",{SPACE}*([\}}\]])", "$1")
    return F.when(body != "", F.translate(body, lx.ZWNJ, ""))


def repair_json(raw: Column, schema: T.StructType) -> Column:
    """As ``extract_json`` on the repaired text; a text that is no JSON is read once
    more as a literal with single quotes and True / False / None."""
    broken = "_broken"
    checked = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    options = {"allowSingleQuotes": "true", "columnNameOfCorruptRecord": broken}

    def outside_quotes(part: Column) -> Column:
        for word, value in (("True", "true"), ("False", "false"), ("None", "null")):
            part = F.when(F.rlike(part, F.lit("^['\"]")), part).otherwise(F.regexp_replace(part, rf"(?<!\w){word}(?!\w)", value))
        return part

    def read(text: Column) -> Column:
        # Quoted strings whole, and what stands between them.
        parts = F.regexp_extract_all(text, F.lit(r"""(?s)"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[^"']+|["']"""), F.lit(0))
        literal = F.array_join(F.transform(parts, outside_quotes), "")
        lenient = let(
            F.from_json(literal, checked, options),
            lambda found: F.when(found[broken].isNull(), found.dropFields(broken)),
        )
        return F.when(is_one_object(text), F.from_json(text, schema)).otherwise(lenient)

    return let(repaired_json_text(raw), read)


# --- one analysed comment --------------------------------------------------------------------------
def merge_replies(comments: DataFrame, semantic_raw: str, category_raw: str) -> DataFrame:
    """Both replies of the model merged into analysis columns.

    Input: id, description, sentiment_result, created_at, title and the two raw
    columns. ``failure`` names what went wrong, null when nothing did.
    """
    parsed = comments.withColumn("_s", extract_json(F.col(semantic_raw), schemas.SEMANTIC_REPLY)).withColumn(
        "_c", extract_json(F.col(category_raw), schemas.CATEGORY_REPLY)
    )
    feature = F.col("_s.ai_title")
    return parsed.select(
        F.col("id").alias("comment_id"),
        "created_at",
        "sentiment_result",
        "title",
        F.when(has_neutral_phrase(F.col("description")), "other").otherwise(F.col("_s.type")).alias("type"),
        F.when(F.col("_c").isNull(), "other").otherwise(F.col("_c.category")).alias("category"),
        F.col("_s.short_title").alias("short_title"),
        F.col("_s.normalized_title").alias("normalized_title"),
        F.col("_s.keywords").alias("keywords"),
        F.col("_s.evidence").alias("evidence"),
        F.when(feature == "ai assistant", "ai").otherwise(feature).alias("ai_title"),
        F.col("description").alias("comment_text"),
        F.when(F.col("_s").isNull(), "no semantic object")
        .when(feature.isNull(), "no ai_title")
        .when(F.col("_c").isNull(), "no category object")
        .when(F.col("_c.category").isNull(), "no category")
        .alias("failure"),
    )


def _checked_value(value: Column, aliases: dict, allowed: list[str]) -> Column:
    """Compared trimmed, lower-cased and through its aliases, but kept as it came."""

    def check(normal: Column) -> Column:
        for alias, meaning in aliases.items():
            normal = F.when(normal == alias, meaning).otherwise(normal)
        return F.when(normal.isin(allowed), value).otherwise("other")

    return let(F.lower(strip(F.coalesce(value, F.lit("")))), check)


def validate_analysis(
    analysis: DataFrame, text: str = "comment_text", *, evidence_length: int | None = EVIDENCE_LENGTH, max_keywords: int | None = MAX_KEYWORDS
) -> DataFrame:
    """Analysis columns made valid in place; ``status`` is ``ok`` or the reason a row fails.

    A ``failure`` that the reading of replies has found stays the reason. Evidence that is not in the
    text is replaced by the first ``evidence_length`` characters of it, and ``max_keywords`` keywords are
    kept (the values of the reference form; None: all).
    """
    original = F.col(text)
    evidence_found = F.contains(normalize_for_match(original), normalize_for_match(F.col("evidence")))
    general = F.array(F.lit(lx.GENERAL_KEYWORD))
    keywords = let(
        F.filter(F.col("keywords"), lambda k: ~contains_latin(k)),
        lambda kept: F.when(F.size(kept) > 0, F.slice(kept, 1, max_keywords) if max_keywords else kept).otherwise(general),
    )
    failure = F.col("failure") if "failure" in analysis.columns else F.lit(None).cast("string")
    status = F.coalesce(failure, (
        F.when(F.col("evidence").isNull(), "no evidence")
        .when(F.col("normalized_title").isNull(), "no normalized_title")
        .when(F.col("keywords").isNull() | F.exists(F.col("keywords"), lambda k: k.isNull()), "no keywords")
        .when(F.col("category").isNull(), "no category")
        .when(F.col("ai_title").isNull(), "no ai_title")
        .when(F.col("short_title").isNull(), "no short_title")
        .when(word_count(F.col("short_title")) > 20, "short_title too long")
        .otherwise("ok")
    ))
    return analysis.withColumns(
        {
            "status": status,
            "type": F.when(F.col("type").isin(lx.TYPES), F.col("type")).otherwise("other"),
            "category": _checked_value(F.col("category"), lx.CATEGORY_ALIASES, lx.CATEGORIES),
            "ai_title": _checked_value(F.col("ai_title"), lx.FEATURE_ALIASES, lx.FEATURES),
            "evidence": F.when(evidence_found, F.col("evidence")).otherwise(
                F.substring(strip(original), 1, evidence_length) if evidence_length else strip(original)
            ),
            "keywords": keywords,
        }
    )


def strict_failures(text: str = "comment_text") -> Column:
    """Names of the rules a record breaks in the strict form, in rule order."""
    level_ok = lambda c: F.col(c).isNull() | F.col(c).isin(lx.LEVELS)
    rules = {
        "type": F.col("type").isin(lx.STRICT_TYPES),
        "category": F.col("category").isin(lx.STRICT_CATEGORIES),
        "severity": level_ok("severity"),
        "priority": level_ok("priority"),
        "evidence_quote": F.contains(F.col(text), F.col("evidence")),
        "evidence_latin": ~contains_latin(F.col("evidence")),
        "short_title_latin": ~contains_latin(F.col("short_title")),
        "normalized_title_latin": ~contains_latin(F.col("normalized_title")),
        "keyword_latin": ~F.exists(F.col("keywords"), contains_latin),
        "short_title_length": word_count(F.col("short_title")) <= 12,
    }
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.array_compact(F.array(*failed))


# --- structured summary ----------------------------------------------------------------------------
def _level(value: Column) -> Column:
    return F.when(value.isin(lx.LEVELS), value).otherwise("medium")


def _or_empty(array: Column, item: T.StructType) -> Column:
    return F.coalesce(array, F.array().cast(T.ArrayType(item)))


def complete_summary(
    summary: Column, *, app: str, generated_at: Column, model: str, default_group: str = "neutral"
) -> Column:
    """A summary struct (``schemas.SUMMARY``) with defaults for whatever is missing."""
    meta = summary["meta"]

    def issue(i: Column) -> Column:
        return i.withField("severity", _level(i["severity"])).withField(
            "frequency_estimate", _level(i["frequency_estimate"])
        ).withField("confidence", _level(i["confidence"])).withField(
            "sentiment_group", F.coalesce(i["sentiment_group"], F.lit(default_group))
        ).withField("affected_titles", F.coalesce(i["affected_titles"], _no_words()))

    def suggestion(s: Column) -> Column:
        return s.withField("priority", _level(s["priority"])).withField(
            "frequency_estimate", _level(s["frequency_estimate"])
        ).withField("confidence", _level(s["confidence"])).withField(
            "affected_titles", F.coalesce(s["affected_titles"], _no_words())
        )

    def outlier(o: Column) -> Column:
        return o.withField("risk_level", _level(o["risk_level"])).withField("confidence", _level(o["confidence"]))

    return F.struct(
        F.struct(
            F.coalesce(meta["app"], F.lit(app)).alias("app"),
            F.coalesce(meta["language"], F.lit("fa")).alias("language"),
            F.coalesce(meta["generated_at"], generated_at).alias("generated_at"),
            F.coalesce(meta["model"], F.lit(model)).alias("model"),
            meta["title_hint"].alias("title_hint"),
            meta["sentiment_group"].alias("sentiment_group"),
        ).alias("meta"),
        F.transform(_or_empty(summary["top_issues"], schemas.ISSUE), issue).alias("top_issues"),
        F.transform(_or_empty(summary["top_suggestions"], schemas.SUGGESTION), suggestion).alias("top_suggestions"),
        F.transform(_or_empty(summary["outliers"], schemas.OUTLIER), outlier).alias("outliers"),
        _or_empty(summary["recommended_actions"], schemas.ACTION).alias("recommended_actions"),
    )


def fix_evidence(outliers: Column, inputs: Column, length: int = EVIDENCE_LENGTH) -> Column:
    """Evidence that is no direct quote from ``inputs`` becomes the item's own text."""
    sources = F.filter(F.transform(inputs, strip), lambda s: s != "")

    def bad(e: Column) -> Column:
        quote = strip(e)
        return F.coalesce(
            (quote == "") | contains_latin(e) | ~F.exists(sources, lambda s: F.contains(s, quote)), F.lit(True)
        )

    def fixed(o: Column) -> Column:
        usable = (F.size(o["evidence"]) > 0) & ~F.exists(o["evidence"], bad)
        own = F.array(F.substring(F.coalesce(o["item"], F.lit("")), 1, length))
        return o.withField("evidence", F.when(usable, o["evidence"]).otherwise(own))

    return F.transform(outliers, fixed)


def assemble_summary(
    issues: Column,
    suggestions: Column,
    outliers: Column,
    outlier_inputs: Column,
    *,
    app: str,
    model: str,
    title_hint: Column,
    sentiment_hint: Column,
    generated_at: Column,
) -> Column:
    """Three partial replies and the context as one completed summary struct."""
    stamp = lambda item: item.withField("sentiment_group", sentiment_hint)
    meta = F.struct(
        F.lit(app).alias("app"),
        F.lit("fa").alias("language"),
        generated_at.alias("generated_at"),
        F.lit(model).alias("model"),
        title_hint.alias("title_hint"),
        sentiment_hint.alias("sentiment_group"),
    )
    parts = F.struct(
        meta.alias("meta"),
        F.transform(_or_empty(issues, schemas.ISSUE), stamp).alias("top_issues"),
        F.transform(_or_empty(suggestions, schemas.SUGGESTION), stamp).alias("top_suggestions"),
        F.transform(fix_evidence(_or_empty(outliers, schemas.OUTLIER), outlier_inputs), stamp).alias("outliers"),
        F.array().cast(T.ArrayType(schemas.ACTION)).alias("recommended_actions"),
    )
    return complete_summary(parts, app=app, generated_at=generated_at, model=model)


def bullet_list(items: Column, max_items: int) -> Column:
    """``- `` lines of the first non-blank items, or the fixed line for none."""
    kept = F.slice(F.filter(F.transform(items, strip), lambda i: i != ""), 1, max_items)
    lines = F.array_join(F.transform(kept, lambda i: F.concat(F.lit("- "), i)), "\n")
    return F.when(F.size(kept) > 0, lines).otherwise(lx.NOTHING_LINE)
