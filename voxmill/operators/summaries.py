"""Grouped summarisation: which groups, which texts, and what became of the jobs.

The reference form asks one query per combination of title, type, category and
sentiment; here the requested groups are joined to the analysed comments once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import feature_from_title, labels_of_group
from ..functions.dates import month_number
from ..functions.text import normalize_for_match
from ..session import cut_lineage
from .ordering import add_position

CHUNK = 80
FAN_IN = 1_000  # chunk summaries that one row joins; more come as further parts
JOB_MIN = 5  # a job needs more than 4 comments in each of its groups
BATCH_MIN = 6  # a batch skips groups of 5 and fewer
GROUP = ["title", "type", "category", "sentiment"]
MONTHS = (197001, 210012)  # months (year * 100 + month) that are told apart; all before, and all after, are one
LISTS = {"titles": "title", "types": "type", "categories": "category", "sentiments": "sentiment"}
MISSING_FILTER, TOO_FEW, NO_TEXT = (
    "One or more required filters are missing",
    "Not enough comments for summarization",
    "No usable text",
)


def job_problem() -> Column:
    """Why a job cannot start; null when it can."""
    empty = [F.coalesce(F.size(F.col(f"filter.{c}")) <= 0, F.lit(True)) for c in LISTS]
    blank = [F.coalesce(F.col(f"filter.{c}"), F.lit("")) == "" for c in ("start_date", "end_date")]
    problem = empty[0]
    for test in empty[1:] + blank:
        problem = problem | test
    return F.when(F.col("summarized_id").isNull(), "No job id").when(problem, MISSING_FILTER)


def expand_jobs(jobs: DataFrame) -> DataFrame:
    """(summarized_id, group_no, title, type, category, sentiment, start_date, end_date)
    for every combination asked for, numbered in loop order; repeats stay."""
    rows = jobs.filter(job_problem().isNull()).select("summarized_id", "filter")
    rows = rows.select(
        "summarized_id", "filter", F.col("filter.start_date").alias("start_date"), F.col("filter.end_date").alias("end_date"),
    )
    number = F.lit(0).cast("long")
    for plural, single in LISTS.items():
        rows = rows.select("*", F.posexplode(f"filter.{plural}").alias(f"_p_{single}", single))
        number = number * F.size(F.col(f"filter.{plural}")) + F.col(f"_p_{single}")
    return rows.select("summarized_id", number.alias("group_no"), *GROUP, "start_date", "end_date")


def map_sentiment(groups: DataFrame) -> DataFrame:
    """One row per label behind the sentiment of each group; unknown ones have none."""
    return groups.withColumn("sentiment_result", F.explode(labels_of_group(F.col("sentiment"))))


def _moment(text: Column) -> Column:
    """A date or time as the store reads it; null for what is none, far away for (minus) infinity."""
    word = F.lower(F.trim(text))
    far = {"infinity": "9999-12-31 23:59:59.999999", "-infinity": "0001-01-01"}
    ends = [F.when(word == name, F.lit(value).cast("timestamp_ntz")) for name, value in far.items()]
    return F.coalesce(*ends, F.trim(text).try_cast("timestamp_ntz"))


def group_comments(groups: DataFrame, analysis: DataFrame, *, month: str | None = None) -> DataFrame:
    """Analysed comments of each group: (summarized_id, group_no, comment_id, normalized_title).

    A comment belongs to a group of its title, type, category and sentiment whose dates, compared as times, hold its own
    (both ends included). Dates may be written with or without zeros and a time; ``infinity`` and ``-infinity`` are open ends; a
    null, a blank or anything else that is no date holds nothing.

    Groups are dealt to the months they ask for and joined on group and month; the exact times are compared after. ``month`` names
    a column of ``analysis`` with year * 100 + month, as a table partitioned by it has: then only the partitions that somebody asks for are
    read. Without it the month is derived. Times before and after MONTHS are kept with its first and last, so a range has at most as many months.
    """
    keys = ["title", "type", "category", "sentiment_result"]
    asked = map_sentiment(groups).select(
        "summarized_id", "group_no", *keys, _moment(F.col("start_date")).alias("_from"), _moment(F.col("end_date")).alias("_to"),
    ).filter(F.col("_from") <= F.col("_to"))
    bin_of = lambda number: F.greatest(F.lit(MONTHS[0]), F.least(F.lit(MONTHS[1]), number))
    index = lambda at: (F.floor(bin_of(month_number(at)) / 100) * 12 + bin_of(month_number(at)) % 100 - 1).cast("int")
    asked = asked.withColumn("_index", F.explode(F.sequence(index(F.col("_from")), index(F.col("_to")))))
    asked = asked.withColumn("_month", (F.floor(F.col("_index") / 12) * 100 + F.col("_index") % 12 + 1).cast("int"))
    found = analysis.select(
        "comment_id", "created_at", *keys, "normalized_title", bin_of(F.col(month) if month else month_number(F.col("created_at"))).alias("_month")
    )
    joined = found.join(asked, [*keys, "_month"])
    return joined.filter(F.col("created_at").between(F.col("_from"), F.col("_to"))).select("summarized_id", "group_no", "comment_id", "normalized_title")


def group_counts(analysis: DataFrame, min_count: int = 1) -> DataFrame:
    counts = analysis.groupBy("title", "type", "category", "sentiment_result").agg(F.count(F.lit(1)).alias("count"))
    return counts.filter(F.col("count") >= min_count)


def batch_groups(
    analysis: DataFrame, *, titles: Sequence[str], types: Sequence[str], categories: Sequence[str],
    sentiments: Sequence[str], min_count: int = BATCH_MIN, processed_at: Column | None = None,
) -> DataFrame:
    """Groups of the given lists that are large enough, with count and time."""
    asked = analysis.filter(
        F.col("title").isin(list(titles)) & F.col("type").isin(list(types))
        & F.col("category").isin(list(categories)) & F.col("sentiment_result").isin(list(sentiments))
    )
    return group_counts(asked, min_count).withColumn(
        "processed_at", processed_at if processed_at is not None else F.current_timestamp()
    )


def chunk_groups(rows: DataFrame, keys: Sequence[str], order: str, size: int = CHUNK, slot_width: int = 1_000_000) -> DataFrame:
    """Blocks of ``size`` consecutive rows per group: adds ``position`` and ``chunk``."""
    placed = add_position(rows, keys, order, "position", slot_width)
    return placed.withColumn("chunk", F.floor(F.col("position") / size))


def chunk_texts(comments: DataFrame, size: int = CHUNK) -> DataFrame:
    """(summarized_id, group_no, chunk, texts): texts of a chunk joined by line breaks.
    Empty titles are left out before the chunks are cut."""
    usable = comments.filter(F.coalesce("normalized_title", F.lit("")) != "")
    chunks = chunk_groups(usable, ["summarized_id", "group_no"], "comment_id", size)
    lines = F.transform(F.sort_array(F.collect_list(F.struct("position", "normalized_title"))), lambda r: r["normalized_title"])
    return chunks.groupBy("summarized_id", "group_no", "chunk").agg(F.array_join(lines, "\n").alias("texts"))


def group_sizes(groups: DataFrame, comments: DataFrame) -> DataFrame:
    """(summarized_id, group_no, comments, usable) for every group asked for."""
    usable = F.coalesce(F.col("normalized_title"), F.lit("")) != ""
    counts = comments.groupBy("summarized_id", "group_no").agg(
        F.count(F.lit(1)).alias("comments"), F.count_if(usable).alias("usable")
    )
    return groups.select("summarized_id", "group_no").join(counts, ["summarized_id", "group_no"], "left").na.fill(
        0, ["comments", "usable"]
    )


def job_status(jobs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(summarized_id, status, comment_count, reason): one thin group fails its job."""
    per_job = sizes.groupBy("summarized_id").agg(
        F.min("comments").alias("_fewest"), F.min("usable").alias("_least"), F.sum("comments").alias("_total")
    )
    reason = F.coalesce(
        F.col("_problem"),
        F.when(F.coalesce(F.col("_fewest"), F.lit(0)) < JOB_MIN, TOO_FEW).when(F.col("_least") < 1, NO_TEXT),
    )
    return (
        jobs.select("summarized_id", job_problem().alias("_problem"))
        .join(per_job, "summarized_id", "left")
        .withColumn("reason", reason)
        .select(
            "summarized_id",
            F.when(F.col("reason").isNull(), "completed").otherwise("failed").alias("status"),
            F.when(F.col("reason").isNull(), F.col("_total")).otherwise(0).alias("comment_count"),
            "reason",
        )
    )


def merge_chunks(summaries: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(summarized_id, group_no, part, chunks, text): a single chunk summary as it is,
    several as the input of a second pass, joined by line breaks.

    A group of more than ``fan_in`` chunks gets several parts, so no row grows without
    bound: summarise the parts and merge again (``part`` as ``chunk``) until one is left.
    """
    texts = F.transform(F.sort_array(F.collect_list(F.struct("chunk", "summary"))), lambda r: r["summary"])
    parts = summaries.withColumn("part", F.floor(F.col("chunk") / fan_in))
    return parts.groupBy("summarized_id", "group_no", "part").agg(
        F.count(F.lit(1)).alias("chunks"), F.array_join(texts, "\n").alias("text")
    )


def merge_until_one(summaries: DataFrame, summarise: Callable[[DataFrame], DataFrame], fan_in: int = FAN_IN) -> DataFrame:
    """(summarized_id, group_no, summary): one answer for each group.

    A group with one chunk keeps that chunk's summary. The summaries of several chunks are joined and summarised once more; beyond
    ``fan_in`` of them in parts, whose answers are joined and summarised again. A group that has its answer leaves the loop, so what
    becomes of it does not depend on the others.

    ``summarise`` gets rows with ``text`` and returns them with ``summary``, the text's own summary. Each round is written once, so
    no text is put to it twice.
    """
    if fan_in < 2:
        raise ValueError("fan_in of one never ends")
    keys = ["summarized_id", "group_no"]

    def counted(rows: DataFrame) -> DataFrame:
        return cut_lineage(rows.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_chunks")), keys))

    rows = counted(summaries.select(*keys, "chunk", "summary"))
    done = [rows.filter("_chunks = 1")]
    while not (several := rows.filter("_chunks > 1")).isEmpty():
        answers = summarise(merge_chunks(several, fan_in)).select(*keys, F.col("part").alias("chunk"), "summary")
        rows = counted(cut_lineage(answers))
        done.append(rows.filter("_chunks = 1"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.select(*keys, "summary")


def merge_groups(answers: DataFrame) -> DataFrame:
    """(summarized_id, summarized_comment): the answers (``summary``) of a job's groups in loop order, blank line between."""
    texts = F.transform(F.sort_array(F.collect_list(F.struct("group_no", "summary"))), lambda r: r["summary"])
    return answers.groupBy("summarized_id").agg(F.array_join(texts, "\n\n").alias("summarized_comment"))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """``{name}`` places of a template replaced by columns."""
    parts, rest = [], template
    while rest:
        places = [(rest.find("{" + name + "}"), name) for name in values]
        places = [p for p in places if p[0] >= 0]
        if not places:
            parts.append(F.lit(rest))
            break
        at, name = min(places)
        parts += [F.lit(rest[:at]), F.coalesce(values[name].cast("string"), F.lit(""))]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts) if parts else F.lit("")


def category_prompt_rows(
    analysis: DataFrame, comments: DataFrame, template: str, *, id: str = "id", text: str = "description"
) -> DataFrame:
    """(comment_id, prompt): the category prompt from the comment in match form (``comment_text``), type and ai_title."""
    texts = comments.select(F.col(id).alias("comment_id"), F.col(text).alias("_text"))
    values = {"comment_text": normalize_for_match(F.col("_text"))} | {name: F.col(name) for name in ("type", "ai_title")}
    asked = analysis.select("comment_id", "type", "ai_title").join(texts, "comment_id", "left")
    return asked.select("comment_id", fill_template(template, values).alias("prompt"))


def summary_prompt_rows(chunks: DataFrame, groups: DataFrame, template: str) -> DataFrame:
    """(summarized_id, group_no, chunk, prompt): the summary prompt of each chunk of texts of a group."""
    values = {name: F.col(name) for name in GROUP} | {"texts": F.col("texts")}
    named = chunks.join(groups.select("summarized_id", "group_no", *GROUP), ["summarized_id", "group_no"])
    return named.select("summarized_id", "group_no", "chunk", fill_template(template, values).alias("prompt"))


def prompt_rows(comments: DataFrame, template: str, *, text: str = "description", title: str = "title") -> DataFrame:
    """(id, prompt): the template with the comment in match form, and a hint at the feature."""
    prompt = fill_template(template, {"comment_text": normalize_for_match(F.col(text))})
    hint = F.concat(F.lit("\nLikely ai_title based on title of app section: "), feature_from_title(F.col(title)))
    return comments.select("id", F.concat(prompt, hint).alias("prompt"))
