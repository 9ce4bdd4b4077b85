"""Comments that stand for a group: leading, representative, unusual, suggesting."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions.text import is_suggestion, strip, word_tokens
from ..session import cut_lineage
from .ngrams import gram_keys
from .ordering import top_per_group

MIN_DF, MAX_DF, FEW_DOCS = 2, 0.85, 3
# Most comments whose norms are broadcast, a number each; those of more are shuffled with the terms.
MAX_BROADCAST_NORMS = 5_000_000
TASK_CHARS = 16_000_000  # characters of text whose terms one task sorts
TF = 1 << 33  # a term's count in a comment and the size of its group travel as one number


def lead_summary(
    docs: DataFrame, *, group: str, max_comments: int | None = None, longer_than: int = 20, top_k: int = 5,
    text: str = "description", id: str = "id",
) -> DataFrame:
    """(grp, summary): the first comments of each group as one bulleted text. The
    reference form looks at the first 50 (``max_comments``)."""
    stripped = docs.select(F.col(group).alias("grp"), F.col(id).alias("id"), strip(F.col(text)).alias("text"))
    leading = top_per_group(
        stripped.filter(F.length("text") > longer_than), ["grp"], ["id"], min(top_k, max_comments or top_k)
    )
    lines = leading.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("rank", "text"))).alias("lines"))
    joined = F.array_join(F.transform("lines", lambda r: r["text"]), "\n- ")
    return (
        stripped.select("grp").distinct().join(lines, "grp", "left")
        .select("grp", F.concat(F.lit("\n- "), F.coalesce(joined, F.lit(""))).alias("summary"))
    )


def _small(groups: Sequence[str] | None) -> Callable[[DataFrame], DataFrame]:
    """Broadcast of a table with a few rows per group, if the caller names the groups. The values of a
    column may be many: then the choice is the optimiser's, from measured sizes."""
    return F.broadcast if groups is not None else lambda rows: rows


def _stripped(docs: DataFrame, group: str, groups: Sequence[str] | None, text: str, id: str) -> DataFrame:
    """(grp, id, text) of the comments of the groups."""
    listed = F.col(group).isin(list(groups)) if groups is not None else F.col(group).isNotNull()
    return docs.filter(listed).select(F.col(group).alias("grp"), F.col(id).alias("id"), strip(F.col(text)).alias("text"))


def _texts(
    docs: DataFrame, group: str, groups: Sequence[str] | None, min_len: int, max_comments: int | None, text: str, id: str
) -> DataFrame:
    """(grp, id, text) of the comments that are compared."""
    texts = _stripped(docs, group, groups, text, id).filter(F.length("text") >= min_len)
    return texts if max_comments is None else top_per_group(texts, ["grp"], ["id"], max_comments, "_r").drop("_r")


def _row() -> Column:
    """Tells the comments of a group apart, also those without an id."""
    return F.xxhash64("id", "text").alias("row")


def _products(texts: DataFrame, doc: Column, parts: int, tasks: int, stopwords: Sequence[str], one_row: bool, few: bool) -> DataFrame:
    """(doc, product): for each comment with kept terms the product of its weights with the sum of the weights of its group.

    Each (comment, term) pair is shuffled once, as numbers, to the partition of its term, and read from there twice: for the norms, and
    with them for the sums of a term and its share in the products. Both are added up per comment before they are shuffled, in few
    tasks that take the partitions one after the other, so that there is a row per comment and task and not one per pair.
    """
    terms = F.inline(gram_keys(word_tokens(F.col("text"), stopwords), (1, 2), F.col("grp")))
    pairs = texts.select(doc.alias("doc"), "docs", terms)
    placed = pairs.select("key", "doc", (F.col("tf") * F.lit(TF) + F.col("docs")).alias("_what")).repartition(parts, "key")
    if not one_row:
        placed = placed.groupBy("key", "doc", F.pmod("_what", F.lit(TF)).alias("docs")).agg(F.sum(F.floor(F.col("_what") / TF)).alias("tf"))
        placed = placed.select("key", "doc", (F.col("tf") * F.lit(TF) + F.col("docs")).alias("_what"))
    term = Window.partitionBy("key")
    docs = F.pmod("_what", F.lit(TF))
    max_df = F.when(F.floor(docs * MAX_DF) < MIN_DF, 1.0).otherwise(MAX_DF)
    counted = placed.withColumn("df", F.count(F.lit(1)).over(term))
    kept = counted.filter((F.col("df") >= MIN_DF) & (F.col("df") <= max_df * docs) & (docs >= FEW_DOCS))
    w = F.shiftrightunsigned("_what", 33) * (F.log((1 + docs) / (1 + F.col("df"))) + 1)
    weights = kept.select("key", "doc", w.alias("w"))
    norms = weights.coalesce(tasks).groupBy("doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # A left join asks nothing of the pairs that the norms did not, so their shuffle is one and the same.
    normed = weights.join(F.broadcast(norms) if few else norms, "doc", "left").select("key", "doc", (F.col("w") / F.col("norm")).alias("w"))
    shares = normed.select("doc", (F.col("w") * F.sum("w").over(term)).alias("share"))
    return shares.coalesce(tasks).groupBy("doc").agg(F.sum("share").alias("product"))


def _scores(texts: DataFrame, groups: Sequence[str] | None, stopwords: Sequence[str], asking: bool = False) -> DataFrame:
    """(grp, id, row, docs, score, chars, asks) of the comments, without their texts, which are most of the data.

    Texts are prepared twice: for their facts, which are written, and to be cut into terms. Group sizes are written too, so that
    their measured size decides whether they are broadcast, and the texts of a few large groups do not meet in as few tasks.
    """
    small = _small(groups)
    asks = is_suggestion(F.col("text")) if asking else F.lit(None).cast("boolean")
    noted = cut_lineage(texts.select("grp", "id", _row(), F.length("text").alias("chars"), asks.alias("asks")))
    each = noted.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    total = each.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("chars").alias("chars")).first()
    one_row = (total["most"] or 0) <= 1
    # An id that is given twice stands for one comment in a group and for several in several groups.
    doc = F.col("id") if one_row else F.when(F.col("id").isNotNull(), F.xxhash64("grp", "id"))
    sizes = cut_lineage(noted.groupBy("grp").agg(F.count(F.lit(1)).alias("docs")))
    sized = texts.join(small(sizes), "grp")

    tasks = max(24, 3 * texts.sparkSession.sparkContext.defaultParallelism)
    parts = max(tasks, -(-(total["chars"] or 0) // TASK_CHARS))
    few_norms = (total["n"] or 0) <= MAX_BROADCAST_NORMS
    products = cut_lineage(_products(sized, doc, parts, tasks, stopwords, one_row, few_norms))
    facts = noted.join(small(sizes), "grp").select("grp", "id", doc.alias("doc"), "docs", "row", "chars", "asks")
    scored = cut_lineage(facts.join(products, "doc", "left").drop("doc"))
    # The products of a group add up to the square of the length of its sum: each comment of an id counts once.
    once = scored.filter(F.col("product").isNotNull())
    if not one_row:
        once = once.groupBy("grp", "id").agg(F.first("product").alias("product"))
    lengths = once.groupBy("grp").agg(F.sqrt(F.sum("product")).alias("centre_length"))
    few = F.col("docs") < FEW_DOCS
    cosine = F.round(F.coalesce(F.col("product"), F.lit(0.0)) / F.col("centre_length"), 6)
    return (
        scored.join(small(lengths), "grp", "left")
        .filter(few | F.col("centre_length").isNotNull())
        .select("grp", "id", "row", "docs", F.when(~few, cosine).alias("score"), "chars", "asks")
    )


def _spelled(picked: DataFrame, texts: DataFrame) -> DataFrame:
    """``picked``, a few rows per group, with their texts. ``texts`` may hold more than those compared: a row's hash is of its text."""
    picked = cut_lineage(picked)
    named = picked.select(F.col("id").alias("_id")).distinct()
    near = texts.join(named, F.col("id").eqNullSafe(F.col("_id")), "left_semi")  # before the other texts are prepared
    rows = near.select("grp", _row(), "text").join(picked.select("grp", "row").distinct(), ["grp", "row"], "left_semi")
    return picked.join(rows.dropDuplicates(["grp", "row"]), ["grp", "row"])


def centrality(
    docs: DataFrame, *, group: str, groups: Sequence[str] | None = None, min_len: int = 20,
    max_comments: int | None = None, stopwords: Sequence[str] = lx.LIGHT_STOPWORDS,
    text: str = "description", id: str = "id",
) -> DataFrame:
    """(grp, id, text, docs, score): cosine of each comment with the mean of its group.

    Weights are TF-IDF over words and word pairs. ``score`` is null in groups of fewer
    than three comments; a group in which no term is kept has no rows. ``groups`` names the
    groups to look at (default: all values of the column but null, however many). The
    reference form looks at the first 200 comments of a group (``max_comments``).
    """
    texts = _texts(docs, group, groups, min_len, max_comments, text, id)
    scored = _scores(texts, groups, stopwords).select("grp", "row", "docs", "score").distinct()
    return texts.withColumn("row", _row()).join(scored, ["grp", "row"]).select("grp", "id", "text", "docs", "score")


def _scored(
    docs: DataFrame, *, group: str, groups: Sequence[str] | None = None, min_len: int = 20, max_comments: int | None = None,
    stopwords: Sequence[str] = lx.LIGHT_STOPWORDS, text: str = "description", id: str = "id", asking: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The comments of the groups, and the scores of those that are compared."""
    texts = _texts(docs, group, groups, min_len, max_comments, text, id)
    return _stripped(docs, group, groups, text, id), _scores(texts, groups, stopwords, asking)


def _core(scored: DataFrame, top_k: int) -> DataFrame:
    """Highest scores; in a group with too few comments the longest."""
    return top_per_group(scored, ["grp"], [F.desc_nulls_last("score"), F.desc(F.when(F.col("score").isNull(), F.col("chars"))), F.asc("id")], top_k)


def representative(docs: DataFrame, *, group: str, top_k: int = 7, max_comments: int | None = None, **options) -> DataFrame:
    """(grp, rank, id, text, score): the comments closest to the mean of their group."""
    texts, scored = _scored(docs, group=group, max_comments=max_comments, **options)
    return _spelled(_core(scored, top_k), texts).select("grp", "rank", "id", "text", "score")


def buckets(
    docs: DataFrame, *, group: str, core: int = 7, outliers: int = 3, suggestions: int = 5,
    max_comments: int | None = None, **options,
) -> DataFrame:
    """(grp, bucket, rank, id, text, score) with buckets core, outliers, suggestions.

    Outliers leave out texts of the core; suggestions are the first in input order,
    and those whose text is already used are then removed. The reference form looks at
    the first 400 comments of a group.
    """
    texts, scored = _scored(docs, group=group, max_comments=max_comments, asking=True, **options)
    small = _small(options.get("groups"))
    lowest = top_per_group(scored.filter(F.col("score").isNotNull()), ["grp"], [F.asc("score"), F.asc("id")], outliers)
    asking = top_per_group(scored.filter("asks"), ["grp"], ["id"], suggestions)
    sets = {"core": _core(scored, core), "outliers": lowest, "suggestions": asking}
    # Each picked set has at most k rows per group.
    picked = cut_lineage(_spelled(reduce(DataFrame.unionByName, [rows.withColumn("bucket", F.lit(name)) for name, rows in sets.items()]), texts))
    top, lowest, asking = [picked.filter(F.col("bucket") == name) for name in sets]
    core_texts = small(top.select("grp", "text").distinct())
    odd = lowest.join(core_texts, ["grp", "text"], "left_anti")
    compared = top.filter(F.col("score").isNotNull())  # small groups keep every suggestion
    used = small(compared.select("grp", "text").unionByName(odd.select("grp", "text")).distinct())
    asking = asking.join(used, ["grp", "text"], "left_anti")

    def renumbered(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy("rank")))

    picked = top.unionByName(renumbered(odd)).unionByName(renumbered(asking))
    return picked.select("grp", "bucket", "rank", "id", "text", "score")
