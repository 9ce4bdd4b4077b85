"""Quality rules and character n-gram perplexity with bands per language.

Texts are sequences of symbols (lower case, digits as one, runs of white space as one). Every task counts its n-grams,
Spark sums them per language, and a modified Kneser-Ney model is computed from the sums with joins
and aggregates: the highest order by counts, lower ones by the number of different left neighbours, three discounts per order
and language. N-grams are packed into whole numbers, 12 bits per symbol (rare symbols share codes).

The model is kept as sorted arrays of n-gram codes with log probabilities and looked up by binary search. While it
is small (``max_entries``) every task gets it; beyond that, the n-grams of documents are joined with it. Every n-gram that is looked
up has been counted. A language's band of log perplexity ends at Tukey's fences: one and a half quartile ranges beyond the quartiles,
in which every source weighs the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, exactly, has_column, whole_text, written
from .shingles import STEP, _SPACE, buffers, mix, words

ORDER = 5
BITS = 12
UNKNOWN = "und"
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_EDGE = " \t\n\x0b\x0c\r"


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Code of each code point: itself if small, digits as 0, the others in 1024 shared codes."""
    table = np.arange(0x110000)
    table = np.where(table < 3072, table, 3072 + table % 1024)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isspace():
            table[c] = 32
        elif ch.isdigit():
            table[c] = 48
    return table


def ngram_codes(text: str) -> np.ndarray:
    """The n-gram that ends at each symbol; zeros stand before the first."""
    symbols = _symbols()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    if len(symbols) > 1:
        blank = symbols == 32
        symbols = symbols[~(blank & np.concatenate(([False], blank[:-1])))]
    padded = np.concatenate((np.zeros(ORDER - 1, np.int64), symbols))
    out = np.zeros(len(symbols), np.int64)
    for i in range(ORDER):
        out = out << BITS | padded[i : i + len(symbols)]
    return out


def ngram_counts(texts: DataFrame) -> DataFrame:
    """lang, code, c: how often each n-gram occurs in the whole ``_text`` of all rows of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            code, n = np.concatenate([c for c, _ in parts]), np.concatenate([k for _, k in parts])
            order = np.argsort(code)
            code = code[order]
            begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            return code[begin], np.add.reduceat(n[order], begin)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                code, n = merged(parts)
                for i in range(0, len(code), 100_000):
                    part = code[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(n[i : i + 100_000])], ["lang", "code", "c"])
            held.clear()

        for batch in (b for whole in batches for b in batches_of([whole], 2_000_000)):
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("_text"), strict=True):
                found.setdefault(lang, []).append(ngram_codes(text.as_py()))
            for lang, parts in found.items():
                code = np.sort(np.concatenate(parts))
                if not len(code):
                    continue
                begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
                parts = held.setdefault(lang, [])
                parts.append((code[begin], np.diff(begin, append=len(code)).astype(np.int64)))
                if len(parts) > 16:
                    held[lang] = [merged(parts)]
            size = sum(len(c) for parts in held.values() for c, _ in parts)
            if size > 4_000_000:
                yield from rows()
        yield from rows()

    return texts.mapInArrow(count, "lang string, code long, c long").groupBy("lang", "code").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> DataFrame:
    """d1, d2, d3 of each language from its counts of counts."""
    n = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    raw = [k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
    # Where a count of counts is zero or the estimate leaves (0, k), the usual 1/2, 1 and 3/2.
    usable = [F.when((r > 0) & (r < k), r).otherwise(F.lit(k / 2)) for k, r in zip((1, 2, 3), raw, strict=True)]
    return counts.groupBy("lang").agg(*n).select("lang", *[u.alias(f"d{k}") for k, u in zip((1, 2, 3), usable, strict=True)])


def kneser_ney(counts: DataFrame) -> DataFrame:
    """lang, code, logp: log probability of the last symbol of each counted n-gram after the others."""
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        longer = orders[k + 1].withColumn("code", F.col("code").bitwiseAND(F.lit((1 << BITS * k) - 1)))
        orders[k] = longer.groupBy("lang", "code").agg(F.count(F.lit(1)).alias("c"))
    lower: DataFrame | None = None
    for k in range(1, ORDER + 1):
        c = F.col("c")
        known = orders[k].join(F.broadcast(_discounts(orders[k])), "lang")  # one row per language
        discount = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        known = known.select("lang", "code", F.shiftright("code", BITS).alias("context"), "c", discount.alias("d"))
        contexts = known.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("left"), F.count(F.lit(1)).alias("kinds"))
        joined = known.join(contexts, ["lang", "context"])
        if lower is None:
            base = 1.0 / (F.col("kinds") + 1)
        else:
            joined = joined.withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1))).join(
                lower.select("lang", F.col("code").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"]
            )
            base = F.col("below")
        lower = joined.select("lang", "code", (((c - F.col("d")) + F.col("left") * base) / F.col("total")).alias("p"))
    return lower.select("lang", "code", F.log("p").alias("logp"))


class SortedArrays:
    """N-gram codes of each language in order, and their log probabilities."""

    def __init__(self, rows: list):
        langs = sorted({r.lang for r in rows})
        self.codes, self.logp = {}, {}
        for lang in langs:
            code = np.concatenate([np.frombuffer(r.codes, np.int64) for r in rows if r.lang == lang])
            logp = np.concatenate([np.frombuffer(r.logps, np.float32) for r in rows if r.lang == lang])
            order = np.argsort(code)
            self.codes[lang], self.logp[lang] = code[order], logp[order]

    def total(self, lang: str, codes: np.ndarray) -> float:
        at = np.searchsorted(self.codes[lang], codes)
        return float(self.logp[lang][at].sum(dtype=np.float64))


def _collect_arrays(model: DataFrame) -> SortedArrays:
    """The bounded model as arrays; blocks of rows are packed by tasks."""

    def blocks(table: pa.Table) -> pa.Table:
        return pa.table({"lang": [table.column("lang")[0].as_py()], "codes": [table.column("code").to_numpy().tobytes()], "logps": [table.column("logp").to_numpy().astype(np.float32).tobytes()]})

    packed = model.withColumn("_part", F.pmod("code", F.lit(16))).groupBy("lang", "_part").applyInArrow(blocks, "lang string, codes binary, logps binary")
    return SortedArrays(packed.collect())


def base_counts(texts: pa.Array) -> list[np.ndarray | list]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    data, ends = buffers(texts)
    strings = texts.to_pylist()
    space = np.concatenate(([0], np.cumsum(_SPACE[data]))) if len(data) else np.zeros(1, np.int64)
    symbol = np.concatenate(([0], np.cumsum(_SYMBOL[data]))) if len(data) else np.zeros(1, np.int64)
    word, text = words(data, ends, lower=False)
    n_words = np.bincount(text, minlength=len(strings))
    begin = np.cumsum(n_words) - n_words
    window = mix((word[:-2] * STEP + word[1:-1]) * STEP + word[2:]) if len(word) > 2 else word[:0]
    repeats, lines = [], []
    for s, b, n in zip(strings, begin.tolist(), n_words.tolist(), strict=True):
        covered = 0
        if n > 3:
            mine = window[b : b + n - 2]
            order = np.argsort(mine, kind="stable")
            same = mine[order[1:]] == mine[order[:-1]]
            twice = np.zeros(n - 2, bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            if twice.any():
                cover = np.zeros(n, bool)
                for j in range(3):
                    cover[j : j + n - 2] |= twice
                covered = int(cover.sum())
        repeats.append(covered)
        with_word = [line for line in s.split("\n") if line.strip(_EDGE)] if "\n" in s else []
        lines.append(len(with_word) - len(set(with_word)))
    chars = np.array([len(s) for s in strings], np.int64) - np.diff(space[ends])
    return [n_words.astype(np.int64), chars, np.diff(symbol[ends]).astype(np.int64), lines, repeats]


def _lang(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(UNKNOWN))


def bands(scored: DataFrame, fence: float, least_spread: float) -> DataFrame:
    """lang, lower, upper: ``fence`` times the quartile range (twice ``least_spread`` at least) beyond the quartiles of ``log_perplexity``.

    ``scored``: lang, source, log_perplexity. The documents of a source share one weight, so that a large source does not set the
    quartiles of its language. Values are counted in steps of 1/10,000, so what is summed up in order does not grow with the rows.
    """
    known = scored.filter("log_perplexity is not null").groupBy("lang", "source", F.round("log_perplexity", 4).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    sizes = known.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    steps = (
        known.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
        .join(sizes, (F.col("_lang") == F.col("lang")) & F.col("_source").eqNullSafe(F.col("source")))
        .groupBy("lang", "value").agg(F.sum(F.col("n") / F.col("size")).alias("weight"))
    )
    whole = Window.partitionBy("lang")
    reached = F.sum("weight").over(whole.orderBy("value")) / F.sum("weight").over(whole)
    # Sums of fractions differ in the last digits from run to run.
    at = lambda part: F.min(F.when(F.col("reached") >= part - 1e-9, F.col("value")))
    quartiles = steps.withColumn("reached", reached).groupBy("lang").agg(at(0.25).alias("low"), at(0.75).alias("high"))
    beyond = fence * F.greatest(F.col("high") - F.col("low"), F.lit(2 * least_spread))
    return quartiles.select("lang", (F.col("low") - beyond).alias("lower"), (F.col("high") + beyond).alias("upper"))


def score_quality(
    docs: DataFrame, min_words: int = 50, max_repeated: int = 50, fence: float = 1.5, least_spread: float = 0.01, max_entries: int = 4_000_000
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_perplexity: one row per row of ``docs``.

    ``docs`` needs doc_id, text and lang, and may have source (without it all documents are of one); other columns are ignored, whatever
    their names. Null texts are empty. A null ``lang`` is a language of its own, a null ``source`` a source. ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeated`` percent of the words in repeated 3-word windows.
    ``kept``: not failed, and the mean log perplexity per symbol lies in the band of the language: from ``fence`` times the quartile range below the lower
    quartile to as much above the upper one. Quartiles are of its documents that did not fail, every source weighing the same; their range counts as
    twice ``least_spread`` at least. Repeated rows and ids give a row each. An empty table gives no rows. The model counts all documents; ``max_entries`` changes the plan only.
    """
    named = has_column(docs, "source")
    docs = exactly(docs, "doc_id", "text", "lang", *(["source"] if named else []))
    source = F.col("source").cast("string") if named else F.lit(None).cast("string")
    texts = docs.select("doc_id", _lang(F.col("lang")).alias("lang"), source.alias("source"), whole_text().alias("_text"))
    model = written(kneser_ney(written(ngram_counts(texts.select("lang", "_text")))))
    small = model.count() <= max_entries
    arrays = docs.sparkSession.sparkContext.broadcast(_collect_arrays(model)) if small else None
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = "source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, symbols long, total double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in batches_of([whole], 1_000_000)):
            base = base_counts(batch.column("_text"))
            n, total = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("_text"), strict=True):
                codes = ngram_codes(text.as_py())
                n.append(len(codes))
                total.append(arrays.value.total(lang, codes) if arrays and len(codes) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), batch.column("source"), *[pa.array(b, pa.int64()) for b in base], pa.array(n, pa.int64()), pa.array(total, pa.float64())],
                ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "symbols", "total"],
            )

    if small:
        scored = written(texts.mapInArrow(score, f"doc_id {kind}, lang string, {fields}"))
    else:
        keyed = written(texts).withColumn("_row", F.monotonically_increasing_id())  # of written files: the same in both branches

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b for whole in batches for b in batches_of([whole], 1_000_000)):
                for row, lang, text in zip(batch.column("_row").to_pylist(), batch.column("lang").to_pylist(), batch.column("_text"), strict=True):
                    code, n = np.unique(ngram_codes(text.as_py()), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([row] * len(code), pa.int64()), pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n.astype(np.int64))], ["_row", "lang", "code", "n"])

        totals = (
            keyed.select("_row", "lang", "_text").mapInArrow(listed, "_row long, lang string, code long, n long")
            .join(model, ["lang", "code"]).groupBy("_row").agg(F.sum(F.col("n") * F.col("logp").cast("float").cast("double")).alias("joined"))
        )
        numbered = keyed.select(F.struct("doc_id", "_row").alias("doc_id"), "lang", "source", "_text").mapInArrow(score, f"doc_id struct<doc_id:{kind},_row:long>, lang string, {fields}")
        scored = written(
            numbered.join(totals, F.col("doc_id._row") == totals["_row"], "left")
            .withColumn("total", F.coalesce("joined", F.lit(0.0))).withColumn("doc_id", F.col("doc_id.doc_id")).drop("_row", "joined")
        )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed).withColumn("log_perplexity", F.when(F.col("symbols") > 0, -F.col("total") / F.col("symbols")))
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    found = F.broadcast(bands(scored.filter("not base_failed"), fence, least_spread))  # one row per language
    return scored.join(found, "lang", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), "log_perplexity",
    )
