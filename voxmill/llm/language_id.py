"""Language identification by rank order of character n-grams (out-of-place distance).

Profiles: the ``profile`` most frequent n-grams (1 to 3 characters of words, with a blank on
either side) of each language, by rank. A document's own most frequent n-grams are ranked the
same way; its distance to a language is the sum, over its n-grams, of how far each is
from its place in the profile. N-grams are packed exactly into 63 bits, 21 per character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, exactly, place_of

UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray | None:
    """All 1- to 3-grams of the words of a text, with repeats; None if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    # Runs of other characters become one blank; a blank at either end.
    codes = np.concatenate(([32], np.where(letter, codes, 32), [32])).astype(np.int64)
    blank = codes == 32
    codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
    blank = codes == 32
    two = codes[:-1] << 21 | codes[1:]
    three = two[:-1] << 21 | codes[2:]
    # A blank inside a gram would join two words; blanks at its ends mark word starts and ends.
    return np.concatenate((codes[~blank], two, three[~blank[1:-1]]))


def ranked(counts_of: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` most frequent grams, by falling count, ties by code."""
    if len(counts) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        keep = counts >= least
        counts_of, counts = counts_of[keep], counts[keep]
    return counts_of[np.lexsort((counts_of, -counts))][:most]


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents that are not learnt from: crc32 of the id as text, mod 4, is 2."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_profiles(docs: DataFrame, profile: int = 400, fit_docs: int = 20_000) -> list[tuple[str, list[int]]]:
    """(language, its grams by rank) of each value of ``lang``, at most ``profile`` grams each.

    Fitted on about ``fit_docs`` documents per language (all, where there are fewer), chosen by
    a hash of the id. The result is bounded by ``profile`` per language.
    """
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), "doc_id")
    per_lang = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    share = F.xxhash64("doc_id", F.lit("fit")).bitwiseAND(F.lit(0xFFFFFF)) / float(1 << 24)
    chosen = labelled.join(F.broadcast(per_lang), "lang").filter(share * F.col("docs") < fit_docs).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for big in batches for b in batches_of([big], 4_000_000)):
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                if text.is_valid and (g := grams(text.as_py())) is not None:
                    found.setdefault(lang, []).append(g)
            for lang, parts in found.items():
                code, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    totals = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = totals.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= profile)
    rows = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "gram"))).alias("grams")).orderBy("lang").collect()
    return [(r.lang, [g.gram for g in r.grams]) for r in rows]


class Profiles:
    """Distances of a document to all profiles at once."""

    def __init__(self, profiles: list[tuple[str, list[int]]], most: int):
        self.langs, self.most = [lang for lang, _ in profiles], most
        self.grams = np.unique(np.array([g for _, gs in profiles for g in gs], np.int64))
        # Place of each known gram in each profile; ``most`` where it has none.
        self.place = np.full((len(self.grams) + 1, len(profiles)), most, np.int64)
        for j, (_, gs) in enumerate(profiles):
            self.place[np.searchsorted(self.grams, np.array(gs, np.int64)), j] = np.arange(len(gs))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = grams(text) if text is not None else None
        if found is None or not self.langs:
            return UNKNOWN, 0.0
        code, n = np.unique(found, return_counts=True)
        mine = ranked(code, n, self.most)
        at = np.minimum(np.searchsorted(self.grams, mine), len(self.grams) - 1)
        at = np.where(self.grams[at] == mine, at, len(self.grams))
        off = np.minimum(np.abs(self.place[at] - np.arange(len(mine))[:, None]), self.most)
        off[at == len(self.grams)] = self.most
        off = np.where(self.place[at] == self.most, self.most, off)
        distance = off.mean(axis=0) / self.most
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best])


def identify(docs: DataFrame, profile: int = 400, fit_docs: int = 20_000) -> DataFrame:
    """All columns of ``docs``, and lang_pred, lang_score; see ``predict_language``."""
    profiles = docs.sparkSession.sparkContext.broadcast(learn_profiles(exactly(docs, "doc_id", "text", "lang"), profile, fit_docs))  # <= profile grams per language

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles.value, profile)
        for batch in (b for whole in batches for b in batches_of([whole], 2_000_000)):
            found = [model.predict(t.as_py()) for t in batch.column(text_at)]
            kept = [batch.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())], names)

    # Columns travel under names of their own, since those of ``docs`` may clash, differ in case only or hold dots.
    width, text_at = len(docs.columns), place_of(docs, "text")
    names = [*[f"_carried_{i}" for i in range(width)], "lang_pred", "lang_score"]
    kinds = [*[f.dataType.simpleString() for f in docs.schema.fields], "string", "double"]
    kinds[text_at] = "string"
    flat = docs.toDF(*names[:width])
    carried = [F.col(n).cast(k).alias(n) for n, k in zip(names[:width], kinds, strict=False)]
    out = flat.select(*carried).mapInArrow(predict, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    return out.select(*[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(docs.columns)], "lang_pred", "lang_score")


def predict_language(docs: DataFrame, profile: int = 400, fit_docs: int = 20_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``.

    ``docs`` needs doc_id, text and lang; other columns are ignored, whatever their names. The
    whole text decides, nothing else. ``lang_pred`` is a learnt value of ``lang`` (the first by name on a tie), or ``und`` with
    score 0 if the text is null or has no letter, or if no language could be learnt.
    ``score`` is 1 less the mean distance as a share of the largest. ``fit_docs`` bounds the
    sample per language that profiles are fitted on. An empty table gives no rows.
    """
    needed = exactly(docs, "doc_id", "text", "lang")
    return identify(needed, profile, fit_docs).select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
