"""Registered queries of the numbered operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from . import checks
from .chat_format import format_turns, read_back
from .decontamination import contamination, find_passages
from .language_id import predict_language
from .lexical_search import search
from .main_text import extract_main_text
from .mixing import mix
from .ngram_join import ngram_components
from .packing import pack
from .perplexity import score_quality
from .pivot_dedup import near_duplicates
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .vector_codes import codebooks_digest, compress, with_label_errors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", limit=1024)


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json", window=2048, end_id=1)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to"
    )


@query("op10_source_mix")
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_ratio=3)


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))


@query("op2_suffix_dedup", checks.REPEATS)
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, span=50).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_ngram_join", checks.NGRAM_JOIN)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), words=4, percent=85)


@query("op4_pivot_dedup", checks.PIVOTS)
def op4_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


@query("op9_chat_format", checks.CHAT)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return read_back(format_turns(turns.unionByName(more)))


@query("op5_main_text")
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query("op7_perplexity_rules")
def op7_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"))


@query("op11_lexical_search", checks.SEARCH)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query("op12_decontamination", checks.PASSAGES)
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


@query("op13_vector_codes", checks.CODES)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
