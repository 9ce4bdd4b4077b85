"""Normalisation, tokens, n-grams and exemplary comments over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..functions.rules import sentiment_group
from ..operators import exemplars, ngrams
from ..operators.reports import stack_reports
from ..session import cut_lineage
from ..sources.files import load_stopwords
from . import sqltext as sq
from .registry import query
from .scratch import scratch_folder
from .views import comments, texts, with_views

STOP = lx.LIGHT_STOPWORDS
KEEP = ["(", ")", "؟", "-"]
PHRASES = ["از می", "ها", "یس"]
BEFORE = ["ها", "از"]

# --- one query per normalisation step: key -> (column function, SQL) ------------------------------
PADDED = lambda c: F.concat(F.lit("　\t\x85 "), c, F.lit("\n  \x1f"))
SQL_PADDED = "chr(12288) || chr(9) || chr(133) || ' ' || description || chr(10) || chr(160) || ' ' || chr(31)"
STEPS = {
    "norm_1_strip": (lambda c: tx.strip(PADDED(c)), sq.strip(f"({SQL_PADDED})")),
    "norm_2_drop_short_sentences": (lambda c: tx.drop_short_sentences(c, 4), sq.drop_short_sentences("description", 4)),
    "norm_3_ascii_digits": (tx.persian_digits_to_ascii, sq.fa_digits("description")),
    "norm_4_persian_digits": (tx.ascii_digits_to_persian, sq.en_digits("description")),
    "norm_5_persian_letters": (tx.arabic_to_persian, sq.ar_letters("description")),
    "norm_6_diacritics": (tx.drop_diacritics, sq.diacritics("description")),
    "norm_7_half_space": (tx.drop_half_space, sq.half_space("description")),
    "norm_8_long_runs": (
        lambda c: tx.shorten_runs(F.regexp_replace(c, "[اس]", "یی")),
        sq.long_runs(sq.rx("description", "[اس]", "یی")),
    ),
    "norm_9_number": (tx.drop_number_start, sq.number_start("description")),
    "norm_11_punctuation": (tx.punctuation_to_space, sq.punctuation("description")),
    "norm_12_punctuation_except": (lambda c: tx.punctuation_to_space_except(c, KEEP), sq.punctuation_except("description", KEEP)),
    "norm_13_spaces": (tx.collapse_double_spaces, sq.double_spaces("description")),
    "norm_14_mi_prefix": (tx.join_mi_prefix, sq.mi_prefix("description")),
    "norm_15_phrases": (lambda c: tx.drop_phrases(c, PHRASES), sq.phrases("description", PHRASES)),
    "norm_16_pad_punctuation": (tx.pad_punctuation, sq.pad("description")),
    "norm_17_no_space_after": (lambda c: tx.no_space_after(c, BEFORE), sq.tight_after("description", BEFORE)),
    "norm_18_half_space_before": (lambda c: tx.half_space_before(c, BEFORE), sq.half_before("description", BEFORE)),
    "norm_19_ha_suffix": (tx.drop_plural_suffix, sq.plural("description")),
    "norm_20_line_breaks": (tx.line_breaks_to_space, sq.line_breaks("description")),
    "norm_21_first_digit": (tx.first_digit_of_number, sq.first_digit("description")),
    "normalize_for_match": (tx.normalize_for_match, sq.match_form("description")),
    "normalize_report": (tx.normalize_for_report, sq.report_form("description")),
    "normalize_text": (
        lambda c: tx.normalize_text(
            c, min_sentence_words=3, ascii_digits=True, persian_letters=True, without_diacritics=True,
            without_half_space=True, short_runs=True, rating_words=True, without_number_start=True,
            persian_digits=True, keep_punctuation=KEEP, single_spaces=True, mi_prefix=True,
            without_phrases=PHRASES, padded_punctuation=True, tight_after=["دا"], half_space_before_words=BEFORE,
            single_line=True,
        ),
        None,
    ),
    "remove_stopwords": (
        lambda c: tx.remove_stopwords(c, STOP),
        f"array_to_string(list_filter({sq.words('description')}, lambda w: w NOT IN {sq.in_list(STOP)}), ' ')",
    ),
}


def _full_chain() -> str:
    """All steps in order, as nested SQL."""
    s = sq.drop_short_sentences(sq.strip("description"), 3)
    s = sq.half_space(sq.diacritics(sq.ar_letters(sq.fa_digits(s))))
    s = sq.long_runs(s)
    return f"""SELECT id, {sq.line_breaks(sq.plural(sq.half_before(sq.tight_after(sq.pad(sq.phrases(sq.mi_prefix(
        sq.double_spaces(sq.punctuation_except(sq.en_digits(sq.number_start(sq.rating_word('s'))), KEEP))), PHRASES)), ['دا']), BEFORE)))}
        AS normal FROM (SELECT id, {s} AS s FROM texts_v)"""


def _register_step(name, step, sql):
    body = _full_chain() if sql is None else f"SELECT id, {sql} AS normal FROM texts_v"

    @query(name, with_views(body, "texts_v"))
    def build(spark, sf_dir):
        return texts(spark, sf_dir).select("id", step(F.col("description")).alias("normal"))


for _name, (_step, _sql) in STEPS.items():
    _register_step(_name, _step, _sql)


@query("norm_10_rating_word", with_views(
    f"SELECT id, {sq.rating_word('t')} AS normal FROM (SELECT id, CAST(k % 8 AS VARCHAR) AS t FROM comments_v)", "comments_v"))
def norm_rating_word(spark, sf_dir):
    text = (F.col("k") % 8).cast("string")
    return comments(spark, sf_dir).select("id", tx.rating_digit_to_word(text).alias("normal"))


# --- predicates ----------------------------------------------------------------------------------------
@query("is_persian", with_views(
    "SELECT id, regexp_matches(description, '[\\x{600}-\\x{6FF}]') AS persian, regexp_matches(latin, '[\\x{600}-\\x{6FF}]') AS latin_persian FROM texts_v", "texts_v"))
def q_is_persian(spark, sf_dir):
    return texts(spark, sf_dir).select("id", tx.is_persian(F.col("description")).alias("persian"), tx.is_persian(F.col("latin")).alias("latin_persian"))


@query("contains_latin", with_views(
    f"SELECT id, {sq.latin('description')} AS latin, {sq.latin('title')} AS title_latin FROM texts_v", "texts_v"))
def q_contains_latin(spark, sf_dir):
    return texts(spark, sf_dir).select("id", tx.contains_latin(F.col("description")).alias("latin"), tx.contains_latin(F.col("title")).alias("title_latin"))


@query("is_suggestion", with_views(
    f"SELECT id, {sq.suggestion('description')} AS suggestion FROM comments_v", "comments_v"))
def q_is_suggestion(spark, sf_dir):
    return comments(spark, sf_dir).select("id", tx.is_suggestion(F.col("description")).alias("suggestion"))


# --- tokens ---------------------------------------------------------------------------------------------
@query("tokenize", with_views(
    f"SELECT id, array_to_string({sq.tokens('description', STOP)}, ' ') AS tokens FROM texts_v", "texts_v"))
def q_tokenize(spark, sf_dir):
    return texts(spark, sf_dir).select("id", F.array_join(tx.tokenize(F.col("description"), stopwords=STOP), " ").alias("tokens"))


@query("tokenize_letters", with_views(
    f"SELECT id, array_to_string({sq.tokens('latin', ['the', 'of'], '[' + chr(92) + 'p{L}]+')}, ' ') AS tokens FROM texts_v", "texts_v"))
def q_tokenize_letters(spark, sf_dir):
    tokens = tx.tokenize(F.col("latin"), lx.LETTER_TOKEN, ["the", "of"])
    return texts(spark, sf_dir).select("id", F.array_join(tokens, " ").alias("tokens"))


@query("ngram_text", with_views(
    f", w AS (SELECT id, {sq.words('description')} AS w FROM texts_v) "
    f"SELECT id, array_to_string({sq.grams('w', 2, '_')}, ' ') AS bigrams, array_to_string({sq.grams('w', 3, '_')}, ' ') AS trigrams FROM w", "texts_v"))
def q_ngram_text(spark, sf_dir):
    d = F.col("description")
    return texts(spark, sf_dir).select("id", tx.ngram_text(d, 2).alias("bigrams"), tx.ngram_text(d, 3).alias("trigrams"))


@query("load_stopwords", with_views(
    f", w AS (SELECT DISTINCT unnest({sq.words('description')}) AS w FROM texts_v) "
    f"SELECT DISTINCT word FROM (SELECT {sq.strip(sq.rx('w', chr(91) + chr(39) + ',' + lx.ZWNJ + chr(93), ''))} AS word FROM w) WHERE word <> ''", "texts_v"))
def q_load_stopwords(spark, sf_dir):
    words = texts(spark, sf_dir).select(F.explode(tx.words(F.col("description"))).alias("w")).distinct()
    path = scratch_folder(spark)
    words.select(F.concat(F.lit(" '"), "w", F.lit("',"))).write.text(path)
    return load_stopwords(spark, path)


# --- frequencies ------------------------------------------------------------------------------------------
def _sql_top(n, limit, label):
    return with_views(
        f", t AS (SELECT {sq.word_tokens(sq.report_form('description'), STOP)} AS t FROM texts_v), "
        f"g AS (SELECT unnest({sq.grams('t', n)}) AS g FROM t) "
        f"SELECT g AS {label}, count(*) AS total FROM g GROUP BY g ORDER BY total DESC, g LIMIT {limit}", "texts_v")


def _report_texts(spark, sf_dir):
    return texts(spark, sf_dir).select("id", tx.normalize_for_report(F.col("description")).alias("description"))


@query("top_words", _sql_top(1, 20, "word"))
def q_top_words(spark, sf_dir):
    return ngrams.top_words(_report_texts(spark, sf_dir), limit=20, stopwords=STOP, id="id")


@query("top_ngrams", _sql_top(2, 30, "ngram"))
def q_top_bigrams(spark, sf_dir):
    return ngrams.top_ngrams(_report_texts(spark, sf_dir), n=2, limit=30, stopwords=STOP, id="id")


@query("top_trigrams", _sql_top(3, 30, "ngram"))
def q_top_trigrams(spark, sf_dir):
    return ngrams.top_ngrams(_report_texts(spark, sf_dir), n=3, limit=30, stopwords=STOP, id="id")


@query("union_ngrams", with_views(
    f", t AS (SELECT {sq.word_tokens('description')} AS t FROM texts_v), "
    f"g AS (SELECT 'bigram' AS type, unnest({sq.grams('t', 2)}) AS ngram FROM t UNION ALL SELECT 'trigram', unnest({sq.grams('t', 3)}) FROM t), "
    "c AS (SELECT type, ngram, count(*) AS total, row_number() OVER (PARTITION BY type ORDER BY count(*) DESC, ngram) AS r FROM g GROUP BY type, ngram) "
    "SELECT type, ngram, total FROM c WHERE r <= 20", "texts_v"))
def q_union_ngrams(spark, sf_dir):
    top = cut_lineage(ngrams.top_ngrams_of(texts(spark, sf_dir), ns=tuple(ngrams.KIND_OF_N), limit=20, id="id"))  # 40 rows
    return stack_reports({name: top.filter(F.col("n") == n).drop("n") for n, name in ngrams.KIND_OF_N.items()})


# --- TF-IDF --------------------------------------------------------------------------------------------------
def sql_tfidf(ns, top_k, *, grouped, select, min_df=3, max_df=0.6, max_features=None):
    grp = (grouped if isinstance(grouped, str) else "grp") if grouped else "'all' AS grp"
    cap = f"WHERE r <= {max_features}" if max_features else ""
    top_k = f"({top_k}) AND grp IN ('all', 'negative', 'neutral', 'positive')"
    per_n = " UNION ALL ".join(f"SELECT id, grp, {n} AS n, unnest({sq.grams('t', n)}) AS gram FROM tok" for n in ns)
    doubled = "SELECT * FROM g UNION ALL SELECT id, 'all', n, gram FROM g" if grouped else "SELECT * FROM g"
    docs = "SELECT grp, count(*) AS d FROM tok GROUP BY grp" + (" UNION ALL SELECT 'all', count(*) FROM tok" if grouped else "")
    return with_views(f""", tok AS (SELECT id, {grp}, {sq.tokens('description', STOP)} AS t FROM texts_v),
g AS ({per_n}), gg AS ({doubled}),
tf AS (SELECT grp, n, id, gram, count(*) AS tf FROM gg GROUP BY grp, n, id, gram),
docs AS ({docs}),
df AS (SELECT grp, n, gram, count(*) AS df, sum(tf) AS total FROM tf GROUP BY grp, n, gram),
voc AS (SELECT * FROM (SELECT df.*, d, row_number() OVER (PARTITION BY grp, n ORDER BY total DESC, gram) AS r
        FROM df JOIN docs USING (grp) WHERE df >= {min_df} AND df <= CAST({max_df} AS DOUBLE) * d) {cap}),
w AS (SELECT grp, n, id, gram, tf * (ln((1 + d) / CAST(1 + df AS DOUBLE)) + 1) AS w FROM tf JOIN voc USING (grp, n, gram)),
len AS (SELECT grp, n, id, sqrt(sum(w * w)) AS l FROM w GROUP BY grp, n, id),
sc AS (SELECT grp, n, gram AS ngram, round(sum(w / l), 4) AS tfidf FROM w JOIN len USING (grp, n, id) GROUP BY grp, n, gram),
ranked AS (SELECT *, row_number() OVER (PARTITION BY grp, n ORDER BY tfidf DESC, ngram) AS rank FROM sc)
SELECT {select} FROM ranked WHERE rank <= {top_k}""", "texts_v")


@query("tfidf_ngrams", sql_tfidf([2], 30, grouped=False, select="ngram, tfidf, n, rank"))
def q_tfidf_ngrams(spark, sf_dir):
    return ngrams.tfidf_ngrams(texts(spark, sf_dir), ns=(2,), top_k=30, stopwords=STOP).select("ngram", "tfidf", "n", "rank")


@query("tfidf_ngrams_capped", sql_tfidf([1, 2], 25, grouped=True, select="grp, ngram, tfidf, n, rank", min_df=2, max_df=0.3, max_features=400))
def q_tfidf_capped(spark, sf_dir):
    return ngrams.tfidf_ngrams(
        texts(spark, sf_dir), ns=(1, 2), top_k=25, group="grp", min_df=2, max_df=0.3, max_features=400, stopwords=STOP
    ).select("grp", "ngram", "tfidf", "n", "rank")


@query("ngram_report", sql_tfidf([2, 3], "CASE n WHEN 2 THEN 15 ELSE 10 END", grouped=False, select="ngram, tfidf, n, rank"))
def q_ngram_report(spark, sf_dir):
    return ngrams.ngram_report(texts(spark, sf_dir), top_k=25, stopwords=STOP)


@query("top_ngrams_split", sql_tfidf([2, 3], "CASE n WHEN 2 THEN 36 ELSE 24 END", grouped=False, select="ngram, tfidf, n, rank"))
def q_top_ngrams_split(spark, sf_dir):
    return ngrams.ngram_report(texts(spark, sf_dir), top_k=60, stopwords=STOP)


@query("tfidf_by_group", sql_tfidf(
    [2, 3], 30, grouped=True, select="grp, rank, ngram, tfidf, n, CASE n WHEN 2 THEN 'bigram' ELSE 'trigram' END AS type"))
def q_tfidf_by_group(spark, sf_dir):
    return ngrams.tfidf_by_group(texts(spark, sf_dir), group="grp", stopwords=STOP)


OPEN_GROUP = "CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'mixed' ELSE grp END AS grp"


@query("tfidf_by_group_open", sql_tfidf(
    [2, 3], 30, grouped=OPEN_GROUP, select="grp, rank, ngram, tfidf, n, CASE n WHEN 2 THEN 'bigram' ELSE 'trigram' END AS type"))
def q_tfidf_by_group_open(spark, sf_dir):
    """A group column with nulls and a value that is not reported: both count for "all"."""
    grp = F.when(F.col("id") % 6 == 1, "mixed").when(F.col("id") % 6 != 0, F.col("grp"))
    return ngrams.tfidf_by_group(texts(spark, sf_dir).withColumn("grp", grp), group="grp", stopwords=STOP)


@query("tokens_without_loaded_words", with_views(
    f""", all_w AS (SELECT DISTINCT unnest({sq.words('description')}) AS w FROM texts_v),
w AS (SELECT w FROM all_w WHERE length(w) % 2 = 0),
t AS (SELECT id, unnest({sq.words('description')}) AS token, unnest(range(len({sq.words('description')}))) AS at FROM texts_v)
SELECT x.id, coalesce(string_agg(t.token, ' ' ORDER BY t.at), '') AS tokens FROM texts_v x LEFT JOIN (SELECT * FROM t WHERE token NOT IN (SELECT w FROM w)) t USING (id) GROUP BY x.id""", "texts_v"))
def q_tokens_without_loaded_words(spark, sf_dir):
    """A word list of any length, loaded from a file and used on tokens."""
    rows = texts(spark, sf_dir).select("id", tx.words(F.col("description")).alias("tokens"))
    words = rows.select(F.explode("tokens").alias("w")).distinct().filter(F.length("w") % 2 == 0)
    path = scratch_folder(spark)
    words.write.text(path)
    found = load_stopwords(spark, path, plain=True)
    return ngrams.without_words(rows, "tokens", found).select("id", F.array_join("tokens", " ").alias("tokens"))


@query("group_sentiments", with_views(
    f"SELECT id, {sq.group_of('model1')} AS grp, {sq.group_of('upper(sentiment_result)')} AS result_grp FROM comments_v", "comments_v"))
def q_group_sentiments(spark, sf_dir):
    return comments(spark, sf_dir).select(
        "id", sentiment_group(F.col("model1")).alias("grp"), sentiment_group(F.upper("sentiment_result")).alias("result_grp"))


# --- exemplary comments -----------------------------------------------------------------------------------------
@query("lead_summary", with_views(
    f""", s AS (SELECT grp, id, {sq.strip('description')} AS text FROM texts_v),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY id) AS r FROM s WHERE length(text) > 20)
SELECT g.grp, chr(10) || '- ' || coalesce(string_agg(text, chr(10) || '- ' ORDER BY r), '') AS summary
FROM (SELECT DISTINCT grp FROM s) g LEFT JOIN (SELECT * FROM r WHERE r <= 5) r USING (grp) GROUP BY g.grp""", "texts_v"))
def q_lead_summary(spark, sf_dir):
    return exemplars.lead_summary(texts(spark, sf_dir), group="grp")


SQL_CENTRALITY = f""", s AS (SELECT grp, id, {sq.strip('description')} AS text FROM texts_v),
x AS (SELECT *, count(*) OVER (PARTITION BY grp) AS docs FROM s WHERE length(text) >= 20),
tok AS (SELECT grp, id, {sq.word_tokens('text', STOP)} AS t FROM x),
g AS (SELECT grp, id, unnest(t) AS gram FROM tok UNION ALL SELECT grp, id, unnest({sq.grams('t', 2)}) FROM tok),
tf AS (SELECT grp, id, gram, count(*) AS tf FROM g GROUP BY grp, id, gram),
n AS (SELECT grp, count(*) AS d FROM x GROUP BY grp),
voc AS (SELECT grp, gram, count(*) AS df, any_value(d) AS d FROM tf JOIN n USING (grp) GROUP BY grp, gram
        HAVING count(*) >= 2 AND count(*) <= (CASE WHEN floor(0.85::DOUBLE * any_value(d)) < 2 THEN 1.0 ELSE 0.85 END)::DOUBLE * any_value(d) AND any_value(d) >= 3),
w0 AS (SELECT grp, id, gram, tf * (ln((1 + d) / CAST(1 + df AS DOUBLE)) + 1) AS w FROM tf JOIN voc USING (grp, gram)),
len AS (SELECT grp, id, sqrt(sum(w * w)) AS l FROM w0 GROUP BY grp, id),
w AS (SELECT grp, id, gram, w / l AS w FROM w0 JOIN len USING (grp, id)),
c AS (SELECT grp, gram, sum(w) AS c FROM w GROUP BY grp, gram),
cl AS (SELECT grp, sqrt(sum(c * c)) AS cl FROM c GROUP BY grp),
p AS (SELECT grp, id, sum(w * c) AS p FROM w JOIN c USING (grp, gram) GROUP BY grp, id),
sc AS (SELECT x.grp, x.id, x.text, x.docs, CASE WHEN docs >= 3 THEN round(coalesce(p, 0) / cl, 6) END AS score
       FROM x LEFT JOIN cl USING (grp) LEFT JOIN p USING (grp, id) WHERE docs < 3 OR cl IS NOT NULL),
core AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp
         ORDER BY score DESC NULLS LAST, CASE WHEN score IS NULL THEN length(text) END DESC, id) AS rank FROM sc) WHERE rank <= 7)"""


@query("representative", with_views(SQL_CENTRALITY + " SELECT grp, rank, id, text, score FROM core", "texts_v"))
def q_representative(spark, sf_dir):
    return exemplars.representative(texts(spark, sf_dir), group="grp", max_comments=None)


@query("buckets", with_views(SQL_CENTRALITY + f""",
low AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score, id) AS r FROM sc WHERE score IS NOT NULL) WHERE r <= 3),
odd AS (SELECT * FROM low WHERE NOT EXISTS (SELECT 1 FROM core WHERE core.grp = low.grp AND core.text = low.text)),
ask AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY id) AS r FROM sc WHERE {sq.suggestion('text')}) WHERE r <= 5),
used AS (SELECT grp, text FROM core WHERE score IS NOT NULL UNION SELECT grp, text FROM odd),
free AS (SELECT * FROM ask WHERE NOT EXISTS (SELECT 1 FROM used WHERE used.grp = ask.grp AND used.text = ask.text))
SELECT grp, 'core' AS bucket, rank, id, text, score FROM core
UNION ALL SELECT grp, 'outliers', row_number() OVER (PARTITION BY grp ORDER BY r), id, text, score FROM odd
UNION ALL SELECT grp, 'suggestions', row_number() OVER (PARTITION BY grp ORDER BY r), id, text, score FROM free""", "texts_v"))
def q_buckets(spark, sf_dir):
    return exemplars.buckets(texts(spark, sf_dir), group="grp", max_comments=None)
