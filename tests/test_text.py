"""Hand-written expectations on Persian rows."""

import pytest
from pyspark.sql import functions as F

from voxmill.functions import lexicon as lx
from voxmill.functions import text as tx

Z = "‌"

CASES = [
    ("ha joined", tx.drop_plural_suffix, f"کارت{Z}ها", "کارت"),
    ("ha apart", tx.drop_plural_suffix, "کارت های من", "کارت من"),
    ("ha inside a word", tx.drop_plural_suffix, "تنها", "تن"),
    ("ha not before a letter", tx.drop_plural_suffix, "هاله", "هاله"),
    ("two endings", tx.drop_plural_suffix, "ها ها", ""),
    ("number start", tx.drop_number_start, "کد 123 و +9", "کد 23 و 9"),
    ("long runs", tx.shorten_runs, "خیلییییی خوب!!!!", "خیلیی خوب!!!!"),
    ("punctuation", tx.punctuation_to_space, f"خوب!{Z}عالی [1]", "خوب  عالی [1]"),
    ("mi prefix", tx.join_mi_prefix, "نمی شود و می خواهم", f"نمی{Z}شود و می{Z}خواهم"),
    ("mi inside a word", tx.join_mi_prefix, "قدیمی شد", "قدیمی شد"),
    ("match form", tx.normalize_for_match, f" مدیریت حساب{Z}ها\n", "مدیریت حساب"),
    ("match form of null", tx.normalize_for_match, None, ""),
    ("digits", tx.persian_digits_to_ascii, "۱۲.۳", "12.3"),
    ("letters", tx.arabic_to_persian, "كىيئإأةؤ", "کیییااهو"),
    ("diacritics", tx.drop_diacritics, "مُحَمَّد", "محمد"),
    ("rating", tx.rating_digit_to_word, "4", "خوب"),
    ("no rating", tx.rating_digit_to_word, "42", "42"),
    ("single line break stays", tx.collapse_double_spaces, "a\nb  c \n d", "a\nb c d"),
    ("line breaks", tx.line_breaks_to_space, "a\r\nb\rc\td", "a b\rc d"),
    ("sentences", lambda c: tx.drop_short_sentences(c, 2), "بله. خیلی خوب بود! نه؟ کند است.", "خیلی خوب بود! نه؟ کند است."),
    ("padding", tx.pad_punctuation, "سلام(دنیا)،خوب", "سلام ( دنیا ) ، خوب"),
    ("keep", lambda c: tx.punctuation_to_space_except(c, ["-"]), "a-b, c؟ (d)", "a-b c d"),
    ("phrases", lambda c: tx.drop_phrases(c, ["a.b", "x"]), "1 a.b 2 aXb x 3", "1 2 aXb 3"),
    ("tight", lambda c: tx.no_space_after(c, ["می"]), "می  رود", "میرود"),
    ("half space", lambda c: tx.half_space_before(c, ["ها"]), "کتاب ها", f"کتاب{Z}ها"),
    ("first digit", tx.first_digit_of_number, "a123b45", "a1b4"),
    ("report", tx.normalize_for_report, f"خوب{Z}بود 123!!", "خوب بود    "),
    ("stop words", lambda c: tx.remove_stopwords(c, ["و"]), "این  و آن", "این آن"),
    ("bigrams", lambda c: tx.ngram_text(c, 2), "a b c", "a_b b_c"),
    ("bigrams of one word", lambda c: tx.ngram_text(c, 2), "a", ""),
]


@pytest.mark.parametrize("name,step,given,expected", CASES, ids=[c[0] for c in CASES])
def test_step(spark, name, step, given, expected):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(step(F.col("t"))).first()[0] == expected


def test_plural_is_removed_by_default(spark):
    df = spark.createDataFrame([(" کارت ها ",)], "t string")
    assert df.select(tx.normalize_text(F.col("t"))).first()[0] == "کارت"
    assert df.select(tx.normalize_text(F.col("t"), without_plural=False)).first()[0] == "کارت ها"


def test_tokens(spark):
    df = spark.createDataFrame([("كارت‌ها [خوب] abc و ۱۲ است",), (None,), ("",)], "t string")
    rows = [r[0] for r in df.select(tx.tokenize(F.col("t"), stopwords=["و"])).collect()]
    assert rows == [["کارت", "خوب", "است"], [], []]


def test_normalisers_accept_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",)], "t string")
    everything = tx.normalize_text(
        F.col("t"), min_sentence_words=1, ascii_digits=True, persian_letters=True, without_diacritics=True,
        without_half_space=True, short_runs=True, rating_words=True, without_number_start=True, persian_digits=True,
        without_punctuation=True, keep_punctuation=["-"], single_spaces=True, mi_prefix=True, without_phrases=["x"],
        padded_punctuation=True, single_line=True,
    )
    assert [r[0] for r in df.select(everything).collect()] == [None, "", ""]


@pytest.mark.parametrize("text,expected", [
    ("لطفا درست کنید", True), ("میخوام برگردم", True), (f"می{Z}خوام", True), ("بهتر  است بماند", True),
    ("امکانات خوب", False), ("کاشان", False), ("", False), (None, False),
])
def test_suggestions(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tx.is_suggestion(F.col("t"))).first()[0] is expected


def test_word_lists():
    assert len(lx.SUGGESTION_PATTERNS) == 19
    assert len(lx.FEATURE_OF_TITLE) == 11
    assert len(lx.ARABIC_LETTERS) == len(lx.PERSIAN_LETTERS)


def test_rating_words_and_report_form_do_not_repeat_steps(spark):
    """The text before the rating step is named once, and the report form takes three patterns, with unchanged results."""
    marked = F.concat(F.col("description"), F.lit("once"))
    df = spark.createDataFrame([(" 5 6x +7!!12 aaaa  b٣٤ 1",), ("4",), (None,)], "description string")
    plan = df.select(tx.rating_digit_to_word(marked).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("once") == 1
    report = tx.normalize_for_report(F.col("description"))
    assert df.select(report.alias("x"))._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 3
    # the single steps, one after the other
    not_word = f"[^{lx.WORD_CHARS} ]"
    steps = tx.strip(tx.arabic_to_persian(tx.persian_digits_to_ascii(F.col("description"))))
    steps = tx.drop_number_start(tx.shorten_runs(tx.collapse_double_spaces(F.translate(steps, lx.ZWNJ, " "))))
    steps = F.regexp_replace(tx.ascii_digits_to_persian(F.regexp_replace(steps, not_word, " ")), r"\p{Nd}+", " ")
    assert all(r.a == r.b for r in df.select(report.alias("a"), F.regexp_replace(steps, not_word, " ").alias("b")).collect())
