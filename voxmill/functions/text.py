"""Text normalisation as column expressions.

Each step is a function Column -> Column built from ``translate`` and
``regexp_replace``; ``normalize_text`` strings the chosen steps together. Word and
space classes are spelled out, because ``\\w``, ``\\s`` and ``\\b`` mean different
things in different regular-expression dialects.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx

SPACE = f"[{lx.SPACE_CHARS}]"
WORD = f"[{lx.WORD_CHARS}]"
NOT_AFTER_WORD = f"(?<!{WORD})"
NOT_BEFORE_WORD = f"(?!{WORD})"
DIGIT = r"\p{Nd}"
NUMBER_START = f" [{DIGIT}+]"
PLURAL = f"ها(?:یی?)?{NOT_BEFORE_WORD}"


def _replace(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def escape_class(characters: str) -> str:
    """Body of a character class; punctuation is escaped, letters are not."""
    return "".join("\\" + c if c in lx.ASCII_PUNCTUATION else c for c in characters)


def literal_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- single steps --------------------------------------------------------------------------
def strip(text: Column) -> Column:
    """Unicode white space off both ends (plain ``trim`` knows U+0020 only)."""
    return F.trim(text, F.lit(lx.SPACES))


def collapse(text: Column) -> Column:
    """White space runs become one space. A single blank is no match: nothing changes there."""
    return _replace(text, f"[{lx.SPACE_CHARS_BUT_BLANK}]{SPACE}*| {SPACE}+", " ")


def squeeze(text: Column) -> Column:
    """Null becomes '', ends stripped, white space runs become one space."""
    return collapse(strip(F.coalesce(text, F.lit(""))))


def words(text: Column) -> Column:
    """White-space separated words; an empty or blank text has none."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def drop_short_sentences(text: Column, min_words: int) -> Column:
    sentences = F.transform(F.split(text, rf"(?<=[.!?]){SPACE}+"), strip)
    no_space = f"[^{lx.SPACE_CHARS}]+"
    enough = rf"\A{no_space}(?:{SPACE}+{no_space}){{{max(0, min_words - 1)}}}"  # looks at the first words only
    kept = F.filter(sentences, lambda s: F.rlike(s, F.lit(enough)))
    return F.array_join(kept, " ")


def persian_digits_to_ascii(text: Column) -> Column:
    return F.translate(text, lx.PERSIAN_DIGITS, lx.ASCII_DIGITS)


def ascii_digits_to_persian(text: Column) -> Column:
    return F.translate(text, lx.ASCII_DIGITS, lx.PERSIAN_DIGITS)


def arabic_to_persian(text: Column) -> Column:
    return F.translate(text, lx.ARABIC_LETTERS, lx.PERSIAN_LETTERS)


def drop_diacritics(text: Column) -> Column:
    return F.translate(text, lx.DIACRITICS, "")


def drop_half_space(text: Column) -> Column:
    return F.translate(text, lx.ZWNJ, "")


def shorten_runs(text: Column) -> Column:
    """Three or more equal word characters in a row become two."""
    return _replace(text, rf"({WORD})\1{{2,}}", "$1$1")


def rating_digit_to_word(text: Column) -> Column:
    pairs = [F.lit(part) for pair in lx.RATING_WORDS.items() for part in pair]
    return let(text, lambda t: F.coalesce(F.create_map(*pairs)[t], t))  # else all steps before run twice


def drop_number_start(text: Column) -> Column:
    """A space and one digit or plus sign become one space."""
    return _replace(text, NUMBER_START, " ")


def punctuation_to_space(text: Column) -> Column:
    """Everything but word characters and brackets; blanks are left out of the pattern
    because replacing them changes nothing."""
    return _replace(text, rf"[^{lx.WORD_CHARS}\[\] ]", " ")


def punctuation_to_space_except(text: Column, keep: Sequence[str]) -> Column:
    removed = [c for c in lx.ASCII_PUNCTUATION + lx.PERSIAN_PUNCTUATION if c not in set(keep)]
    if not removed:
        return strip(collapse(text))
    return strip(collapse(_replace(text, f"[{escape_class(''.join(removed))}]+", " ")))


def collapse_double_spaces(text: Column) -> Column:
    """Only runs of two or more; a single line break stays."""
    return _replace(text, f"{SPACE}{{2,}}", " ")


def join_mi_prefix(text: Column) -> Column:
    return _replace(text, f"{NOT_AFTER_WORD}(ن?می){SPACE}+([^{lx.SPACE_CHARS}]+)", f"$1{lx.ZWNJ}$2")


def drop_phrases(text: Column, phrases: Sequence[str]) -> Column:
    return strip(collapse(_without_phrases(text, phrases))) if phrases else strip(text)


def _without_phrases(text: Column, phrases: Sequence[str]) -> Column:
    quoted = "|".join(rf"\Q{p}\E" for p in phrases)
    return _replace(text, f"{SPACE}*(?:{quoted}){SPACE}*", " ") if phrases else text


def pad_punctuation(text: Column) -> Column:
    return strip(collapse(_replace(text, f"([{lx.PADDED_PUNCTUATION}])", " $1 ")))


def no_space_after(text: Column, word_patterns: Sequence[str]) -> Column:
    for word in word_patterns:
        text = _replace(text, f"{word}{SPACE}+", literal_replacement(word))
    return text


def half_space_before(text: Column, word_patterns: Sequence[str]) -> Column:
    for word in word_patterns:
        text = _replace(text, f"{SPACE}+{word}", lx.ZWNJ + literal_replacement(word))
    return text


def drop_plural_suffix(text: Column) -> Column:
    """The plural ending with its optional leading space; also cuts inside words."""
    return _replace(text, f"(?:{SPACE}|{lx.ZWNJ})?{PLURAL}", "")


def line_breaks_to_space(text: Column) -> Column:
    return _replace(text, r"\r\n|\n|\t", " ")


def first_digit_of_number(text: Column) -> Column:
    return _replace(text, f"({DIGIT}){DIGIT}*", "$1")


# --- compositions ----------------------------------------------------------------------------
def normalize_text(
    text: Column,
    *,
    min_sentence_words: int = 0,
    ascii_digits: bool = False,
    persian_letters: bool = False,
    without_diacritics: bool = False,
    without_half_space: bool = False,
    short_runs: bool = False,
    rating_words: bool = False,
    without_number_start: bool = False,
    persian_digits: bool = False,
    without_punctuation: bool = False,
    keep_punctuation: Sequence[str] | None = None,
    single_spaces: bool = False,
    mi_prefix: bool = False,
    without_phrases: Sequence[str] | None = None,
    padded_punctuation: bool = False,
    tight_after: Sequence[str] | None = None,
    half_space_before_words: Sequence[str] | None = None,
    without_plural: bool = True,
    single_line: bool = False,
) -> Column:
    """Chosen steps in their fixed order. Stripping always happens, and the plural
    ending is removed unless ``without_plural=False``."""
    text = strip(text)
    if min_sentence_words > 0:
        text = drop_short_sentences(text, min_sentence_words)

    # Neighbouring one-character steps are a single pass over the text. Characters
    # without a partner come last: translate() deletes them.
    mapped = (lx.PERSIAN_DIGITS if ascii_digits else "") + (lx.ARABIC_LETTERS if persian_letters else "")
    target = (lx.ASCII_DIGITS if ascii_digits else "") + (lx.PERSIAN_LETTERS if persian_letters else "")
    dropped = (lx.DIACRITICS if without_diacritics else "") + (lx.ZWNJ if without_half_space else "")
    if mapped or dropped:
        text = F.translate(text, mapped + dropped, target)

    steps = [
        (short_runs, shorten_runs),
        (rating_words, rating_digit_to_word),
        (without_number_start, drop_number_start),
        (persian_digits, ascii_digits_to_persian),
        (without_punctuation, punctuation_to_space),
        (keep_punctuation, lambda t: punctuation_to_space_except(t, keep_punctuation)),
        (single_spaces and not keep_punctuation, collapse_double_spaces),  # that step leaves single blanks
        (mi_prefix, join_mi_prefix),
        # padding strips and collapses after it
        (without_phrases, lambda t: (_without_phrases if padded_punctuation else drop_phrases)(t, without_phrases)),
        (padded_punctuation, pad_punctuation),
        (tight_after, lambda t: no_space_after(t, tight_after)),
        (half_space_before_words, lambda t: half_space_before(t, half_space_before_words)),
        (without_plural, drop_plural_suffix),
        (single_line, line_breaks_to_space),
    ]
    for wanted, step in steps:
        if wanted:
            text = step(text)
    return text


def normalize_for_match(text: Column) -> Column:
    """Form in which titles, evidence and comments are compared; null becomes ''."""
    return strip(
        normalize_text(
            F.coalesce(text, F.lit("")), without_half_space=True, single_spaces=True, single_line=True
        )
    )


def normalize_for_report(text: Column) -> Column:
    """Form used by the word-frequency reports. Digits go away altogether."""
    mapped, target = lx.PERSIAN_DIGITS + lx.ARABIC_LETTERS + lx.ZWNJ, lx.ASCII_DIGITS + lx.PERSIAN_LETTERS + " "
    text = shorten_runs(collapse_double_spaces(F.translate(strip(text), mapped, target)))
    # in one pass: a digit or plus sign after a blank, numbers, and everything else that is no word character
    return _replace(text, f"{NUMBER_START}|{DIGIT}+|[^{lx.WORD_CHARS} ]", " ")


# --- tokens and predicates ---------------------------------------------------------------------
def _checked(stopwords: Sequence[str]) -> list[str]:
    """The list as it becomes part of the plan (a hash set there). A list that is a table
    of its own goes through ``operators.ngrams.without_words``."""
    return sorted(set(stopwords))


def _not_in(token: Column, stopwords: list[str]) -> Column:
    return ~token.isin(stopwords) if stopwords else F.lit(True)


def tokenize(text: Column, pattern: str = lx.PERSIAN_TOKEN, stopwords: Sequence[str] = ()) -> Column:
    """Array of the tokens that match ``pattern`` as a whole and are no stop words,
    in text order with repeats; null gives an empty array."""
    stop = _checked(stopwords)
    mapped = F.translate(strip(text), lx.PERSIAN_DIGITS + lx.ARABIC_LETTERS + lx.DIACRITICS, lx.ASCII_DIGITS + lx.PERSIAN_LETTERS)
    # One pass for three steps of ``normalize_text``: what they remove or turn into a blank separates words
    # (the plural ending, a digit after a blank, everything but word characters). Empty parts match no pattern.
    parts = F.split(mapped, f"{PLURAL}|{NUMBER_START}|[^{lx.WORD_CHARS}]")
    kept = F.filter(parts, lambda t: F.rlike(t, F.lit(rf"\A(?:{pattern})\z")) & _not_in(t, stop))
    return F.coalesce(kept, F.array().cast("array<string>"))


def word_tokens(text: Column, stopwords: Sequence[str] = ()) -> Column:
    """Lower-cased runs of two or more word characters, without stop words."""
    stop = _checked(stopwords)
    found = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD}{{2,}})"), F.lit(1))
    kept = F.filter(found, lambda t: _not_in(t, stop)) if stop else found
    return F.coalesce(kept, F.array().cast("array<string>"))


def remove_stopwords(text: Column, stopwords: Sequence[str]) -> Column:
    stop = _checked(stopwords)
    return F.array_join(F.filter(words(text), lambda w: _not_in(w, stop)), " ")


def ngrams(tokens: Column, n: int, separator: str = " ") -> Column:
    """Array of the n-grams of a token array; shorter arrays give none."""

    def from_tokens(t: Column) -> Column:
        starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - (n - 1)))
        # element_at is constant time, slice() would copy the whole array per n-gram
        return F.transform(starts, lambda i: F.concat_ws(separator, *[F.element_at(t, i + j) for j in range(n)]))

    return F.coalesce(let(tokens, from_tokens), F.array().cast("array<string>"))


def ngram_text(text: Column, n: int) -> Column:
    """n-grams of the words joined by ``_``, then by a space."""
    return F.array_join(ngrams(words(text), n, "_"), " ")


def is_persian(text: Column) -> Column:
    return F.rlike(text, F.lit(r"[\x{600}-\x{6FF}]"))


def contains_latin(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit("[A-Za-z]")), F.lit(False))


def is_suggestion(text: Column) -> Column:
    """Any wording of a suggestion as a whole word; null and blank are none."""
    wording = "|".join(p.replace(r"\s", SPACE) for p in lx.SUGGESTION_PATTERNS)
    found = F.rlike(text, F.lit(f"{NOT_AFTER_WORD}(?:{wording}){NOT_BEFORE_WORD}"))
    return F.coalesce(found, F.lit(False))


def plain_pattern(values: Sequence[str]) -> str:
    """Alternation that matches any of ``values`` literally."""
    return "|".join(re.escape(v) for v in values)
