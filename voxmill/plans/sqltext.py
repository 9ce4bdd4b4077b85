"""The same text steps as SQL expressions for the engine that checks the results.

Its regular expressions know neither lookaround nor back references, so some steps
take another way to the same text; that makes the comparison worth something.
"""

from __future__ import annotations

from ..functions import lexicon as lx
from ..functions.text import escape_class

WS = lx.SPACE_CHARS
W = lx.WORD_CHARS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lit_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else lit(v) for v in values) + "]"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def rx(x: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(replacement)}, 'g')"


def strip(x):
    return rx(x, rf"\A[{WS}]+|[{WS}]+\z", "")


def collapse(x):
    return rx(x, f"[{WS}]+", " ")


def squeeze(x):
    return collapse(strip(f"coalesce({x}, '')"))


def words(x):
    return f"list_filter(string_split_regex({x}, '[{WS}]+'), lambda w: w <> '')"


def word_count(x):
    return f"len({words(x)})"


def drop_short_sentences(x, n):
    parts = f"string_split({rx(x, rf'([.!?])[{WS}]+', chr(92) + '1' + chr(1))}, chr(1))"
    stripped = f"list_transform({parts}, lambda s: {strip('s')})"
    return f"array_to_string(list_filter({stripped}, lambda s: s <> '' AND {word_count('s')} >= {n}), ' ')"


def translate(x, source, target):
    return f"translate({x}, {lit(source)}, {lit(target)})"


def fa_digits(x):
    return translate(x, lx.PERSIAN_DIGITS, lx.ASCII_DIGITS)


def en_digits(x):
    return translate(x, lx.ASCII_DIGITS, lx.PERSIAN_DIGITS)


def ar_letters(x):
    return translate(x, lx.ARABIC_LETTERS, lx.PERSIAN_LETTERS)


def diacritics(x):
    return rx(x, r"[\x{64B}-\x{652}]", "")


def half_space(x):
    return f"replace({x}, chr(8204), '')"


def long_runs(x):
    """Keep a character unless it equals the two before it and is a word character."""
    chars = f"string_split({x}, '')"
    keep = (
        f"lambda c, i: NOT (i > 2 AND c = cs[i - 1] AND c = cs[i - 2] AND regexp_matches(c, '[{W}]'))"
    )
    return f"(SELECT array_to_string(list_filter(cs, {keep}), '') FROM (SELECT {chars} AS cs))"


def number_start(x):
    return rx(x, r" [\p{Nd}+]", " ")


def rating_word(x):
    cases = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in lx.RATING_WORDS.items())
    return f"CASE {x} {cases} ELSE {x} END"


def punctuation(x):
    return rx(x, rf"[^{W}\[\]]", " ")


def punctuation_except(x, keep):
    removed = "".join(c for c in lx.ASCII_PUNCTUATION + lx.PERSIAN_PUNCTUATION if c not in keep)
    return strip(collapse(rx(x, f"[{escape_class(removed)}]+", " ")))


def double_spaces(x):
    return rx(x, f"[{WS}]{{2,}}", " ")


def mi_prefix(x):
    return rx(x, rf"(\A|[^{W}])(ن?می)[{WS}]+([^{WS}]+)", rf"\1\2{lx.ZWNJ}\3")


def phrases(x, values):
    return strip(collapse(rx(x, f"[{WS}]*(?:{'|'.join(values)})[{WS}]*", " ")))


def pad(x):
    return strip(collapse(rx(x, f"([{lx.PADDED_PUNCTUATION}])", r" \1 ")))


def tight_after(x, values):
    for v in values:
        x = rx(x, f"{v}[{WS}]+", v)
    return x


def half_before(x, values):
    for v in values:
        x = rx(x, f"[{WS}]+{v}", lx.ZWNJ + v)
    return x


def plural(x):
    """Neighbouring endings share the character between them, hence the repetition."""
    gap = f"(?:[{WS}]|{lx.ZWNJ})"
    one = "ها(?:یی?)?"
    return rx(x, rf"{gap}?{one}(?:{gap}{one})*([^{W}]|\z)", r"\1")


def line_breaks(x):
    return f"replace(replace(replace({x}, chr(13) || chr(10), ' '), chr(10), ' '), chr(9), ' ')"


def first_digit(x):
    return rx(x, r"(\p{Nd})\p{Nd}*", r"\1")


def match_form(x):
    return strip(line_breaks(plural(double_spaces(half_space(strip(f"coalesce({x}, '')"))))))


def report_form(x):
    x = strip(ar_letters(fa_digits(x)))
    x = double_spaces(f"replace({x}, chr(8204), ' ')")
    x = rx(number_start(long_runs(x)), f"[^{W}]", " ")
    x = rx(en_digits(x), r"\p{Nd}+", " ")
    return rx(ar_letters(x), f"[^{W}]", " ")


def tokens(x, stopwords, pattern=r"[\x{600}-\x{6FF}]+"):
    clean = plural(double_spaces(punctuation(number_start(diacritics(ar_letters(fa_digits(strip(x))))))))
    stop = f" AND t NOT IN {in_list(stopwords)}" if stopwords else ""
    return (
        f"list_filter(string_split_regex({clean}, '[{WS}\\[\\]]+'), "
        f"lambda t: regexp_full_match(t, {lit(pattern)}){stop})"
    )


def word_tokens(x, stopwords=()):
    found = f"regexp_extract_all(lower({x}), '[{W}]{{2,}}')"
    return f"list_filter({found}, lambda t: t NOT IN {in_list(stopwords)})" if stopwords else found


def grams(x, n, separator=" "):
    """``x`` is used several times; pass a column."""
    if n == 1:
        return x
    shifted = ", ".join([x] + [f"{x}[{i}:]" for i in range(2, n + 1)])
    parts = ", ".join(f"z[{i}]" for i in range(1, n + 1))
    return f"list_transform(list_zip({shifted}, true), lambda z: concat_ws({lit(separator)}, {parts}))"


def suggestion(x):
    wording = "|".join(p.replace(r"\s", f"[{WS}]") for p in lx.SUGGESTION_PATTERNS)
    return f"coalesce(regexp_matches({x}, {lit(rf'(?:\A|[^{W}])(?:{wording})(?:[^{W}]|\z)')}), false)"


def latin(x):
    return f"coalesce(regexp_matches({x}, '[A-Za-z]'), false)"


def case_map(x, mapping, default="NULL"):
    cases = " ".join(f"WHEN {lit(k)} THEN {v if isinstance(v, int) else lit(v)}" for k, v in mapping.items())
    return f"CASE {x} {cases} ELSE {default} END"


def group_of(x):
    return (
        f"CASE WHEN lower({x}) IN ('negative', 'very negative') THEN 'negative' "
        f"WHEN lower({x}) IN ('positive', 'very positive') THEN 'positive' ELSE 'neutral' END"
    )


def stamp(x):
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def jalali_int(d):
    """``d`` is a DATE expression."""
    o = f"(date_diff('day', DATE '0001-01-01', {d}) + 1 - 226530)"
    return f"""(SELECT CAST(y * 10000 + CASE WHEN doy < 186 THEN (doy // 31 + 1) * 100 + doy % 31 + 1
        ELSE ((doy - 186) // 30 + 7) * 100 + (doy - 186) % 30 + 1 END AS INTEGER)
        FROM (SELECT y, o - 365 * y - CAST(floor((8 * y + 21) / 33.0) AS BIGINT) AS doy
              FROM (SELECT o, CAST(floor((33 * o + 11) / 12053.0) AS BIGINT) AS y FROM (SELECT {o} AS o))))"""
