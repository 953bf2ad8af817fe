"""Text expressions on a string column.

Everything here is a built-in expression over one row: no Python worker and no
shuffle. Counting is done by deleting (`length` before minus after) instead of a lambda per
token; `regexp_count` and `regexp_extract_all` make a string of each match, so they
are kept for few matches.
The quantifiers on word parts are possessive, so a very long word is still matched
in linear time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters at which text is split into words, and the
# character classes the features count.
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
PUNCTUATION = r"!-/:-@\[-`{-~"
DIGITS = r"\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
WORD_CHARS = r"\p{L}\p{N}_"
# The same classes among the first 256 characters, where a class is one table and not a chain of tests.
LATIN_SPACE = r"\t-\r\x1c-\x20\x85\xa0"
LATIN_NOT_WORD = (
    r"\x00-/:-@\[-^`{-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7"
)
_BEYOND_LATIN = r"[\x{100}-\x{10ffff}]"
# Characters that cleaning turns into spaces.
CLEANED_AWAY = "!\"#%&'()*+,-./:;<=>?@[\\]^_`{|}~–"

# Whole words of one case, each behind a space: a search then fails at once on most characters.
_END = "(?![^ ])"
_UNCASED = r"[^ \p{Lu}\p{Ll}\p{Lt}]"
_UPPER_WORD = rf" {_UNCASED}*+\p{{Lu}}[^ \p{{Ll}}\p{{Lt}}]*+{_END}"
_LOWER_WORD = (
    rf" (?:[!-@\[-`{{-~]*+[a-z][!-@\[-~]*+{_END}"
    rf"|{_UNCASED}*+\p{{Ll}}[^ \p{{Lu}}\p{{Lt}}]*+{_END})"
)
_TITLE_WORD = (
    rf" {_UNCASED}*+"
    rf"(?:[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*+(?:{_UNCASED}++|{_END}))++{_END}"
)

META_FEATURES = (
    "num_words",
    "num_unique_words",
    "num_chars",
    "num_punctuations",
    "num_words_upper",
    "num_words_title",
    "mean_word_len",
    "num_special_char",
    "num_numerics",
    "num_uppercase",
    "num_lowercase",
)


def _by_letters(text: Column, latin: Column, general: Column) -> Column:
    """`latin` for a text of the first 256 characters alone, `general` for others."""
    return F.when(text.rlike(_BEYOND_LATIN), general).otherwise(latin)


def _split(text: Column, latin: str, general: str) -> Column:
    pieces = _by_letters(text, F.split(text, f"[{latin}]+"), F.split(text, f"[{general}]+"))
    return F.array_remove(pieces, "")


def words(text: Column) -> Column:
    """Words between runs of whitespace, without empty entries."""
    return _split(text, LATIN_SPACE, SPACE)


def word_tokens(text: Column) -> Column:
    """Runs of letters, digits and underscores."""
    return _split(text, LATIN_NOT_WORD, f"^{WORD_CHARS}")


def vocabulary_tokens(text: Column) -> Column:
    """Lower-cased word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"([{WORD_CHARS}]{{2,}})"), F.lit(1))


def upper_word_list(text: Column) -> Column:
    """Upper-cased word tokens."""
    return word_tokens(F.upper(text))


def count_tokens(text: Column) -> Column:
    """Number of words."""
    return F.size(words(text))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def case_counts(joined: Column) -> tuple[Column, Column, Column]:
    """Numbers of words in upper, title and lower case, of words joined by single spaces.

    Most words are in lower case. Runs of them go, each with the space before it, and are
    counted by these spaces; the other patterns look at what is left.
    """
    spaced = F.concat(F.lit(" "), joined)
    no_lower = F.regexp_replace(spaced, f"(?:{_LOWER_WORD})++", "")
    upper = F.regexp_count(no_lower, F.lit(_UPPER_WORD))
    title = F.regexp_count(no_lower, F.lit(_TITLE_WORD))
    return upper, title, _spaces(spaced) - _spaces(no_lower)


def meta_feature_columns(text: Column) -> dict[str, Column]:
    """The eleven counts and means taken from the raw text.

    The words, and the text without plain letters and spaces, are each worked out
    once per row and shared; most character counts then look at a short rest.
    """
    split = words(text)
    num_words = F.size(split)
    joined = F.array_join(split, " ")
    word_chars = F.length(joined) - F.greatest(num_words - 1, F.lit(0))
    rest = F.regexp_replace(text, "[a-zA-Z ]+", "")

    def among_rest(char_class: str) -> Column:
        return F.length(rest) - F.length(F.regexp_replace(rest, f"[{char_class}]+", ""))

    upper, title, lower = case_counts(joined)
    return {
        "num_words": num_words,
        "num_unique_words": F.size(F.array_distinct(split)),
        "num_chars": F.length(text),
        "num_punctuations": among_rest(PUNCTUATION),
        "num_words_upper": upper,
        "num_words_title": title,
        "mean_word_len": F.try_divide(word_chars.cast("double"), num_words.cast("double")),
        "num_special_char": F.length(F.regexp_replace(rest, "[0-9]+", "")),
        "num_numerics": among_rest(DIGITS),
        "num_uppercase": upper,
        "num_lowercase": lower,
    }


def clean_text(text: Column) -> Column:
    """Listed signs to spaces, then single spaces between words; `$` stays."""
    def squeezed(space: str, signs: Iterable[str]) -> Column:
        listed = "".join(f"\\x{{{ord(sign):x}}}" for sign in signs)
        return F.regexp_replace(text, f"[{space}{listed}]+", " ")

    latin = [sign for sign in CLEANED_AWAY if ord(sign) < 256]
    return F.trim(_by_letters(text, squeezed(LATIN_SPACE, latin), squeezed(SPACE, CLEANED_AWAY)))


def letters_only(text: Column) -> Column:
    """Everything but ASCII letters to spaces, lower case, single spaces."""
    return F.trim(F.lower(F.regexp_replace(text, "[^a-zA-Z]+", " ")))


def exploded(array: Column) -> Column:
    """One row per entry of a computed array.

    `explode` of a plain column makes the optimizer add a `size > 0` filter,
    which is pushed down and works the text out a second time, in the scan.
    """
    return F.explode(F.when(F.size(array) > 0, array))


def positions(array: Column, least: int = 1, run: int = 1) -> Column:
    """One row per start of a run of `run` entries, from 0.

    An array of fewer than `least` entries has none.
    """
    size = F.size(array)
    return F.explode(F.when(size >= max(least, run), F.sequence(F.lit(0), size - run)))


def without(array: Column, stop_words: Iterable[str]) -> Column:
    """The words that are not stop words, in order and repeated as they were."""
    stop = sorted(set(stop_words))
    # A long IN list becomes one hash lookup per word.
    return F.filter(array, lambda word: ~word.isin(stop)) if stop else array


def clean_reviews_words(text: Column, stop_words: Iterable[str]) -> Column:
    """Words left once other signs are deleted and stop words dropped.

    Signs are deleted rather than spaced, so `don't` becomes `dont` before stop
    words are looked up.
    """
    kept = F.lower(F.regexp_replace(text, rf"[^a-zA-Z0-9{SPACE}]+", ""))
    return without(words(kept), stop_words)


def clean_reviews_text(text: Column, stop_words: Iterable[str]) -> Column:
    """`clean_reviews_words` joined by single spaces."""
    return F.array_join(clean_reviews_words(text, stop_words), " ")
