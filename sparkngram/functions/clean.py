"""Text cleaning rules as Spark Column functions (catalogue C1-C18).

Every rule is one ``regexp_replace`` / ``lower`` / ``trim`` so the whole
cleaner compiles into a single codegen'd projection; no Python runs per
row.  Regexes are Java syntax; back-references are used where the rule
needs them (C8-C10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns must match the reference's to give its
# results.  POSIX classes are written as Java's, which cover ASCII alike.
NON_ASCII = r"[^\x00-\x7F]"
PUNCTUATION = r"\p{Punct}+"
DIGITS = r"\d+"
UNDERSCORES = r"_+"
COLON = r":"
DOT = r"\."
SINGLE_LETTER = r"\s([b-hj-z])\1{0,}\b"
LETTER_RUN = r"(\p{Alpha})\1{2,}"
DOUBLED_START = r"\s([a-z])\1{1,2}('(s|ve|d|re))?"

# ---------------------------------------------------------------- single rules


def to_ascii(c: Column) -> Column:
    """latin1->ASCII with unmappable bytes dropped; on UTF-8 text every
    non-ASCII character disappears."""
    return F.regexp_replace(c, NON_ASCII, "")


def lower(c: Column) -> Column:
    """C2."""
    return F.lower(c)


def remove_punctuation(c: Column) -> Column:
    """Delete ASCII punctuation (``don't`` -> ``dont``)."""
    return F.regexp_replace(c, PUNCTUATION, "")


def remove_numbers(c: Column) -> Column:
    """C4."""
    return F.regexp_replace(c, DIGITS, "")


def strip_whitespace(c: Column) -> Column:
    """C5 first half: collapse whitespace runs to one blank."""
    return F.regexp_replace(c, r"\s+", " ")


def squish(c: Column) -> Column:
    """Collapse whitespace and trim."""
    return F.trim(strip_whitespace(c))


def remove_underscores(c: Column) -> Column:
    """``_`` is the n-gram separator, so it may not survive in text."""
    return F.regexp_replace(c, UNDERSCORES, "")


def colon_dot_to_blank(c: Column) -> Column:
    """C7."""
    return F.regexp_replace(F.regexp_replace(c, COLON, " "), DOT, " ")


def drop_single_letters(c: Column) -> Column:
    """A one-letter word (and its repeats) other than a / i, after a
    blank, becomes a blank."""
    return F.regexp_replace(c, SINGLE_LETTER, " ")


def squeeze_letter_runs(c: Column) -> Column:
    """Three or more repeats of a letter become one."""
    return F.regexp_replace(c, LETTER_RUN, "$1")


def drop_doubled_starts(c: Column) -> Column:
    """A doubled / tripled letter at a word start (with an optional
    's / 've / 'd / 're) becomes a blank.  No trailing word boundary, so
    `` oops`` -> `` ps``; kept as the reference does it."""
    return F.regexp_replace(c, DOUBLED_START, " ")


def remove_urls(c: Column) -> Column:
    """C11: a URL and everything after it up to the last word boundary."""
    return F.regexp_replace(c, r"(?s)http(s)?:.*\b", "")


def remove_ellipsis(c: Column) -> Column:
    """C12."""
    return F.regexp_replace(c, r"\.\.\.", "")


def punctuation_to_blank(c: Column) -> Column:
    """C13 (evaluation only)."""
    return F.regexp_replace(c, r"\p{Punct}", " ")


def clean_input(c: Column) -> Column:
    """C14: keep alphanumerics, whitespace and apostrophes; drop up to ten
    leading blanks; squeeze runs of 2-10 blanks."""
    c = F.regexp_replace(F.lower(c), r"[^\p{Alnum}\s']", "")
    c = F.regexp_replace(c, r"^ {1,10}", "")
    return F.regexp_replace(c, r" {2,10}", " ")


def newlines_to_blank(c: Column) -> Column:
    """C15."""
    return F.translate(c, "\r\n", "  ")


# ---------------------------------------------------------------- composed


def _pattern_rules(c: Column) -> Column:
    c = remove_numbers(c)
    c = remove_underscores(c)
    c = colon_dot_to_blank(c)
    c = drop_single_letters(c)
    c = squeeze_letter_runs(c)
    return drop_doubled_starts(c)


def _tm_rules(c: Column) -> Column:
    return squish(remove_numbers(remove_punctuation(lower(c))))


def clean_train(c: Column) -> Column:
    """The training cleaner (C1, C2, C3, C4, C5, then C4, C6-C10)."""
    return _pattern_rules(_tm_rules(to_ascii(c)))


def clean_query(c: Column) -> Column:
    """C17: the query cleaner; same rules as C16, pattern rules first."""
    return _tm_rules(_pattern_rules(to_ascii(c)))


def clean_eval(c: Column, dataset: str = "tweets") -> Column:
    """Held-out line cleaner; blogs also drop ``...``."""
    c = remove_urls(lower(to_ascii(c)))
    if dataset == "blogs":
        c = remove_ellipsis(c)
    return squish(remove_numbers(punctuation_to_blank(c)))


def clean_eval_by(c: Column, dataset: Column) -> Column:
    """C18 with the dataset taken from a column (one projection for both)."""
    c = remove_urls(lower(to_ascii(c)))
    c = F.when(dataset == F.lit("blogs"), remove_ellipsis(c)).otherwise(c)
    return squish(remove_numbers(punctuation_to_blank(c)))


def tokens(c: Column) -> Column:
    """Blank-split tokens of an already cleaned text, empties dropped."""
    return F.filter(F.split(c, " "), lambda x: x != F.lit(""))


def clean_query_words(words: Column) -> Column:
    """C17 applied word by word to an already C18-cleaned word array.

    Every C17 rule is local to one blank-delimited word (its start needs a
    preceding blank, its end a following one), so cleaning each word with
    its own blanks gives the same tokens as cleaning any prefix of the
    line; each word becomes one token or ``''``.
    """
    return F.transform(words, lambda w, i: F.trim(clean_query(
        F.when(i == 0, F.concat(w, F.lit(" "))).otherwise(F.concat(F.lit(" "), w, F.lit(" "))))))
