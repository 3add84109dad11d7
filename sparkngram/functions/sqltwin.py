"""DuckDB SQL twins of the cleaning rules, used only by the SQL oracle.

DuckDB's regex engine (RE2) has no back-references, so rules C8-C10 are
written out letter by letter; the letter list is generated, not typed.
"""

from __future__ import annotations

import string

_LOWER = string.ascii_lowercase
_LETTERS = string.ascii_lowercase + string.ascii_uppercase
_SPACE = "[[:space:]]"


def rx(expr: str, pattern: str, repl: str = "") -> str:
    p = pattern.replace("'", "''")
    r = repl.replace("'", "''")
    return f"regexp_replace({expr}, '{p}', '{r}', 'g')"


def to_ascii(e):
    return rx(e, "[^\\x00-\\x7F]")


def remove_punctuation(e):
    return rx(e, "[[:punct:]]+")


def remove_numbers(e):
    return rx(e, "[0-9]+")


def squish(e):
    return f"trim({rx(e, _SPACE + '+', ' ')})"


def drop_single_letters(e):
    alts = "|".join(f"{ch}+" for ch in _LOWER if ch not in "ai")
    return rx(e, f"{_SPACE}({alts})\\b", " ")


def squeeze_letter_runs(e):
    for ch in _LETTERS:
        e = rx(e, f"{ch}{{3,}}", ch)
    return e


def drop_doubled_starts(e):
    alts = "|".join(f"{ch}{{2,3}}" for ch in _LOWER)
    return rx(e, f"{_SPACE}({alts})('(s|ve|d|re))?", " ")


def _pattern_rules(e):
    e = remove_numbers(e)
    e = rx(e, "_+")
    e = rx(rx(e, ":", " "), "\\.", " ")
    e = drop_single_letters(e)
    e = squeeze_letter_runs(e)
    return drop_doubled_starts(e)


def _tm_rules(e):
    return squish(remove_numbers(remove_punctuation(f"lower({e})")))


def clean_train(e):
    return _pattern_rules(_tm_rules(to_ascii(e)))


def clean_query(e):
    return _tm_rules(_pattern_rules(to_ascii(e)))


def clean_eval_by(e, dataset_expr):
    e = rx(f"lower({to_ascii(e)})", "(?s)http(s)?:.*\\b")
    e = f"CASE WHEN {dataset_expr} = 'blogs' THEN {rx(e, '[.][.][.]')} ELSE {e} END"
    return squish(remove_numbers(rx(e, "[[:punct:]]", " ")))


def tokens(e):
    return f"list_filter(string_split({e}, ' '), lambda x: x <> '')"
