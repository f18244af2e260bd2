"""DuckDB spellings of the text and hash expressions, for the oracle SQL.

Each helper returns an SQL expression string equal, row for row, to the Spark Column of the
same name in :mod:`wordloom.functions`. Patterns are the same strings the Spark side uses.
"""

from __future__ import annotations

from wordloom import constants as K
from wordloom.functions.text import MARKUP_PATTERN, WORD_TOKEN_PATTERN, rx_quote


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_markup(x: str) -> str:
    return f"regexp_replace({x}, {lit(MARKUP_PATTERN)}, '', 'g')"


def words_only(x: str) -> str:
    kept = f"list_filter(string_split(lower({x}), ' '), lambda t: regexp_matches(t, '[^\\x00-\\x20]'))"
    return f"regexp_replace(array_to_string({kept}, ' '), '[^\\w ]', '', 'g')"


def java_split(x: str, sep: str = " ") -> str:
    if len(sep) == 1:
        stripped = f"rtrim({x}, {lit(sep)})"
    else:
        stripped = f"regexp_replace({x}, {lit('(?:' + rx_quote(sep) + ')+' + chr(92) + 'z')}, '')"
    return (f"(CASE WHEN {x} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE string_split({stripped}, {lit(sep)}) END)")


def word_tokens(x: str) -> str:
    return f"regexp_extract_all(replace({x}, '#', ''), {lit(WORD_TOKEN_PATTERN)})"


def stopword_list() -> str:
    return "[" + ", ".join(lit(w.replace("\t", "\t")) for w in K.STOPWORDS) + "]"


def keep_token(t: str) -> str:
    return (f"(length({t}) > 2 AND NOT list_contains({stopword_list()}, {t}) "
            f"AND regexp_matches({t}, '^\\p{{L}}+$'))")


def filter_tokens(arr: str) -> str:
    return f"list_transform(list_filter({arr}, lambda t: {keep_token('t')}), lambda t: lower(t))"


def lemmatize(arr: str, lemmas: dict[str, str]) -> str:
    keys = "[" + ", ".join(lit(k) for k in sorted(lemmas)) + "]"
    vals = "[" + ", ".join(lit(lemmas[k]) for k in sorted(lemmas)) + "]"
    return (f"list_transform({arr}, lambda t: coalesce("
            f"{vals}[list_position({keys}, lower(t))], t))")


def clean_text(x: str, lemmas: dict[str, str] | None = None) -> str:
    toks = word_tokens(x)
    if lemmas:
        toks = lemmatize(toks, lemmas)
    return f"array_to_string({filter_tokens(toks)}, ' ')"


def md5_u32(x: str, part: int = 0) -> str:
    return f"('0x' || substr(md5(CAST({x} AS VARCHAR)), {8 * part + 1}, 8))::BIGINT"


def md5_bucket(x: str, n: int) -> str:
    return f"CAST({md5_u32(x)} % {n} AS INTEGER)"


def md5_unit(x: str, part: int) -> str:
    return f"({md5_u32(x, part)} / 4294967296.0)"


def r6(x: str) -> str:
    return f"round({x}, 6)"
