"""Text scalars as native Column expressions (no Python UDFs).

Java/Scala string semantics the original job relies on are reproduced exactly:

* ``String.split(regex)`` keeps inner and leading empty parts, drops trailing empty parts,
  maps ``""`` to ``[""]`` and a string made only of separators to ``[]``. Spark's ``split``
  keeps trailing empties, so :func:`java_split` strips trailing separators first.
* ``String.trim`` strips every char <= U+0020; Spark's ``trim`` strips blanks only.
* ``\\W`` / ``\\w`` are the ASCII classes (Java regex without UNICODE_CHARACTER_CLASS).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom import constants as K

# Java's String.trim() strips every char in U+0000..U+0020.
_JAVA_WS = "".join(chr(i) for i in range(0x21))

# Line terminators for Java's '.', and Java's \s, written out so every engine reads the same
# classes.
_LT = r"\n\r\x{85}\x{2028}\x{2029}"
_NOT_GT = f"[^>{_LT}]"
# Equivalent of constants.MARKUP_PATTERN_JAVA without look-around: '<' + c + '>' where c holds
# no '>' or line terminator and c is not an anchor ("a", "/a", or "a"/"/a" + blank + rest).
MARKUP_PATTERN = (
    "<(?:/?(?:"
    f"[^a/>{_LT}]{_NOT_GT}*"
    f"|a[^> \\t\\x0B\\f{_LT}]{_NOT_GT}*"
    f")?|//{_NOT_GT}*)>"
)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """``String.trim``: strip all chars <= U+0020 at both ends."""
    return F.trim(col_(c), F.lit(_JAVA_WS))


def rx_quote(s: str) -> str:
    """Escape regex metacharacters (same result in Java regex and RE2)."""
    return "".join("\\" + ch if ch in "\\^$.|?*+()[]{}" else ch for ch in s)


def java_split(c, sep: str = " ") -> Column:
    """``String.split(quote(sep))`` with Java's treatment of empty parts."""
    c = col_(c)
    q = rx_quote(sep)
    if len(sep) == 1:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, f"(?:{q})+\\z", "")   # \z: Java's $ also matches before a final newline
    return (F.when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, q)))


def strip_markup(c, java_pattern: bool = False) -> Column:
    """Remove every markup tag except ``<a>``, ``</a>`` and ``<a ...>``.

    The default uses the look-around-free form of the fixed Java pattern (same matches, no
    backtracking into the rest of the line); ``java_pattern=True`` runs the fixed pattern.
    """
    return F.regexp_replace(col_(c), K.MARKUP_PATTERN_JAVA if java_pattern else MARKUP_PATTERN, "")


def words_only(c) -> Column:
    """Split on one space, trim, lower-case, drop empty, delete ``\\W``, join with a space.

    Computed on the whole string with code-generated regex/trim passes instead of a per-token
    lambda: a token is dropped when it is blank (only chars <= U+0020, i.e. empty after Java
    trim), so blank tokens are deleted, the separators they leave are collapsed and trimmed,
    and only then ``[^\\w ]`` is deleted -- a token such as ``--`` therefore still leaves an
    empty word (a double space). :func:`words_only_split` is the literal split/filter form.
    """
    no_blank = F.regexp_replace(F.lower(col_(c)), r"(?<=\A| )[\x00-\x1F]+(?= |\z)", "")
    joined = F.trim(F.regexp_replace(no_blank, " {2,}", " "), F.lit(" "))
    return F.regexp_replace(joined, r"[^\w ]", "")


def words_only_split(c) -> Column:
    """T2 written as the per-token rule (split, keep non-blank, join, delete ``\\W``)."""
    toks = F.split(F.lower(col_(c)), " ")
    kept = F.filter(toks, lambda t: t.rlike(r"[^\x00-\x20]"))
    return F.regexp_replace(F.array_join(kept, " "), r"[^\w ]", "")


def tokens(c) -> Column:
    """``text.split(" ")`` (Java semantics)."""
    return java_split(c, " ")


def drop_hash(c) -> Column:
    """T4: delete ``#`` characters."""
    return F.translate(col_(c), "#", "")


# Word tokenizer standing in for the NLP pipeline (T5): maximal runs of characters that are
# neither blank nor punctuation nor symbol. Classes are spelled out so Spark and DuckDB agree.
WORD_TOKEN_PATTERN = r"[^\t\n\x0B\f\r \p{P}\p{S}]+"


def word_tokens(c) -> Column:
    return F.regexp_extract_all(col_(c), F.lit(WORD_TOKEN_PATTERN), 0)


def keep_token(t: Column, stopwords=K.STOPWORDS) -> Column:
    """T6 predicate: length > 2, not a stopword (tested before lower-casing), letters only."""
    return (F.length(t) > 2) & ~t.isin(list(stopwords)) & t.rlike(r"\A\p{L}+\z")


def filter_tokens(arr, stopwords=K.STOPWORDS) -> Column:
    """T6 on an array column: keep, then lower-case."""
    return F.transform(F.filter(col_(arr), lambda t: keep_token(t, stopwords)), F.lower)


def lemmatize(arr, lemmas: dict[str, str]) -> Column:
    """T5 for a small literal dictionary: ``lower(token) -> lemma``, token kept when absent.

    For a dictionary held in a table use :func:`wordloom.operators.cleaning.lemma_join`.
    """
    if not lemmas:
        return col_(arr)
    m = F.create_map(*[x for kv in sorted(lemmas.items()) for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.transform(col_(arr), lambda t: F.coalesce(F.try_element_at(m, F.lower(t)), t))


def clean_text(c, lemmas: dict[str, str] | None = None, stopwords=K.STOPWORDS) -> Column:
    """T8 = T4 -> T5 -> T6 -> T7 on one text column."""
    toks = word_tokens(drop_hash(c))
    if lemmas:
        toks = lemmatize(toks, lemmas)
    return F.array_join(filter_tokens(toks, stopwords), " ")


def keyword_flags(c, keywords=K.KEYWORDS) -> list[Column]:
    """1.0 when the text contains the keyword, else 0.0 (one column per keyword)."""
    return [F.when(F.contains(col_(c), F.lit(k)), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"kw_{k}")
            for k in keywords]
