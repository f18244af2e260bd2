"""Registered text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.functions import text as T
from wordloom.operators import cleaning
from wordloom.operators.corpus import word_records
from wordloom.plans import sqlparts as S
from wordloom.plans.catalog import register
from wordloom.session import table

FLAG_WORDS = K.KEYWORDS + ("the", "les", "und", "que")


def _lemma_values() -> str:
    rows = ", ".join(f"({S.lit(k)}, {S.lit(v)})" for k, v in sorted(cleaning.DEFAULT_LEMMAS.items()))
    return f"(VALUES {rows}) AS lem(surface, lemma)"


@register("strip_markup", f"""
SELECT page_id, {S.strip_markup('html')} AS text FROM pages
""")
def q_strip_markup(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.strip_markup("html").alias("text"))


@register("words_only", f"""
SELECT doc_id, lang AS label, {S.words_only(S.strip_markup('text'))} AS words FROM documents
""")
def q_words_only(spark, sf):
    return word_records(table(spark, sf, "documents"))


@register("tokens", f"""
WITH d AS (SELECT doc_id, {S.words_only(S.strip_markup('text'))} AS words FROM documents),
s AS (SELECT doc_id, {S.java_split('words')} AS arr FROM d)
SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, unnest(arr) AS token FROM s
""")
def q_tokens(spark, sf):
    d = word_records(table(spark, sf, "documents"))
    return (d.select("doc_id", F.posexplode(T.tokens("words")).alias("pos", "token"))
            .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token"))


@register("token_filter", f"""
WITH s AS (SELECT doc_id, {S.word_tokens('text')} AS arr FROM documents),
e AS (SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, unnest(arr) AS token FROM s)
SELECT doc_id, pos, lower(token) AS token FROM e WHERE {S.keep_token('token')}
""")
def q_token_filter(spark, sf):
    """T4 + T6 (+S6 stopwords) in long form: kept tokens with their original position."""
    rows = cleaning.token_rows(table(spark, sf, "documents"))
    return (rows.where(T.keep_token(F.col("token")))
            .select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.lower("token").alias("token")))


@register("lemma_join", f"""
WITH s AS (SELECT doc_id, {S.word_tokens('text')} AS arr FROM documents),
e AS (SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, unnest(arr) AS token FROM s)
SELECT e.doc_id, e.pos, e.token, coalesce(lem.lemma, e.token) AS lemma
FROM e LEFT JOIN {_lemma_values()} ON lower(e.token) = lem.surface
""")
def q_lemma_join(spark, sf):
    rows = cleaning.token_rows(table(spark, sf, "documents"))
    out = cleaning.lemma_join(rows, cleaning.lemma_table(spark))
    return out.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token", "lemma")


@register("clean_text", f"""
SELECT doc_id, lang AS label, {S.clean_text('text', cleaning.DEFAULT_LEMMAS)} AS clean FROM documents
""")
def q_clean_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"), "text")
    return cleaning.clean_records(d).select("doc_id", "label", "clean")


_flag_sql = ", ".join(f"CASE WHEN contains(text, {S.lit(k)}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS kw_{k}"
                      for k in FLAG_WORDS)


@register("keyword_flags", f"""
SELECT doc_id, {_flag_sql} FROM documents
""")
def q_keyword_flags(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *T.keyword_flags("text", FLAG_WORDS))
