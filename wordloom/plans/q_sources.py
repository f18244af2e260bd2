"""Registered source/sink queries.

The driver's tables are single Parquet files, not delimited text, so each reader is fed a
line column built from a table (the same line a text file would hold) and run through the
same parser ``read.text`` feeds; tests cover the file path.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom.operators.cleaning import DEFAULT_LEMMAS
from wordloom.functions.text import clean_text
from wordloom.sources import delimited as D
from wordloom.plans import sqlparts as S
from wordloom.plans.catalog import register
from wordloom.session import scratch_path, table


def _labelled_docs(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id")


@register("read_pipe2", f"""
WITH l AS (SELECT d.doc_id, CAST(l.quality AS VARCHAR) || '|' || d.text AS line
           FROM documents d JOIN labels l USING (doc_id)),
p AS (SELECT doc_id, {S.java_split('line', '|')} AS parts FROM l)
SELECT CAST(doc_id AS VARCHAR) AS id, parts[2] AS text, TRY_CAST(parts[1] AS DOUBLE) AS label
FROM p WHERE len(parts) = 2 AND TRY_CAST(parts[1] AS DOUBLE) IS NOT NULL
""")
def q_read_pipe2(spark, sf):
    lines = _labelled_docs(spark, sf).select(
        "doc_id", F.concat(F.col("quality").cast("string"), F.lit("|"), "text").alias("line"))
    return D.good(D.parse_label_text(lines, "line", "|", id_col="doc_id"))


@register("read_pipe3", f"""
WITH l AS (SELECT CAST(l.quality AS VARCHAR) || '|' || CAST(d.doc_id AS VARCHAR) || '|' || d.text AS line
           FROM documents d JOIN labels l USING (doc_id)),
p AS (SELECT {S.java_split('line', '|')} AS parts FROM l)
SELECT parts[2] AS id, parts[3] AS text, TRY_CAST(parts[1] AS DOUBLE) AS label
FROM p WHERE len(parts) >= 3 AND TRY_CAST(parts[1] AS DOUBLE) IS NOT NULL
""")
def q_read_pipe3(spark, sf):
    lines = _labelled_docs(spark, sf).select(
        F.concat_ws("|", F.col("quality").cast("string"), F.col("doc_id").cast("string"), "text").alias("line"))
    return D.good(D.parse_label_id_text(lines, "line"))


_MIXED_LINE_SQL = """CASE WHEN lang = 'en' THEN source || '; ' || CAST(doc_id AS VARCHAR) || '; ' || text
                         ELSE source || '|' || text END"""


@register("read_mixed", f"""
WITH l AS (SELECT doc_id, {_MIXED_LINE_SQL} AS line FROM documents),
p AS (SELECT doc_id, {S.java_split('line', '; ')} AS sp, {S.java_split('line', '|')} AS pp FROM l)
SELECT sp[1] AS raw_label, sp[2] AS id, sp[3] AS text, 'semi' AS fmt FROM p WHERE len(sp) = 3
UNION ALL
SELECT pp[1] AS raw_label, CAST(doc_id AS VARCHAR) AS id, pp[2] AS text, 'pipe' AS fmt FROM p
WHERE len(pp) = 2 AND len(sp) <> 3
""")
def q_read_mixed(spark, sf):
    d = table(spark, sf, "documents")
    line = F.when(F.col("lang") == "en",
                  F.concat_ws("; ", "source", F.col("doc_id").cast("string"), "text")) \
        .otherwise(F.concat_ws("|", "source", "text"))
    return D.good(D.parse_mixed(d.select("doc_id", line.alias("line")), "line", id_col="doc_id"))


@register("read_key_text", """
WITH l AS (SELECT source || ';' || text AS line FROM documents)
SELECT split_part(line, ';', 1) AS key, substr(line, length(split_part(line, ';', 1)) + 2) AS text FROM l
WHERE contains(line, ';')
""")
def q_read_key_text(spark, sf):
    d = table(spark, sf, "documents").select(F.concat_ws(";", "source", "text").alias("line"))
    return D.good(D.parse_key_text(d, "line"))


@register("transactions", """
WITH b AS (SELECT l.l_orderkey, p.p_brand, min(l.l_linenumber) AS first_line
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2),
o AS (SELECT l_orderkey, string_agg(p_brand, ' ' ORDER BY first_line, p_brand) AS items, count(*) AS n_items
      FROM b GROUP BY l_orderkey)
SELECT l_orderkey, items, n_items FROM o
""")
def q_transactions(spark, sf):
    from wordloom.operators.patterns import baskets
    b = baskets(table(spark, sf, "lineitem"), table(spark, sf, "part"))
    return b.select("l_orderkey", F.array_join("items", " ").alias("items"),
                    F.size("items").cast("bigint").alias("n_items"))


@register("write_key_cleaned", f"""
SELECT source || '-' || CAST(doc_id AS VARCHAR) || ';' || {S.clean_text('text', DEFAULT_LEMMAS)} AS line
FROM documents
""")
def q_write_key_cleaned(spark, sf):
    d = table(spark, sf, "documents").select(
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("key"),
        clean_text(F.col("text"), DEFAULT_LEMMAS).alias("clean"))
    path = scratch_path(spark, "key-cleaned")
    D.write_key_lines(d, path)
    return spark.read.text(path).select(F.col("value").alias("line"))
