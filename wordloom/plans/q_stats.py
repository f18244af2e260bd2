"""Registered aggregation, label and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators import labels as L
from wordloom.operators import stats
from wordloom.operators.corpus import fold_column, split_column, word_records
from wordloom.plans import sqlparts as S
from wordloom.plans.catalog import register
from wordloom.session import table

WORDS_CTE = f"d AS (SELECT doc_id, lang AS label, {S.words_only(S.strip_markup('text'))} AS words FROM documents)"
SPLIT_SQL = f"CASE WHEN {S.md5_bucket('doc_id', 10)} < 7 THEN 'train' ELSE 'test' END"


@register("class_word_counts", f"""
WITH {WORDS_CTE},
t AS (SELECT label, unnest({S.java_split('words')}) AS w FROM d)
SELECT label, lower(w) AS word, count(*) AS n FROM t GROUP BY label, lower(w)
""")
def q_class_word_counts(spark, sf):
    return stats.class_word_counts(word_records(table(spark, sf, "documents")))


@register("class_token_totals", f"""
WITH {WORDS_CTE}
SELECT label, CAST(sum(len({S.java_split('words')})) AS BIGINT) AS n_tokens FROM d GROUP BY label
""")
def q_class_token_totals(spark, sf):
    return stats.class_token_totals(word_records(table(spark, sf, "documents")))


CLASS_WORD_PROB_SQL = f"""
WITH {WORDS_CTE},
t AS (SELECT label, unnest({S.java_split('words')}) AS w FROM d),
c AS (SELECT label, lower(w) AS word, count(*) AS n FROM t GROUP BY label, lower(w)),
tot AS (SELECT label, sum(n) AS n_tokens FROM c GROUP BY label)
SELECT c.label, c.word, c.n, round((c.n + 1) / (tot.n_tokens + {K.WCP_VOCABULARY_SIZE}), 6) AS prob
FROM c JOIN tot USING (label)
"""


@register("class_word_prob", CLASS_WORD_PROB_SQL)
def q_class_word_prob(spark, sf):
    return stats.class_word_prob(word_records(table(spark, sf, "documents")))


@register("num_classes", """
SELECT count(DISTINCT l.quality) AS num_classes, CAST(count_if(l.quality IS NULL) AS BIGINT) AS n_unlabelled
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def q_num_classes(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return stats.num_classes(d.join(lab, "doc_id", "left"))


@register("corpus_stats", f"""
WITH u AS (SELECT lang AS label, CASE WHEN {SPLIT_SQL} = 'train' THEN 1 ELSE 0 END AS tr,
                  CASE WHEN {SPLIT_SQL} = 'test' THEN 1 ELSE 0 END AS te FROM documents),
pc AS (SELECT label, count(*) AS n, sum(tr) AS tr, sum(te) AS te FROM u GROUP BY label),
lab AS (SELECT * FROM pc WHERE label IS NOT NULL),
mn AS (SELECT min(n) AS m FROM lab)
SELECT CAST((SELECT sum(tr) FROM pc) AS BIGINT) AS train_rows,
       CAST((SELECT sum(te) FROM pc) AS BIGINT) AS test_rows,
       CAST((SELECT count(*) FROM lab) AS BIGINT) AS num_classes,
       (SELECT m FROM mn) AS min_class_size,
       (SELECT count(*) FROM lab WHERE n = (SELECT m FROM mn)) AS n_min_classes,
       (SELECT max(n) FROM lab) AS max_class_size,
       CAST(coalesce((SELECT sum(n) FROM pc WHERE label IS NULL), 0) AS BIGINT) AS n_unlabelled
""")
def q_corpus_stats(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))
    d = d.withColumn("split", split_column("doc_id"))
    return stats.corpus_stats(d.where(F.col("split") == "train"), d.where(F.col("split") == "test"))


@register("class_size_histogram", """
WITH sz AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang),
h AS (SELECT n AS class_size, count(*) AS n_classes FROM sz GROUP BY n),
g AS (SELECT range AS class_size FROM range(1, (SELECT max(n) FROM sz) + 1))
SELECT g.class_size, CAST(coalesce(h.n_classes, 0) AS BIGINT) AS n_classes
FROM g LEFT JOIN h USING (class_size)
""")
def q_class_size_histogram(spark, sf):
    d = table(spark, sf, "documents").select(F.col("lang").alias("label"))
    return stats.class_size_histogram(spark, d)


@register("hash_split", f"""
SELECT doc_id, {SPLIT_SQL} AS split FROM documents
""")
def q_hash_split(spark, sf):
    return table(spark, sf, "documents").select("doc_id", split_column("doc_id").alias("split"))


@register("kfold_assign", f"""
SELECT doc_id, {S.md5_bucket('doc_id', 5)} AS fold FROM documents
""")
def q_kfold_assign(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fold_column("doc_id", 5).alias("fold"))


@register("label_index", f"""
WITH s AS (SELECT doc_id, source AS raw_label, {SPLIT_SQL} AS split FROM documents),
firsts AS (SELECT raw_label, min(CASE WHEN split = 'train' THEN 0 ELSE 1 END) AS first_split
           FROM s GROUP BY raw_label),
dict AS (SELECT raw_label, CAST(row_number() OVER (ORDER BY first_split, raw_label) - 1 AS DOUBLE) AS label
         FROM firsts)
SELECT s.doc_id, s.raw_label, s.split, dict.label FROM s JOIN dict USING (raw_label)
""")
def q_label_index(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("source").alias("raw_label"),
                                             split_column("doc_id").alias("split"))
    dictionary = L.label_dictionary(d, "raw_label", "split", ["train", "test"])
    return L.apply_label_dictionary(d, dictionary, "raw_label").select("doc_id", "raw_label", "split", "label")


@register("assign_ids", """
SELECT CAST(row_number() OVER (ORDER BY source, doc_id) AS BIGINT) AS row_id, doc_id,
       sha256(source || '|' || CAST(doc_id AS VARCHAR)) AS uid
FROM documents
""")
def q_assign_ids(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    out = L.global_row_number(spark, d, ["source", "doc_id"], "row_id")
    return out.select("row_id", "doc_id", L.stable_id("source", "doc_id").alias("uid"))


@register("remap_labels", """
SELECT vec_id, CAST(label AS DOUBLE) AS label,
       CASE WHEN label = 0 THEN 9.0::DOUBLE ELSE CAST(label AS DOUBLE) END AS new_label
FROM embeddings
""")
def q_remap_labels(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"))
    return L.remap_labels(spark, e, {0.0: 9.0}, out="new_label")


_names_sql = ", ".join(f"({k}::DOUBLE, {S.lit(v)})" for k, v in K.LABEL_NAMES.items())


@register("label_names", f"""
SELECT e.vec_id, CAST(e.label AS DOUBLE) AS label, coalesce(n.name, {S.lit(K.DEFAULT_LABEL_NAME)}) AS label_name
FROM embeddings e LEFT JOIN (VALUES {_names_sql}) AS n(num, name) ON CAST(e.label AS DOUBLE) = n.num
""")
def q_label_names(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"))
    return L.label_names(spark, e, "label", "label_name")


@register("batch_counts", f"""
WITH k AS (SELECT row_number() OVER (ORDER BY source || '-' || CAST(doc_id AS VARCHAR)) AS idx FROM documents)
SELECT CAST((idx - 1) // {K.DEFAULT_BATCH_ROWS} AS BIGINT) AS batch_id, count(*) AS n_rows,
       CAST(max(idx) AS BIGINT) AS running_total
FROM k GROUP BY 1
""")
def q_batch_counts(spark, sf):
    d = table(spark, sf, "documents").select(F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("row_key"))
    return L.batch_counts(spark, d, ["row_key"], K.DEFAULT_BATCH_ROWS)


@register("first_n", f"""
SELECT doc_id, lang AS label, {S.words_only(S.strip_markup('text'))} AS words FROM documents ORDER BY doc_id LIMIT 5
""")
def q_first_n(spark, sf):
    """The first five records by an explicit order (a take-ordered, not a sort)."""
    return word_records(table(spark, sf, "documents")).orderBy("doc_id").limit(5)
