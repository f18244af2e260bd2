"""Registered feature, pattern and similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators import features as FT
from wordloom.operators import patterns as P
from wordloom.operators.common import materialize
from wordloom.operators.corpus import split_column, word_records
from wordloom.plans import sqlparts as S
from wordloom.plans.catalog import register
from wordloom.session import table

WORDS_CTE = f"d AS (SELECT doc_id, lang AS label, {S.words_only(S.strip_markup('text'))} AS words FROM documents)"
TOKS_CTE = f"t AS (SELECT doc_id, unnest({S.java_split('words')}) AS w FROM d)"
FP_SUPPORT = 0.01  # the fixed 0.3 finds nothing in brand baskets; support is a parameter
PATTERNS = [["the", "and"], ["le", "la"], ["der", "und"], ["que", "de"], ["the", "of", "and"],
            ["issac", "hurricane"], ["es", "el", "la"]]
TOPK = 5


def _docs(spark, sf):
    return word_records(table(spark, sf, "documents"))


@register("hash_tf", f"""
WITH {WORDS_CTE}, {TOKS_CTE}
SELECT doc_id, {S.md5_bucket('w', K.HASH_TF_BUCKETS)} AS bucket, count(*) AS tf FROM t GROUP BY 1, 2
""")
def q_hash_tf(spark, sf):
    return FT.hash_tf(_docs(spark, sf))


@register("char_tf", f"""
WITH {WORDS_CTE}, c AS (SELECT doc_id, unnest(string_split(words, '')) AS ch FROM d)
SELECT doc_id, {S.md5_bucket('ch', K.CHAR_TF_BUCKETS)} AS bucket, count(*) AS tf FROM c
WHERE length(ch) = 1 GROUP BY 1, 2
""")
def q_char_tf(spark, sf):
    return FT.char_tf(_docs(spark, sf))


IDF_SQL_CTE = f"""{WORDS_CTE}, {TOKS_CTE},
tf AS (SELECT doc_id, {S.md5_bucket('w', K.HASH_TF_BUCKETS)} AS bucket, count(*) AS tf FROM t GROUP BY 1, 2),
m AS (SELECT count(*) AS m FROM d),
idf AS (SELECT bucket, count(*) AS df, ln(((SELECT m FROM m) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY bucket)"""


def _tf_idf(spark, sf):
    d = _docs(spark, sf)
    tf = FT.hash_tf(d)
    n_docs = d.count()
    return tf, FT.idf_weights(tf, n_docs)


@register("idf_weights", f"""
WITH {IDF_SQL_CTE}
SELECT bucket, df, round(idf, 6) AS idf FROM idf
""")
def q_idf_weights(spark, sf):
    _, idf = _tf_idf(spark, sf)
    return idf.select("bucket", "df", F.round("idf", 6).alias("idf"))


@register("tfidf", f"""
WITH {IDF_SQL_CTE}
SELECT tf.doc_id, tf.bucket, tf.tf, round(tf.tf * idf.idf, 6) AS tfidf FROM tf JOIN idf USING (bucket)
""")
def q_tfidf(spark, sf):
    tf, idf = _tf_idf(spark, sf)
    out = FT.tfidf(tf, idf, K.HASH_TF_BUCKETS)
    return out.select("doc_id", "bucket", "tf", F.round("tfidf", 6).alias("tfidf"))


DOCVEC_SQL_CTE = f"""{WORDS_CTE}, {TOKS_CTE},
vocab AS (SELECT w AS word FROM t GROUP BY w HAVING count(*) >= {K.W2V_MIN_COUNT}),
dt AS (SELECT doc_id, w AS word, count(*) AS k FROM t GROUP BY 1, 2),
dv AS (SELECT dt.doc_id,
  sum(dt.k * {S.md5_unit('dt.word', 0)}) / sum(dt.k) AS v0, sum(dt.k * {S.md5_unit('dt.word', 1)}) / sum(dt.k) AS v1,
  sum(dt.k * {S.md5_unit('dt.word', 2)}) / sum(dt.k) AS v2, sum(dt.k * {S.md5_unit('dt.word', 3)}) / sum(dt.k) AS v3
  FROM dt JOIN vocab USING (word) GROUP BY dt.doc_id)"""


def _doc_vectors(spark, sf):
    d = _docs(spark, sf)
    vecs, n = materialize(FT.md5_word_vectors(d))
    vec = FT.doc_vector_mean(d, vecs, n_vectors=n, dim=4)
    return vec.select("doc_id", *[F.round(F.col("features")[i], 6).alias(f"v{i}") for i in range(4)])


@register("doc_vector_avg", f"""
WITH {DOCVEC_SQL_CTE}
SELECT doc_id, round(v0, 6) AS v0, round(v1, 6) AS v1, round(v2, 6) AS v2, round(v3, 6) AS v3 FROM dv
""")
def q_doc_vector_avg(spark, sf):
    return _doc_vectors(spark, sf)


@register("feature_join", f"""
WITH {DOCVEC_SQL_CTE}
SELECT dv.doc_id, CAST(l.quality AS DOUBLE) AS label,
       round(v0, 6) AS v0, round(v1, 6) AS v1, round(v2, 6) AS v2, round(v3, 6) AS v3
FROM dv JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL
""")
def q_feature_join(spark, sf):
    """J1 + F10: features joined to labelled records on id (many-to-many as an inner join);
    rows without a label are filtered instead of failing."""
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    out = FT.join_features(_doc_vectors(spark, sf), lab)
    return out.select("doc_id", "label", "v0", "v1", "v2", "v3")


@register("pad_array", f"""
WITH p AS (SELECT vec_id, CASE WHEN len(embedding) > {K.PAD_LENGTH} THEN NULL ELSE
             list_concat(CAST(embedding AS DOUBLE[]), list_transform(range({K.PAD_LENGTH} - len(embedding)), lambda i: 0.0::DOUBLE)) END AS arr
           FROM embeddings)
SELECT vec_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, round(unnest(arr), 6) AS value FROM p
""")
def q_pad_array(spark, sf):
    e = FT.pad_features(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding")
    return (e.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
            .select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value")))


SPLIT_SQL = f"CASE WHEN {S.md5_bucket('doc_id', 10)} < 7 THEN 'train' ELSE 'test' END"

WCP_SQL_CTE = f"""{WORDS_CTE},
tr AS (SELECT * FROM d WHERE {SPLIT_SQL} = 'train'),
cw AS (SELECT label, lower(w) AS word, count(*) AS n FROM (SELECT label, unnest({S.java_split('words')}) AS w FROM tr) GROUP BY 1, 2),
tot AS (SELECT label, sum(n) AS T FROM cw GROUP BY label),
dl AS (SELECT doc_id, len({S.java_split('words')}) AS L FROM d),
tk AS (SELECT doc_id, lower(w) AS word, count(*) AS k FROM t GROUP BY 1, 2),
seen AS (SELECT tk.doc_id, cw.label, sum(tk.k * ln(1 + cw.n)) AS s FROM tk JOIN cw USING (word) GROUP BY 1, 2),
sc AS (SELECT dl.doc_id, tot.label, -dl.L * ln({K.WCP_VOCABULARY_SIZE} + tot.T) + coalesce(seen.s, 0.0) AS score
       FROM dl CROSS JOIN tot LEFT JOIN seen ON seen.doc_id = dl.doc_id AND seen.label = tot.label)"""


def _wcp_scores(spark, sf):
    d = _docs(spark, sf)
    train = d.where(split_column("doc_id") == "train")
    return FT.score_wcp(FT.fit_wcp(train), d)


@register("wcp_features", f"""
WITH {WCP_SQL_CTE.replace(WORDS_CTE + ',', WORDS_CTE + ', ' + TOKS_CTE + ',', 1)}
SELECT doc_id, label, round(score, 4) AS score FROM sc
""")
def q_wcp_features(spark, sf):
    """Scores are sums of hundreds of logs (magnitude ~1e3) added in engine-specific order;
    4 decimals (8 significant digits) keeps the comparison independent of that order."""
    return _wcp_scores(spark, sf).select("doc_id", "label", F.round("score", 4).alias("score"))


ITEMSETS_SQL = f"""WITH RECURSIVE b AS (SELECT DISTINCT l.l_orderkey, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
mc AS (SELECT ceil(CAST({FP_SUPPORT} AS DOUBLE) * count(DISTINCT l_orderkey)) AS mc FROM b),
s AS (
  SELECT l_orderkey, p_brand AS items, p_brand AS last, 1 AS n FROM b
  QUALIFY count(*) OVER (PARTITION BY p_brand) >= (SELECT mc FROM mc)
  UNION ALL
  SELECT s.l_orderkey, s.items || ' ' || b.p_brand, b.p_brand, s.n + 1
  FROM s JOIN b ON b.l_orderkey = s.l_orderkey AND b.p_brand > s.last
  QUALIFY count(*) OVER (PARTITION BY s.items || ' ' || b.p_brand) >= (SELECT mc FROM mc))
"""


@register("frequent_itemsets", f"""
{ITEMSETS_SQL}SELECT items, CAST(n AS BIGINT) AS n_items, count(*) AS freq FROM s GROUP BY 1, 2
""")
def q_frequent_itemsets(spark, sf):
    """FP-growth over order baskets; item sets of every size."""
    # Baskets are written once: FP-growth reads them for item counts and again, lazily, when
    # its item sets are computed (it releases its own cached copy after fit).
    b = P.baskets(table(spark, sf, "lineitem"), table(spark, sf, "part")).checkpoint(eager=True)
    fi = P.frequent_itemsets(b, "items", FP_SUPPORT)
    return fi.select(F.array_join("items", " ").alias("items"), F.size("items").cast("bigint").alias("n_items"), "freq")


@register("itemset_flags", f"""
{ITEMSETS_SQL}SELECT l_orderkey AS doc_id, items AS pattern_id, 1.0::DOUBLE AS flag FROM s
""")
def q_itemset_flags(spark, sf):
    """F12 on F11: which orders hold which of the mined item sets."""
    b = P.baskets(table(spark, sf, "lineitem"), table(spark, sf, "part")).checkpoint(eager=True)
    sets = P.frequent_itemsets(b, "items", FP_SUPPORT).select(F.array_join("items", " ").alias("pattern_id"), "items")
    return P.pattern_flags(b, "items", sets, "l_orderkey")


_pat_sql = ", ".join(f"({i}, {S.lit(w)})" for i, p in enumerate(PATTERNS) for w in p)


@register("pattern_flags", f"""
WITH {WORDS_CTE},
dt AS (SELECT doc_id, unnest(list_distinct({S.java_split('words')})) AS token FROM d),
p AS (SELECT * FROM (VALUES {_pat_sql}) AS p(pattern_id, token)),
pn AS (SELECT pattern_id, count(DISTINCT token) AS n FROM p GROUP BY 1)
SELECT dt.doc_id, CAST(p.pattern_id AS BIGINT) AS pattern_id, 1.0::DOUBLE AS flag
FROM dt JOIN p USING (token) JOIN pn USING (pattern_id)
GROUP BY dt.doc_id, p.pattern_id, pn.n HAVING count(*) = pn.n
""")
def q_pattern_flags(spark, sf):
    pats = spark.createDataFrame([(i, p) for i, p in enumerate(PATTERNS)], "pattern_id bigint, items array<string>")
    d = _docs(spark, sf).select("doc_id", FT.tokens("words").alias("toks"))
    return P.pattern_flags(d, "toks", pats)


@register("similar_topk", f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM e),
c AS (SELECT label, list(m ORDER BY i) AS q FROM (SELECT label, i, avg(v) AS m FROM u GROUP BY 1, 2) GROUP BY label),
s AS (SELECT c.label, e.vec_id,
        list_dot_product(e.x, c.q) / (sqrt(list_dot_product(e.x, e.x)) * sqrt(list_dot_product(c.q, c.q))) AS cosine
      FROM e CROSS JOIN c),
r AS (SELECT label, vec_id, cosine, row_number() OVER (PARTITION BY label ORDER BY cosine DESC, vec_id) AS rank FROM s)
SELECT label, CAST(rank AS BIGINT) AS rank, vec_id, round(cosine, 6) AS cosine FROM r WHERE rank <= {TOPK}
""")
def q_similar_topk(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    cents = FT.label_centroids(e).select("label", F.col("centroid").alias("query"))
    out = FT.similar_topk(e, cents, TOPK)
    return out.select("label", "rank", "vec_id", F.round("cosine", 6).alias("cosine"))
