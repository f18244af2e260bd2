"""Registered scoring and metric queries.

Test model: class weights = per-label mean of ``embeddings.embedding`` (classes 0..9). This
gives a prediction table with an exact SQL check that feeds the reject option, the error
filters and every metric.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators import features as FT
from wordloom.operators import metrics as M
from wordloom.operators import scoring as SC
from wordloom.plans.catalog import register
from wordloom.session import table

T = K.REJECT_THRESHOLD
#: P8 at the reject threshold finds no row here (a best class scores 0.45 at least); above it the filter has rows to compare.
UNSURE = 0.49


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), "embedding")


def _model(spark, sf):
    e = _embeddings(spark, sf)
    cents = FT.label_centroids(e.select("label", "embedding"))
    return SC.linear_model(cents.select(F.col("label").alias("class"), F.col("centroid").alias("weights")))


def _legacy(spark, sf):
    return SC.legacy_scores(_embeddings(spark, sf), _model(spark, sf), "embedding", T)


# Oracle building blocks: centroids, margins, running maximum as a window.
_BASE = f"""
e AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM e),
c AS (SELECT label AS cls, list(m ORDER BY i) AS q FROM (SELECT label, i, avg(v) AS m FROM u GROUP BY 1, 2) GROUP BY label),
kk AS (SELECT count(*) AS k FROM c),
mg AS (SELECT e.vec_id, e.label, c.cls, list_dot_product(e.x, c.q) AS margin FROM e, c WHERE c.cls >= 1),
rm AS (SELECT *, greatest(0.0, max(margin) OVER (PARTITION BY vec_id ORDER BY cls
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS runmax FROM mg),
raw AS (SELECT vec_id, label, cls, 1.0 / (1.0 + exp(-(margin - runmax))) AS r FROM rm
        UNION ALL SELECT vec_id, label, 0.0 AS cls, 0.0 AS r FROM e),
tot AS (SELECT vec_id, sum(r) AS s FROM raw GROUP BY vec_id),
sc AS (SELECT raw.vec_id, raw.label, raw.cls,
              CASE WHEN raw.cls < (SELECT k FROM kk) - 1 THEN raw.r / tot.s ELSE raw.r END AS score
       FROM raw JOIN tot USING (vec_id)),
top AS (SELECT vec_id, max(margin) AS mx FROM mg GROUP BY vec_id),
best AS (SELECT top.vec_id, CASE WHEN top.mx > 0 THEN (SELECT min(cls) FROM mg WHERE mg.vec_id = top.vec_id AND mg.margin = top.mx)
                                 ELSE 0.0 END AS prediction FROM top),
agg AS (SELECT sc.vec_id, any_value(sc.label) AS label, best.prediction, max(sc.score) AS max_score,
               max(CASE WHEN sc.cls = best.prediction THEN sc.score END) AS pred_score
        FROM sc JOIN best USING (vec_id) GROUP BY sc.vec_id, best.prediction),
fin AS (SELECT vec_id, label, prediction, max_score,
               CASE WHEN max_score = pred_score AND pred_score > {T} THEN prediction ELSE 0.0 END AS final FROM agg)"""


@register("legacy_scores", f"""
WITH {_BASE}
SELECT sc.vec_id, sc.label, best.prediction, CAST(sc.cls AS BIGINT) AS class, round(sc.score, 6) AS score
FROM sc JOIN best USING (vec_id)
""")
def q_legacy_scores(spark, sf):
    s = _legacy(spark, sf)
    return (s.select("vec_id", "label", "prediction", F.posexplode("scores").alias("class", "score"))
            .select("vec_id", "label", "prediction", F.col("class").cast("bigint").alias("class"),
                    F.round("score", 6).alias("score")))


@register("softmax_scores", """
WITH e AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM e),
c AS (SELECT label AS cls, list(m ORDER BY i) AS q FROM (SELECT label, i, avg(v) AS m FROM u GROUP BY 1, 2) GROUP BY label),
mg AS (SELECT e.vec_id, e.label, c.cls, list_dot_product(e.x, c.q) AS margin FROM e, c),
mx AS (SELECT vec_id, max(margin) AS m FROM mg GROUP BY vec_id),
ex AS (SELECT mg.vec_id, mg.label, mg.cls, mg.margin, exp(mg.margin - mx.m) AS z, mx.m FROM mg JOIN mx USING (vec_id)),
zs AS (SELECT vec_id, sum(z) AS zsum, min(CASE WHEN margin = m THEN cls END) AS prediction FROM ex GROUP BY vec_id)
SELECT ex.vec_id, ex.label, zs.prediction, CAST(ex.cls AS BIGINT) AS class, round(ex.z / zs.zsum, 6) AS prob
FROM ex JOIN zs USING (vec_id)
""")
def q_softmax_scores(spark, sf):
    s = SC.softmax_scores(_embeddings(spark, sf), _model(spark, sf), "embedding")
    return (s.select("vec_id", "label", "prediction", F.posexplode("probs").alias("class", "prob"))
            .select("vec_id", "label", "prediction", F.col("class").cast("bigint").alias("class"),
                    F.round("prob", 6).alias("prob")))


@register("reject_option", f"""
WITH {_BASE}
SELECT vec_id, label, final AS prediction FROM fin
""")
def q_reject_option(spark, sf):
    return _legacy(spark, sf).select("vec_id", "label", F.col("final").alias("prediction"))


@register("confident_errors", f"""
WITH {_BASE}
SELECT vec_id, label, prediction, round(max_score, 6) AS max_score FROM fin
WHERE max_score > {T} AND prediction <> label
""")
def q_confident_errors(spark, sf):
    s = SC.confident_errors(_legacy(spark, sf))
    return s.select("vec_id", "label", "prediction", F.round(F.array_max("scores"), 6).alias("max_score"))


@register("unsure_hits", f"""
WITH {_BASE}
SELECT vec_id, label, prediction, round(max_score, 6) AS max_score FROM fin
WHERE max_score < {UNSURE} AND prediction = label
""")
def q_unsure_hits(spark, sf):
    s = SC.unsure_hits(_legacy(spark, sf), threshold=UNSURE)
    return s.select("vec_id", "label", "prediction", F.round(F.array_max("scores"), 6).alias("max_score"))


@register("zero_class_count", f"""
WITH {_BASE}
SELECT CAST(count_if(final = 0.0) AS BIGINT) AS n_zero, count(*) AS n_rows FROM fin
""")
def q_zero_class_count(spark, sf):
    return SC.zero_class_count(_legacy(spark, sf), "final")


_PC = f"""{_BASE},
pairs AS (SELECT label, final AS prediction, count(*) AS n FROM fin GROUP BY 1, 2),
bl AS (SELECT label, sum(n) AS n, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM pairs GROUP BY label),
bp AS (SELECT prediction AS label, sum(n) AS fp FROM pairs WHERE label <> prediction GROUP BY prediction),
pc0 AS (SELECT bl.label, bl.n, bl.tp, coalesce(bp.fp, 0) AS fp, (SELECT sum(n) FROM bl) AS nn FROM bl LEFT JOIN bp USING (label)),
pc AS (SELECT label, n, tp, fp,
              CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
              tp / n AS recall,
              CASE WHEN nn = n THEN 'NaN'::DOUBLE ELSE fp / (nn - n) END AS fpr FROM pc0),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc)"""


@register("metrics_per_class", f"""
WITH {_PC}
SELECT label, CAST(n AS BIGINT) AS n, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, round(recall, 6) AS tpr, round(fpr, 6) AS fpr FROM pf
""")
def q_metrics_per_class(spark, sf):
    pred = _legacy(spark, sf).select("label", F.col("final").alias("prediction"))
    pc = M.per_class(pred)
    return pc.select("label", F.col("n").cast("bigint").alias("n"), F.col("tp").cast("bigint").alias("tp"),
                     F.col("fp").cast("bigint").alias("fp"),
                     *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1", "tpr", "fpr"]])


@register("confusion_matrix", f"""
WITH {_BASE},
labs AS (SELECT DISTINCT label FROM fin),
pairs AS (SELECT label, final AS prediction, count(*) AS n FROM fin GROUP BY 1, 2)
SELECT a.label, b.label AS prediction, CAST(coalesce(pairs.n, 0) AS BIGINT) AS n
FROM labs a JOIN labs b ON true LEFT JOIN pairs ON pairs.label = a.label AND pairs.prediction = b.label
""")
def q_confusion_matrix(spark, sf):
    pred = _legacy(spark, sf).select("label", F.col("final").alias("prediction"))
    return M.confusion(pred)


@register("metrics_overall", f"""
WITH {_PC}
SELECT round(sum(f1 * n) / sum(n), 6) AS weighted_f1, round(sum(precision * n) / sum(n), 6) AS weighted_precision,
       round(sum(recall * n) / sum(n), 6) AS weighted_recall, round(avg(f1), 6) AS macro_f1,
       round(sum(tp) / sum(n), 6) AS micro_f1, CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_unlabelled
FROM pf
""")
def q_metrics_overall(spark, sf):
    pred = _legacy(spark, sf).select("label", F.col("final").alias("prediction"))
    o = M.overall(pred)
    return o.select(*[F.round(c, 6).alias(c) for c in
                      ["weighted_f1", "weighted_precision", "weighted_recall", "macro_f1", "micro_f1"]],
                    "n_rows", "n_unlabelled")
