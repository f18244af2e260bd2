"""Registered streaming query (S14, M7, K1, A9): clean (T8) and score the collection in bounded batches."""

from __future__ import annotations


from pyspark.sql import functions as F

from wordloom.operators.cleaning import DEFAULT_LEMMAS, clean_records
from wordloom.operators.corpus import split_column
from wordloom.operators.features import fit_wcp
from wordloom.plans import sqlparts as S
from wordloom.plans.catalog import register
from wordloom.plans.q_features import WCP_SQL_CTE, WORDS_CTE, TOKS_CTE
from wordloom.session import table
from wordloom.streaming import scorer

CLEAN_CTE = WORDS_CTE.replace(S.words_only(S.strip_markup("text")), S.clean_text("text", DEFAULT_LEMMAS))


def fitted_model(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"), "text")
    d = clean_records(d, out="words").drop("text")
    # Written once to the shared checkpoint folder: every batch reads the model, none refits.
    return fit_wcp(d.where(split_column("doc_id") == "train"))


def run(spark, sf, batch_bytes: int = scorer.BATCH_BYTES):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    model = fitted_model(spark, sf)
    p = scorer.new_paths(spark)
    scorer.stage_landing(docs, p["landing"])
    scorer.run_stream(spark, scorer.wcp_scorer(model), p["landing"], docs.schema, p["cells"], p["checkpoint"], batch_bytes)
    return p


@register("stream_score", f"""
WITH {WCP_SQL_CTE.replace(WORDS_CTE + ',', CLEAN_CTE + ', ' + TOKS_CTE + ',', 1)},
best AS (SELECT doc_id, arg_min(label, (-score, label)) AS prediction FROM sc GROUP BY doc_id)
SELECT documents.source || '-' || CAST(documents.doc_id AS VARCHAR) AS row_key, best.prediction AS value
FROM best JOIN documents USING (doc_id)
""")
def q_stream_score(spark, sf):
    return scorer.latest_labels(spark, run(spark, sf)["cells"])
