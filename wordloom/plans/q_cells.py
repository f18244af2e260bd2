"""Registered keyed-cell queries.

Test mapping: ``documents`` become collection cells with key ``source-doc_id``; ``events``
become versioned cells ``(user_id, event_type, ts, value)`` with ``event_id`` as tie-break.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators import labels as L
from wordloom.sources import cells as C
from wordloom.plans import sqlparts as S
from wordloom.plans.catalog import register
from wordloom.session import scratch_path, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
COLLECTION = "src1"


def collection_cells(spark, sf):
    d = table(spark, sf, "documents")
    key = F.concat_ws("-", "source", F.col("doc_id").cast("string"))
    text = d.select(*C.cells(key, K.COLLECTION_FAMILY, K.COLLECTION_QUALIFIER, F.col("text")))
    lang = d.select(*C.cells(key, K.COLLECTION_FAMILY, "lang", F.col("lang")))
    return text.unionByName(lang)


_stores: dict[tuple[str, str], str] = {}


def collection_store(spark, sf):
    """The collection as a keyed store at rest, in the shared folder. It is written once in an application for each folder
    of tables; the reading queries share it."""
    key = spark.sparkContext.applicationId, sf
    if key not in _stores:
        path = scratch_path(spark, "collection-store")
        C.write_store(collection_cells(spark, sf), path)
        _stores[key] = path
    return C.read_store(spark, _stores[key])


def event_cells(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").cast("string").alias("row_key"), F.lit("event").alias("family"),
                    F.col("event_type").alias("qualifier"), F.col("ts").cast("timestamp").alias("ts"),
                    F.col("event_id").cast("bigint").alias("seq"), F.col("value").cast("string").alias("value"))


@register("collection_scan", f"""
SELECT source || '-' || CAST(doc_id AS VARCHAR) AS row_key, text AS value FROM documents
WHERE source || '-' || CAST(doc_id AS VARCHAR) >= {S.lit(COLLECTION)}
  AND source || '-' || CAST(doc_id AS VARCHAR) < {S.lit(COLLECTION + '0')}
""")
def q_collection_scan(spark, sf):
    return C.scan_collection(collection_store(spark, sf), COLLECTION)


_latest_sql = ",\n       ".join(
    f"arg_max(CAST(value AS VARCHAR), (ts, event_id)) FILTER (WHERE event_type = '{q}') AS {q}" for q in EVENT_TYPES)


@register("latest_cells", f"""
SELECT CAST(user_id AS VARCHAR) AS row_key,
       {_latest_sql}
FROM events GROUP BY user_id
""")
def q_latest_cells(spark, sf):
    return C.latest_row(event_cells(spark, sf), "event", EVENT_TYPES)


@register("point_lookup", """
SELECT d.source || '-' || CAST(d.doc_id AS VARCHAR) AS row_key, d.text AS value
FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
""")
def q_point_lookup(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    lab = table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id")
    keys = d.join(lab, "doc_id", "left_semi").select(
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("row_key"))
    return C.point_lookup(collection_store(spark, sf), keys, K.COLLECTION_FAMILY, K.COLLECTION_QUALIFIER)


@register("value_scan", """
SELECT source || '-' || CAST(doc_id AS VARCHAR) AS row_key, lang AS value FROM documents WHERE lang = 'fr'
""")
def q_value_scan(spark, sf):
    return C.value_scan(collection_store(spark, sf), K.COLLECTION_FAMILY, "lang", "fr")


_TRAIN_CELLS_SQL = f"""
WITH t AS (SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL)
SELECT CAST(doc_id AS VARCHAR) AS row_key, '{K.TRAINING_FAMILY}' AS family, 'label' AS qualifier,
       CAST(CAST(quality AS DOUBLE) AS VARCHAR) AS value FROM t
UNION ALL
SELECT CAST(doc_id AS VARCHAR) AS row_key, '{K.TRAINING_FAMILY}' AS family, 'text' AS qualifier, text AS value FROM t
"""


def _write_training(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    path = scratch_path(spark, "training-cells")
    C.append_cells(C.training_cells(d.join(lab, "id")), path, batch_id=0)
    return C.read_cells(spark, path)


@register("write_training_cells", _TRAIN_CELLS_SQL)
def q_write_training_cells(spark, sf):
    return _write_training(spark, sf).select("row_key", "family", "qualifier", "value")


@register("training_from_cells", """
SELECT CAST(d.doc_id AS VARCHAR) AS id, CAST(l.quality AS DOUBLE) AS label, d.text AS text
FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL
""")
def q_training_from_cells(spark, sf):
    return C.training_records(_write_training(spark, sf))


_names_sql = ", ".join(f"({k}::DOUBLE, {S.lit(v)})" for k, v in K.LABEL_NAMES.items())


@register("write_labels", f"""
SELECT CAST(e.vec_id AS VARCHAR) AS row_key, coalesce(n.name, {S.lit(K.DEFAULT_LABEL_NAME)}) AS value
FROM embeddings e LEFT JOIN (VALUES {_names_sql}) AS n(num, name)
  ON (CASE WHEN e.label = 0 THEN 9.0 ELSE CAST(e.label AS DOUBLE) END) = n.num
""")
def q_write_labels(spark, sf):
    """K1 upsert: batch 0 writes the names of the raw labels, batch 1 re-writes every record
    with the names of the remapped labels (0 -> 9); reading the newest version per cell shows
    the second batch everywhere (last write wins)."""
    e = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"))
    path = scratch_path(spark, "label-cells")
    first = L.label_names(spark, e, "label", "name")
    C.append_cells(C.label_cells(first, "vec_id", "name", batch=0), path, batch_id=0)
    second = L.label_names(spark, L.remap_labels(spark, e, {0.0: 9.0}), "label", "name")
    C.append_cells(C.label_cells(second, "vec_id", "name", batch=1), path, batch_id=1)
    got = C.latest(C.read_cells(spark, path).where(
        (F.col("family") == K.LABEL_FAMILY) & (F.col("qualifier") == K.LABEL_QUALIFIER)))
    return got.select("row_key", "value")
