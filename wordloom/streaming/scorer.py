"""Bounded streaming scorer.

The original pulls ``n`` rows at a time from the store, cleans, predicts and writes each batch,
keeping a running total. Here a Structured Streaming file source delivers the collection in
bounded batches (``maxBytesPerTrigger``) and ``trigger(availableNow=True)`` stops once all
present input is processed. ``foreachBatch`` scores a batch with an already fitted model and
appends label cells to the cell log; each batch of a run owns its output folder and overwrites it, so a
batch replayed after an executor or driver failure (the checkpoint records progress) writes
the same result again. No state store is needed: the sink is an upsert keyed by record id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.cleaning import clean_records
from wordloom.operators.corpus import word_records
from wordloom.operators.features import WcpModel, predict_wcp
from wordloom.session import scratch_path, spread
from wordloom.operators.labels import running_total
from wordloom.sources import cells as C


#: Bytes of landing files in a batch.
BATCH_BYTES = 1 << 30


def key_column() -> F.Column:
    return F.concat_ws("-", "source", F.col("doc_id").cast("string"))


def _keyed(df: DataFrame) -> DataFrame:
    """Records keyed by ``row_key``: kept when present (store scans), else ``source-doc_id``."""
    return df if "row_key" in df.columns else df.withColumn("row_key", key_column())


def score_records(model: WcpModel, df: DataFrame) -> DataFrame:
    """Batch form of the scorer: ``(row_key, prediction)`` for every record of ``df``, cleaned first."""
    recs = clean_records(_keyed(df), out="words").select(F.col("row_key").alias("doc_id"), "words")
    best = predict_wcp(model, recs)
    return best.select(F.col("doc_id").alias("row_key"), F.col("prediction").cast("string").alias("prediction"))


def wcp_scorer(model: WcpModel):
    """Scoring function for :func:`run_stream`: class log-probability argmax."""
    return lambda df: score_records(model, df)


def pipeline_scorer(model, names: bool = True):
    """Scoring function for :func:`run_stream` from a fitted Spark ML ``PipelineModel`` (M7). One that cleans for itself
    (``plans.models.text_pipeline``) gets the raw text; one that reads ``words`` gets records cleaned by T1 and T2. The predicted class
    number is written as its label name (L4) or as the number."""
    from wordloom.operators.labels import label_names
    from wordloom.plans.stages import TextCleaner

    cleans = isinstance(model.stages[0], TextCleaner)

    def score(df: DataFrame) -> DataFrame:
        df = _keyed(df)
        recs = df.select(F.col("row_key").alias("doc_id"), "text") if cleans else word_records(df, label=None, id_col="row_key")
        pred = model.transform(recs).select(F.col("doc_id").alias("row_key"), "prediction")
        if names:
            return label_names(df.sparkSession, pred, "prediction", "name").select(
                "row_key", F.col("name").alias("prediction"))
        return pred.select("row_key", F.col("prediction").cast("string").alias("prediction"))
    return score


def stage_landing(df: DataFrame, path: str) -> None:
    """Lay a table out in a landing folder (the stream's input), a file for each of its own splits."""
    df.write.mode("overwrite").parquet(path)


def run_stream(spark: SparkSession, score, landing: str, schema, cells_path: str,
               checkpoint: str, batch_bytes: int = BATCH_BYTES) -> int:
    """Score everything in ``landing`` batch by batch; returns the number of batches in the cell log.

    A batch takes files up to ``batch_bytes``, one at least, however many or large they are. ``score`` maps a batch of
    records to ``(row_key, prediction)`` (:func:`wcp_scorer`, :func:`pipeline_scorer`). One job per batch: score and append the
    batch's label cells to its folder (overwritten on replay). The checkpoint names the run: the same one again
    goes on with the run, another one makes a newer run in the same log, beside the older. Every record yields
    exactly one cell, so per-batch row counts are read back from the cell log (:func:`batch_totals`)."""
    src = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(landing)
    run = C.open_run(spark, cells_path, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        pred = score(spread(batch))
        C.append_cells(C.label_cells(pred, "row_key", "prediction", batch_id, run), cells_path, batch_id, run)

    q = (src.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return C.count_batches(spark, cells_path, run)


def score_collection(spark: SparkSession, store: DataFrame, collection_id: str, score, cells_path: str,
                     run_name: str | None = None) -> None:
    """M7 as one batch job: scan one collection's text cells from the keyed store (S7, pushed
    into Parquet), score every record and write its label cell (K1). The original pulled the
    rows to the client ``n`` at a time; here the scan itself is distributed, so there is no
    batching loop. Each call is a run of its own, newer than those before; a ``run_name`` given again replaces
    its own cells only."""
    recs = C.scan_collection(store, collection_id).select("row_key", F.col("value").alias("text"))
    run = C.open_run(spark, cells_path, run_name or uuid.uuid4().hex)
    C.append_cells(C.label_cells(score(recs), "row_key", "prediction", 0, run), cells_path, 0, run)


def batch_totals(spark: SparkSession, cells_path: str) -> DataFrame:
    """Rows per run and batch and the running total, counted from the cell log's partition columns."""
    c = spark.read.parquet(cells_path).groupBy(F.col("run").cast("bigint").alias("run"), F.col("batch").cast("bigint").alias("batch_id")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    return running_total(c, ["run", "batch_id"], "n_rows")


def latest_labels(spark: SparkSession, cells_path: str) -> DataFrame:
    from wordloom import constants as K
    got = C.read_cells(spark, cells_path).where(
        (F.col("family") == K.LABEL_FAMILY) & (F.col("qualifier") == K.LABEL_QUALIFIER))
    return C.latest(got).select("row_key", "value")


def new_paths(spark: SparkSession) -> dict[str, str]:
    return {k: scratch_path(spark, f"stream-{k}") for k in ("landing", "cells", "checkpoint")}
