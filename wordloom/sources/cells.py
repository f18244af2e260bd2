"""Keyed cells: the key-value store the original reads and writes, as a Parquet cell log.

A cell is ``(row_key, family, qualifier, ts, seq, value)``; ``seq`` breaks ties between
versions with the same ``ts``. Writes only append (a put is an upsert: the newest version
wins on read); each batch of each run owns a folder ``run=/batch=``, which a replay overwrites.

Reads: key-range scan of one collection (S7), column projection (S8), latest version per
cell and per row (S9, S10), point look-ups (S11), value scans (S12). Writes: label names per
record (K1), training rows (K2).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators.common import MAX_BROADCAST_ROWS, maybe_broadcast

#: Folders of a keyed store: keys are dealt by a hash of what stands before their first '-' (the collection).
STORE_BUCKETS = 64
#: Keys of a look-up that go to the scan as a filter; more are joined.
MAX_KEY_FILTER = 10_000

CELL_COLS = ["row_key", "family", "qualifier", "ts", "seq", "value"]


def cells(row_key: Column, family: str, qualifier: str, value: Column, ts: Column | None = None,
          seq: Column | None = None) -> list[Column]:
    """Projection list building cell rows."""
    return [row_key.cast("string").alias("row_key"), F.lit(family).alias("family"),
            F.lit(qualifier).alias("qualifier"),
            (ts if ts is not None else F.lit(0).cast("timestamp")).alias("ts"),
            (seq if seq is not None else F.lit(0)).cast("bigint").alias("seq"),
            value.cast("string").alias("value")]


def unpivot_cells(df: DataFrame, row_key: str, family: str, columns: dict[str, Column],
                  ts: Column | None = None, seq: Column | None = None) -> DataFrame:
    """K2 shape: one cell per (row, qualifier) from several columns (a ``stack`` unpivot)."""
    arr = F.array(*[F.struct(F.lit(q).alias("q"), c.cast("string").alias("v")) for q, c in columns.items()])
    return (df.select(F.col(row_key).cast("string").alias("row_key"), F.explode(arr).alias("c"),
                      (ts if ts is not None else F.lit(0).cast("timestamp")).alias("ts"),
                      (seq if seq is not None else F.lit(0)).cast("bigint").alias("seq"))
            .select("row_key", F.lit(family).alias("family"), F.col("c.q").alias("qualifier"),
                    "ts", "seq", F.col("c.v").alias("value")))


def prefix_range(collection_id: str) -> tuple[str, str]:
    """``[id, id + '0')``: takes ``id`` and ``id-...`` (``'-' < '0'``), stops before ``id0...``."""
    return collection_id, collection_id + "0"


def scan_collection(cell_df: DataFrame, collection_id: str, family: str = K.COLLECTION_FAMILY,
                    qualifier: str = K.COLLECTION_QUALIFIER) -> DataFrame:
    """S7 + S8 + S9: latest value of one column for every row of one collection.

    The key range and the column are plain predicates on stored columns, so Parquet gets them
    as pushed filters (row-group min/max skipping on ``row_key``); of a keyed store only the collection's folder
    is read."""
    lo, hi = prefix_range(collection_id)
    if "bucket" in cell_df.columns:
        cell_df = cell_df.where(F.col("bucket") == store_bucket(F.lit(collection_id)))
    sel = cell_df.where((F.col("row_key") >= lo) & (F.col("row_key") < hi)
                        & (F.col("family") == family) & (F.col("qualifier") == qualifier))
    return latest(sel).select("row_key", "value")


def latest(cell_df: DataFrame) -> DataFrame:
    """Newest version of every (row, family, qualifier) cell: ``max_by`` on (ts, seq),
    partially aggregated before the shuffle."""
    return (cell_df.groupBy("row_key", "family", "qualifier")
            .agg(F.max_by("value", F.struct("ts", "seq")).alias("value"),
                 F.max(F.struct("ts", "seq"))["ts"].alias("ts")))


def latest_row(cell_df: DataFrame, family: str, qualifiers: list[str]) -> DataFrame:
    """One record per row key with the newest value of each listed qualifier.

    One grouped pass keyed by row: a per-qualifier ``max_by`` (rows of other qualifiers have a
    NULL ordering and are skipped), so no second shuffle for a pivot and no driver-side list
    of pivot values. A row missing a qualifier gets NULL there.
    """
    fam = cell_df.where((F.col("family") == family) & F.col("qualifier").isin(qualifiers))
    aggs = [F.max_by("value", F.when(F.col("qualifier") == q, F.struct("ts", "seq"))).alias(q)
            for q in qualifiers]
    return fam.groupBy("row_key").agg(*aggs)


def point_lookup(cell_df: DataFrame, keys: DataFrame, family: str, qualifier: str,
                 key_col: str = "row_key") -> DataFrame:
    """S11 for many keys at once: the newest version of the column for each of a table of keys.

    One pass over the keys gives their number, least and greatest, and the store folders they lie in (``STORE_BUCKETS`` at
    most). Folders and key range always go to the scan as filters, so other folders and row groups are not read; up
    to ``MAX_KEY_FILTER`` keys go there themselves, more are semi-joined."""
    col = cell_df.where((F.col("family") == family) & (F.col("qualifier") == qualifier))
    k = keys.select(F.col(key_col).cast("string").alias("row_key")).where(F.col("row_key").isNotNull()).distinct().checkpoint()
    n, lo, hi, buckets = k.agg(F.count(F.lit(1)), F.min("row_key"), F.max("row_key"), F.collect_set(store_bucket(F.col("row_key")))).first()
    if not n:
        return latest(col.limit(0)).select("row_key", "value")
    if "bucket" in cell_df.columns:
        col = col.where(F.col("bucket").isin(buckets))
    col = col.where(F.col("row_key").between(lo, hi))
    if n <= MAX_KEY_FILTER:
        col = col.where(F.col("row_key").isin([r["row_key"] for r in k.collect()]))
    else:
        col = col.join(maybe_broadcast(k, n <= MAX_BROADCAST_ROWS), "row_key", "left_semi")
    return latest(col).select("row_key", "value")


def value_scan(cell_df: DataFrame, family: str, qualifier: str, value: str) -> DataFrame:
    """Rows whose newest version of the column equals ``value`` (byte equality); rows
    without that column do not appear."""
    col = cell_df.where((F.col("family") == family) & (F.col("qualifier") == qualifier))
    return latest(col).where(F.col("value") == value).select("row_key", "value")


@dataclass
class Run:
    """A run of a job that writes to a cell log: its number, which grows with time, and when it began."""

    number: int = 0
    started: int = 0


def open_run(spark: SparkSession, path: str, name: str) -> Run:
    """K1: the run called ``name`` of the cell log at ``path``. A name that the log's manifest knows is the same run again (a
    job that goes on after a failure replays its batches over its own folders); a new name is a new run, whose
    cells are newer than all before. The manifest has one small file per run, in a folder that readers skip."""
    manifest = f"{path}/_runs"
    folder = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    known = []
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        known = spark.read.schema("number long, name string, started long").parquet(f"{manifest}/*").collect()
    for r in known:
        if r["name"] == name:
            return Run(r["number"], r["started"])
    run = Run(max((r["number"] for r in known), default=-1) + 1, max([int(time.time()), *[r["started"] + 1 for r in known]]))
    spark.createDataFrame([(run.number, name, run.started)], "number long, name string, started long").coalesce(1).write.parquet(f"{manifest}/{run.number:08d}")
    return run


def append_cells(cell_df: DataFrame, path: str, batch_id: int | None = None, run: Run | None = None) -> None:
    """K1/K2 sink: append cells to the log. With ``batch_id`` the batch of the run (:func:`open_run`) owns its folder and is
    written with overwrite, so replaying a batch after a failure is idempotent and other runs are left alone."""
    out = cell_df.select(*CELL_COLS)
    if batch_id is None:
        out.write.mode("append").parquet(path)
    else:
        out.write.mode("overwrite").parquet(f"{path}/run={(run or Run()).number}/batch={batch_id}")


def count_batches(spark: SparkSession, path: str, run: Run) -> int:
    """Batches that a run has written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run={run.number}/batch=*")
    return len(folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or [])


def compact(cell_df: DataFrame, path: str) -> None:
    """The newest version of every cell, as a keyed store of its own at ``path`` (see :func:`write_store`)."""
    newest = cell_df.groupBy("row_key", "family", "qualifier").agg(F.max_by(F.struct("ts", "seq", "value"), F.struct("ts", "seq")).alias("c"))
    write_store(newest.select("row_key", "family", "qualifier", "c.ts", "c.seq", "c.value"), path)


def read_cells(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*CELL_COLS)


def store_bucket(row_key: Column) -> Column:
    """The folder of a key in a keyed store; all keys of a collection share one."""
    return F.pmod(F.xxhash64(F.substring_index(row_key, "-", 1)), F.lit(STORE_BUCKETS)).cast("int")


def write_store(cell_df: DataFrame, path: str) -> None:
    """Lay cells out as a keyed store: a folder for each bucket of collections, in it files that are range-partitioned and
    sorted by ``row_key``. A large collection has many files, each with a narrow key range, so folder filters and
    Parquet min/max statistics let a key-range scan (S7) or point lookup (S11) skip everything outside."""
    (cell_df.select(*CELL_COLS, store_bucket(F.col("row_key")).alias("bucket")).repartitionByRange("bucket", "row_key")
     .sortWithinPartitions("bucket", "row_key", "family", "qualifier").write.mode("overwrite").partitionBy("bucket").parquet(path))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The cells of a keyed store, with their folder (``bucket``)."""
    return spark.read.parquet(path).select(*CELL_COLS, "bucket")


def label_cells(pred: DataFrame, id_col: str, name_col: str, batch: int, run: Run | None = None) -> DataFrame:
    """K1: label name per record id into ``clean-tweet:real-world-events``. The version is when the run began, then
    the batch."""
    return pred.select(*cells(F.col(id_col), K.LABEL_FAMILY, K.LABEL_QUALIFIER, F.col(name_col),
                              ts=F.timestamp_seconds(F.lit((run or Run()).started)), seq=F.lit(batch)))


def training_cells(records: DataFrame, id_col: str = "id", label: str = "label", text: str = "text",
                   batch: int = 0) -> DataFrame:
    """K2: label (as ``Double.toString``) and text of training rows as two cells per row."""
    return unpivot_cells(records.where(F.col(label).isNotNull()), id_col, K.TRAINING_FAMILY,
                         {K.TRAINING_LABEL_QUALIFIER: F.col(label).cast("double").cast("string"),
                          K.TRAINING_TEXT_QUALIFIER: F.col(text)},
                         ts=F.timestamp_seconds(F.lit(batch)), seq=F.lit(batch))


def training_records(cell_df: DataFrame) -> DataFrame:
    """``(id, label, text)`` from the training cells; label parsed as a double."""
    rows = latest_row(cell_df, K.TRAINING_FAMILY, [K.TRAINING_LABEL_QUALIFIER, K.TRAINING_TEXT_QUALIFIER])
    return rows.select(F.col("row_key").alias("id"),
                       F.col(K.TRAINING_LABEL_QUALIFIER).try_cast("double").alias("label"),
                       F.col(K.TRAINING_TEXT_QUALIFIER).alias("text"))
