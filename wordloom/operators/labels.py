"""Label dictionaries, label names, deterministic ids and batch numbering."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators.common import MAX_BROADCAST_ROWS, distinct_at_most, maybe_broadcast


def stable_id(*cols) -> F.Column:
    """Deterministic record id (replaces random UUIDs): sha-256 of the key columns."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)


def global_row_number(spark: SparkSession, df: DataFrame, order_cols: list[str],
                      out: str = "row_id") -> DataFrame:
    """1-based row number over a total order, without a single-partition window.

    Rows are range-partitioned and sorted, then checkpointed (reliable checkpoint in the shared
    checkpoint folder) so the partitioning is fixed. Each partition's row count (one small
    row per partition) gives its offset; a row's number is its offset plus its position in the
    partition, read from ``monotonically_increasing_id``. ``order_cols`` must form a total
    order (end with a unique key) for the numbering to be deterministic.
    """
    ordered = (df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
               .checkpoint(eager=True))
    pos = (ordered.withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    counts = dict(pos.groupBy("_pid").count().collect())
    n_parts = max(counts) + 1 if counts else 1
    sizes = [counts.get(i, 0) for i in range(n_parts)]
    offsets = [0] + list(accumulate(sizes))[:-1]
    off = F.array(*[F.lit(o).cast("bigint") for o in offsets])
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (pos.withColumn(out, F.element_at(off, F.col("_pid") + 1) + local + 1)
            .drop("_pid", "_mid"))


def running_total(df: DataFrame, order_cols: list[str], value: str, out: str = "running_total") -> DataFrame:
    """The sum of ``value`` over all rows up to and with each row, in the order of ``order_cols``, by two levels.

    Rows are range-partitioned and checkpointed, so that the partitioning is fixed. A window runs within each
    partition, and the sums of the partitions before it (one row per partition on the driver) are added. Null
    values count as 0. ``order_cols`` must form a total order for the totals to be deterministic."""
    ordered = df.repartitionByRange(*order_cols).checkpoint(eager=True).withColumn("_pid", F.spark_partition_id())
    v = F.coalesce(F.col(value), F.lit(0))
    sums = dict(ordered.groupBy("_pid").agg(F.sum(v)).collect())
    before = list(accumulate((sums.get(i, 0) for i in range(max(sums, default=-1) + 1)), initial=0))
    offsets = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(before[:-1])], f"_pid int, _before {ordered.select(F.sum(v)).dtypes[0][1]}")
    within = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    return (ordered.withColumn("_sum", F.sum(v).over(within)).join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_before") + F.col("_sum")).drop("_pid", "_sum", "_before"))


def label_dictionary(df: DataFrame, raw: str = "raw_label", split: str | None = None,
                     split_order: list[str] | None = None) -> DataFrame:
    """L1: ``(raw_label, label)`` with labels 0, 1, 2, ... Labels first seen in an earlier split
    come first (train before test), ties by raw label, so a label seen only in the test split
    gets a number after every training label. Deterministic (D4)."""
    if split is not None and split_order:
        rank = F.lit(len(split_order))
        for i, s in reversed(list(enumerate(split_order))):
            rank = F.when(F.col(split) == s, F.lit(i)).otherwise(rank)
    else:
        rank = F.lit(0)
    firsts = (df.where(F.col(raw).isNotNull()).groupBy(F.col(raw).alias("raw_label"))
              .agg(F.min(rank).alias("first_split")))
    spark = df.sparkSession
    numbered = global_row_number(spark, firsts, ["first_split", "raw_label"], "_n")
    return numbered.select("raw_label", (F.col("_n") - 1).cast("double").alias("label"), "first_split")


def apply_label_dictionary(df: DataFrame, dictionary: DataFrame, raw: str = "raw_label",
                           out: str = "label") -> DataFrame:
    """Look up each raw label; broadcast when the dictionary is proven small."""
    small = distinct_at_most(df, [raw], MAX_BROADCAST_ROWS)
    d = dictionary.select(F.col("raw_label").alias(raw), F.col("label").alias(out))
    return df.join(maybe_broadcast(d, small), raw, "left")


def remap_labels(spark: SparkSession, df: DataFrame, mapping: dict[float, float],
                 col: str = "label", out: str = "label") -> DataFrame:
    """L3 (0 -> 9) in general form: a literal mapping; unmapped labels stay as they are."""
    expr = F.col(col)
    for k, v in sorted(mapping.items()):
        expr = F.when(F.col(col) == F.lit(k), F.lit(v)).otherwise(expr)
    return df.withColumn(out, expr.cast("double"))


def label_names(spark: SparkSession, df: DataFrame, col: str = "label", out: str = "label_name",
                names: dict[float, str] = K.LABEL_NAMES,
                default: str = K.DEFAULT_LABEL_NAME) -> DataFrame:
    """L4: label number -> event name by a broadcast left join with the fixed 14-row table."""
    dim = spark.createDataFrame([(float(k), v) for k, v in sorted(names.items())],
                                f"_num double, {out} string")
    return (df.join(F.broadcast(dim), F.col(col).cast("double") == F.col("_num"), "left")
            .drop("_num").withColumn(out, F.coalesce(F.col(out), F.lit(default))))


def batch_counts(spark: SparkSession, df: DataFrame, order_cols: list[str], batch_rows: int) -> DataFrame:
    """Rows are taken ``batch_rows`` at a time in key order; per batch its row count and
    the running total of rows processed so far. The running total is the largest row number
    in the batch, so no window over all batches is needed."""
    numbered = global_row_number(spark, df, order_cols, "_idx")
    return (numbered.groupBy(F.floor((F.col("_idx") - 1) / batch_rows).cast("bigint").alias("batch_id"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.max("_idx").cast("bigint").alias("running_total")))
