"""Linear-model scoring.

A linear model here is a table ``(class, weights array<double>)`` with classes ``0..K-1``. Up to ``IN_ROW_VALUES``
weights it becomes one literal evaluated inside each row -- the way Spark ML's own models ship their
coefficients to the executors -- so scoring needs no join and no shuffle. A larger one stays a table, in blocks of
``BLOCK_VALUES`` weights that meet the rows by a join (:class:`ModelBlocks`); both give the same scores, at any number of classes.

``legacy_scores`` reproduces the original pivot-class scoring exactly (order-dependent running
maximum, class 0 scoring 0, classes 0..K-2 divided by the sum, the last class undivided);
``softmax_scores`` is the clean form.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.functions.vectors import dot_cast, let_

#: Weights of a model that is sent along with the plan (16 MB), and of a block of a larger one.
IN_ROW_VALUES = 2_000_000
BLOCK_VALUES = 250_000


@dataclass
class ModelBlocks:
    """``table``: ``(block, weights array<array<double>>)``, ``n_blocks`` blocks of ``per_block`` classes in order;
    ``n_classes`` in all."""

    table: DataFrame
    n_blocks: int
    per_block: int
    n_classes: int


Model = list[list[float]] | ModelBlocks


def linear_model(model: DataFrame, cls: str = "class", weights: str = "weights") -> Model:
    """The model's rows ordered by class, or its blocks where they have more than ``IN_ROW_VALUES`` weights. Classes must be 0..K-1."""
    m = model.select(F.col(cls).cast("int").alias("c"), F.col(weights).cast("array<double>").alias("w")).checkpoint()
    n, kinds, low, high, values, widest = m.agg(F.count("*"), F.count_distinct("c"), F.min("c"), F.max("c"),
                                                F.sum(F.size("w")), F.max(F.size("w"))).first()
    if not n or n != kinds or low != 0 or high != n - 1:
        raise ValueError("classes must be 0..K-1")
    if values <= IN_ROW_VALUES:
        return [list(map(float, r["w"])) for r in sorted(m.collect(), key=lambda r: r["c"])]
    per_block = max(1, BLOCK_VALUES // max(widest, 1))
    rows = F.array_sort(F.collect_list(F.struct("c", "w")))
    table = m.groupBy(F.floor(F.col("c") / per_block).cast("int").alias("block")).agg(F.transform(rows, lambda r: r["w"]).alias("weights"))
    return ModelBlocks(table.checkpoint(), -(-n // per_block), per_block, n)


def _matrix_lit(rows: list[list[float]]) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), "array<array<double>>")  # folded to one literal, whatever its size


def _n_classes(model: Model) -> int:
    return model.n_classes if isinstance(model, ModelBlocks) else len(model)


def margins(x: Column, rows: list[list[float]]) -> Column:
    """``[x . w_c for each weight row]`` as an array (one dot product per class)."""
    return F.transform(_matrix_lit(rows), lambda w: dot_cast(x, w))


def _with_margins(df: DataFrame, model: Model, features: str, skip: int = 0) -> tuple[DataFrame, Column]:
    """``df`` and the margins of its rows, without those of the first ``skip`` classes.

    Blocks meet the rows as in a product of block matrices: rows are dealt into as many groups as there are shuffle
    partitions, each (group, block) is a key, and a row's margins come back as one short array a block."""
    if not isinstance(model, ModelBlocks):
        return df, margins(F.col(features), model[skip:])
    spark = df.sparkSession
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = df.withColumn("_id", F.monotonically_increasing_id()).checkpoint()  # fixes the numbers
    rows = df.select("_id", F.pmod(F.xxhash64("_id"), F.lit(groups)).alias("_group"), F.col(features).alias("_x"),
                     F.explode(F.sequence(F.lit(0), F.lit(model.n_blocks - 1))).alias("block"))
    blocks = model.table.withColumn("_group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    part = rows.join(blocks, ["_group", "block"]).select("_id", F.struct("block", F.transform("weights", lambda w: dot_cast(F.col("_x"), w)).alias("m")).alias("_part"))
    whole = part.groupBy("_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("_part")), lambda p: p["m"])).alias("_m"))
    return df.join(whole, "_id").drop("_id"), F.slice("_m", skip + 1, max(model.n_classes - skip, 1))


def running_max(m: Column, n: int) -> Column:
    """For each of the ``n`` elements the largest up to it, 0 at least. By doubling: after the step of width d every
    place knows the maximum of the 2 d elements that end there, so a row costs n log n."""
    def wider(d: int):
        return lambda x: F.zip_with(x, F.concat(F.array_repeat(F.lit(0.0), d), F.slice(x, 1, n - d)), lambda a, b: F.greatest(a, b))

    out, width = F.transform(m, lambda v: F.greatest(v, F.lit(0.0))), 1
    while width < n:
        out = let_(out, wider(width))
        width *= 2
    return out


def legacy_scores(df: DataFrame, model: Model, features: str, threshold: float = K.REJECT_THRESHOLD) -> DataFrame:
    """M3 + W3 + M4 on each row. Class 0 of the model is the pivot and unused; the
    margins of classes 1..K-1 are scanned in order with a running maximum that starts at 0.

    Adds ``prediction`` (raw best class), ``scores`` (K values) and ``final`` (reject option:
    the prediction is kept only when its score is the maximum and above ``threshold``, else 0).
    Every intermediate array is bound once (``let_``), so the row cost stays O(K log K + K dim)
    however the optimizer moves the expression.
    """
    k = _n_classes(model)

    def from_margins(m):
        raw = let_(running_max(m, k - 1), lambda run: F.concat(F.array(F.lit(0.0)),      # class 0 scores 0
                   F.zip_with(m, run, lambda v, r: F.lit(1.0) / (F.lit(1.0) + F.exp(-(v - r))))))
        top = F.greatest(F.lit(0.0), F.array_max(m))
        pred = F.when(top > 0, F.array_position(m, top)).otherwise(F.lit(0)).cast("double")

        def from_raw(rw):
            return let_(F.aggregate(rw, F.lit(0.0), lambda s_, v: s_ + v), lambda tot: F.struct(
                pred.alias("prediction"),
                F.transform(rw, lambda v, i: F.when(i < k - 1, v / tot).otherwise(v)).alias("scores")))
        return let_(raw, from_raw)

    def with_final(r):
        ps = F.try_element_at(r["scores"], r["prediction"].cast("int") + 1)
        keep = (F.array_max(r["scores"]) == ps) & (ps > threshold)
        return F.struct(r["prediction"].alias("prediction"), r["scores"].alias("scores"),
                        F.when(keep, r["prediction"]).otherwise(F.lit(0.0)).alias("final"))

    df, m = _with_margins(df, model, features, skip=1)
    return (df.withColumn("_r", let_(let_(m, from_margins), with_final))
            .withColumn("prediction", F.col("_r.prediction")).withColumn("scores", F.col("_r.scores"))
            .withColumn("final", F.col("_r.final")).drop("_r", "_m"))


def softmax_scores(df: DataFrame, model: Model, features: str) -> DataFrame:
    """Clean form: every class has its weight row, ``p = softmax(margins)``; ``prediction`` is
    the most probable class, the lowest one on ties."""
    def from_margins(m):
        mx = F.array_max(m)
        return let_(F.transform(m, lambda v: F.exp(v - mx)), lambda e: let_(
            F.aggregate(e, F.lit(0.0), lambda s_, v: s_ + v), lambda t: F.struct(
                F.transform(e, lambda v: v / t).alias("probs"),
                (F.array_position(m, mx) - 1).cast("double").alias("prediction"))))
    df, m = _with_margins(df, model, features)
    return (df.withColumn("_r", let_(m, from_margins)).withColumn("probs", F.col("_r.probs"))
            .withColumn("prediction", F.col("_r.prediction")).drop("_r", "_m"))


def confident_errors(scored: DataFrame, label: str = "label", threshold: float = K.REJECT_THRESHOLD) -> DataFrame:
    """Highest score above the threshold yet the prediction is wrong."""
    return scored.where((F.array_max("scores") > threshold) & (F.col("prediction") != F.col(label)))


def unsure_hits(scored: DataFrame, label: str = "label", threshold: float = K.REJECT_THRESHOLD) -> DataFrame:
    """Highest score below the threshold yet the prediction is right."""
    return scored.where((F.array_max("scores") < threshold) & (F.col("prediction") == F.col(label)))


def zero_class_count(pred: DataFrame, col: str = "final") -> DataFrame:
    """Rows predicted as class 0."""
    return pred.agg(F.count_if(F.col(col) == 0.0).alias("n_zero"), F.count(F.lit(1)).alias("n_rows"))
