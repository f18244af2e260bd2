"""Aggregations over labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.functions.text import tokens
from wordloom.operators.common import MAX_BROADCAST_ROWS, distinct_at_most, maybe_broadcast, r6


def class_word_counts(df: DataFrame, label: str = "label", text: str = "words") -> DataFrame:
    """A1 (+P4, P10): ``(label, word, n)`` for every class in one grouped pass.

    Tokens are the Java split of ``text`` on one space and are lower-cased; empty tokens count
    as words, as in the original. Partial aggregation runs before the shuffle.
    """
    return (df.select(F.col(label).alias("label"), F.explode(tokens(text)).alias("w"))
            .groupBy("label", F.lower("w").alias("word"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_token_totals(df: DataFrame, label: str = "label", text: str = "words") -> DataFrame:
    """A2: tokens per class (all tokens, not distinct)."""
    return (df.select(F.col(label).alias("label"), F.size(tokens(text)).alias("k"))
            .groupBy("label").agg(F.sum("k").cast("bigint").alias("n_tokens")))


def class_word_prob(df: DataFrame, label: str = "label", text: str = "words",
                    vocabulary_size: int = K.WCP_VOCABULARY_SIZE) -> DataFrame:
    """A3: ``(label, word, n, prob)`` with ``prob = (1 + n) / (V + tokens_in_class)``.

    The per-class totals (one row per class) are joined back by broadcast when the label
    column is proven to hold few values, so the word counts are never re-shuffled by class
    (a class may hold a third of all words).
    """
    counts = class_word_counts(df, label, text)
    totals = counts.groupBy("label").agg(F.sum("n").alias("n_tokens"))
    small = distinct_at_most(df, [label], MAX_BROADCAST_ROWS)
    return (counts.join(maybe_broadcast(totals, small), "label")
            .select("label", "word", "n",
                    r6((F.col("n") + 1) / (F.col("n_tokens") + vocabulary_size)).alias("prob")))


def class_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def num_classes(df: DataFrame, label: str = "label") -> DataFrame:
    """A4 / L2: distinct non-null labels; unlabelled rows are counted, not made a class."""
    return df.agg(F.count_distinct(label).alias("num_classes"),
                  F.count_if(F.col(label).isNull()).alias("n_unlabelled"))


def corpus_stats(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Rows per split, classes, smallest class size and how many classes have it,
    largest class size, over train union all test. Two small grouped passes, no window."""
    u = (train.select(F.col(label).alias("label"), F.lit(1).alias("tr"), F.lit(0).alias("te"))
         .unionByName(test.select(F.col(label).alias("label"), F.lit(0).alias("tr"), F.lit(1).alias("te"))))
    per_class = (u.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("tr").alias("tr"),
                                        F.sum("te").alias("te"))
                 .withColumn("lab", F.col("label").isNotNull()))
    by_size = per_class.groupBy("n", "lab").agg(F.count(F.lit(1)).alias("k"), F.sum("tr").alias("tr"),
                                                F.sum("te").alias("te"))
    mn = F.min(F.when(F.col("lab"), F.struct("n", "k")))
    return by_size.agg(
        F.sum("tr").cast("bigint").alias("train_rows"),
        F.sum("te").cast("bigint").alias("test_rows"),
        F.coalesce(F.sum(F.when(F.col("lab"), F.col("k"))), F.lit(0)).cast("bigint").alias("num_classes"),
        mn["n"].alias("min_class_size"),
        mn["k"].alias("n_min_classes"),
        F.max(F.when(F.col("lab"), F.col("n"))).alias("max_class_size"),
        F.coalesce(F.sum(F.when(~F.col("lab"), F.col("n"))), F.lit(0)).cast("bigint").alias("n_unlabelled"))


def class_size_histogram(spark: SparkSession, df: DataFrame, label: str = "label") -> DataFrame:
    """For every size 1..largest class size, how many classes have that size (0-filled).

    The size range is generated by ``spark.range`` (distributed), not by exploding one array
    in one task; the distinct sizes (at most one per class) are joined to it.
    """
    sizes = class_sizes(df.where(F.col(label).isNotNull()), label)
    hist = sizes.groupBy(F.col("n").alias("class_size")).agg(F.count(F.lit(1)).alias("n_classes"))
    top = hist.agg(F.max("class_size")).first()[0] or 0
    grid = spark.range(1, top + 1).select(F.col("id").alias("class_size"))
    small = distinct_at_most(df, [label], MAX_BROADCAST_ROWS)
    return (grid.join(maybe_broadcast(hist, small), "class_size", "left")
            .select("class_size", F.coalesce("n_classes", F.lit(0)).cast("bigint").alias("n_classes")))
