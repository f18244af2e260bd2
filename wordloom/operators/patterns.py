"""Baskets, frequent item sets and pattern-presence features."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators.common import MAX_BROADCAST_ROWS, has_at_most, maybe_broadcast


# Patterns whose inverted list is broadcast on the strength of a count.
MAX_INDEX_ROWS = 20_000


def baskets(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Transactions ``(l_orderkey, items)``: the distinct brands of an order in first-seen
    (line number) order.

    Brands are first reduced per (order, brand), so a huge order is spread over brand keys
    and the per-order list is bounded by the number of distinct brands, never by its lines.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    pt = part.select("p_partkey", "p_brand")
    firsts = (li.join(pt, li["l_partkey"] == pt["p_partkey"])
              .groupBy("l_orderkey", "p_brand").agg(F.min("l_linenumber").alias("first_line")))
    per_order = firsts.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("first_line", "p_brand"))).alias("s"))
    return per_order.select("l_orderkey", F.transform("s", lambda x: x["p_brand"]).alias("items"))


def frequent_itemsets(transactions: DataFrame, items: str = "items", min_support: float = K.FP_MIN_SUPPORT,
                      num_partitions: int | None = None) -> DataFrame:
    """FP-growth item sets ``(items, freq)``; items sorted inside each set.

    ``num_partitions`` (conditional-tree partitions) defaults to the input's partitioning, so
    the tree building scales with the cluster; the original fixed it at
    ``constants.FP_NUM_PARTITIONS``."""
    fp = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=1.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(transactions.select(items))
    return model.freqItemsets.select(F.sort_array("items").alias("items"), F.col("freq").cast("bigint").alias("freq"))


def pattern_flags(docs: DataFrame, tokens_col: str, patterns: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, pattern_id, flag=1.0)`` for every text that holds all items of a pattern.

    Texts are first reduced to those of their distinct tokens that some pattern has. An inverted list has each pattern
    once, under its rarest item (the one that the fewest texts hold, ties to the smaller item; a pattern with an item that
    no text holds is left out). A text looks up its tokens there, so it meets only patterns whose rarest item
    it has, and compares these with its tokens in the row. Only present patterns are emitted.
    ``patterns`` is ``(pattern_id, items array<string>)``, of any number; a pattern without items is never present."""
    wanted = patterns.select("pattern_id", F.array_distinct("items").alias("items")).where(F.size("items") > 0).checkpoint()
    items = wanted.select(F.explode("items").alias("token")).distinct()
    each = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.array_distinct(tokens_col)).alias("token"))
    held = (each.join(maybe_broadcast(items, has_at_most(items, MAX_BROADCAST_ROWS)), "token", "left_semi")
            .groupBy("doc_id").agg(F.collect_set("token").alias("held")).checkpoint())
    each = held.select("doc_id", F.explode("held").alias("token"))
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    entries = wanted.select("pattern_id", "items", F.explode("items").alias("token")).join(often, "token", "left")
    index = (entries.groupBy("pattern_id").agg(F.min_by("token", F.struct("n", "token")).alias("token"), F.first("items").alias("items"),
                                               F.count("n").alias("known"))
             .where(F.col("known") == F.size("items")).select("token", "pattern_id", "items").checkpoint())
    flag = F.lit(1.0).alias("flag")
    if has_at_most(index, MAX_INDEX_ROWS):  # the pattern is compared where its token is met: nothing is shuffled or gathered
        near = held.select("doc_id", "held", F.explode("held").alias("token")).join(F.broadcast(index), "token")
        return near.where(F.size(F.array_except("items", "held")) == 0).select("doc_id", "pattern_id", flag)
    met = each.join(index, "token").groupBy("doc_id").agg(F.collect_list(F.struct("pattern_id", "items")).alias("met"))
    present = F.filter("met", lambda p: F.size(F.array_except(p["items"], F.col("held"))) == 0)
    both = met.withColumnRenamed("doc_id", "_id").join(held, F.col("_id").eqNullSafe(F.col("doc_id")))
    return both.select("doc_id", F.explode(F.transform(present, lambda p: p["pattern_id"])).alias("pattern_id")).select("doc_id", "pattern_id", flag)
