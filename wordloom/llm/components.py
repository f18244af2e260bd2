"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.base import release


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``: root is the smallest node that it is linked with, directly or
    not. Alternates large-star and small-star steps, each an aggregation and a join, until nothing changes;
    every round is written to the shared checkpoint folder, nothing is gathered on the driver. Each step replaces links by
    links to smaller nodes, so the sum of all ends falls until the stars are left and the loop ends; it takes about the
    square of the logarithm of the nodes in rounds at worst."""
    def star(e: DataFrame, both: bool) -> DataFrame:
        """Large star (``both``): link every larger neighbour of u to u's smallest neighbour or u itself. Small
        star: link u and its smaller neighbours to the smallest of them."""
        if both:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = e.join(least, "a")
        if both:
            return e.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return (e.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(least.select("a", F.col("m").alias("b"))).distinct())

    e = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if not now[0] or now == before:
            roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        before, e = now, star(star(e, True), False).checkpoint()
        release(links.sparkSession)
