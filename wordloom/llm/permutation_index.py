"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of distance (the first ``PREFIX`` of them). The index is
cut into shards of about ``SHARD`` vectors; within a shard every pivot has an inverted file of the vectors that
hold it and its place in their order. For a query the files of its own nearest pivots are read and give every
vector's footrule distance: the sum over pivots of the difference of their places, a missing pivot standing
in place ``PREFIX``. The best ``RERANK`` of a shard by footrule, at least ``MIN_RERANK``, ties with the last included,
are ranked anew by their Euclidean distance in double precision, and the shards' best are merged.

The share reranked is the same at every size, so recall does not fall as the table grows (0.9 is the
least that the tests accept; README has figures). Pivots come from at most ``SAMPLE`` vectors, those first in hash
order of the id, farthest first; every vector is indexed. Queries are a stated set, met by all shards in blocks of
about ``BLOCK`` queries, so a task holds one shard and one block.

Vectors that are null, empty, zero or hold null or non-finite components take no part; queries meet vectors of
their own dimension. Rows that repeat an id count once, with the smallest vector. Ties go to the smaller id. Fewer
than ``k`` candidates are all returned. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.base import register, table

PIVOTS = 128
PREFIX = 64
SAMPLE = 2048
SHARD = 16_384
BLOCK = 1024
RERANK = 0.15
MIN_RERANK = 1000
FOUND = "query_id long, vec_id long, score double"


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine).groupBy("vec_id").agg(F.min(v.cast("array<double>")).alias("v"))
    return rows.withColumn("dim", F.size("v"))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def farthest_first(x: np.ndarray, k: int) -> np.ndarray:
    """k rows, each as far as possible from those chosen before it."""
    chosen, away = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(k, len(x)):
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The numbers of each row's nearest pivots, nearest first."""
    d = (x ** 2).sum(axis=1, keepdims=True) - 2 * x @ pivots.T + (pivots ** 2).sum(axis=1)
    return np.argsort(d, axis=1, kind="stable")[:, :prefix]


class Shard:
    """Inverted files: for each pivot the rows that hold it, and its place in their order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray):
        self.ids, self.x, held = ids, x, orders(x, pivots)
        self.prefix = held.shape[1]
        by_pivot = np.argsort(held.reshape(-1), kind="stable")
        self.rows, self.place = by_pivot // self.prefix, by_pivot % self.prefix
        self.begin = np.searchsorted(held.reshape(-1)[by_pivot], np.arange(len(pivots) + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row to a query's order, less what all rows have in common."""
        out = np.zeros(len(self.ids))
        for at, p in enumerate(order):
            s = slice(self.begin[p], self.begin[p + 1])
            # Both hold p: |at - place| instead of (prefix - at) + (prefix - place).
            out[self.rows[s]] += np.abs(at - self.place[s]) - (2 * self.prefix - at - self.place[s])
        return out

    def search(self, query_id: int, q: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        rank = self.footrule(order)
        n = max(MIN_RERANK, int(np.ceil(RERANK * len(rank))))
        rows = np.flatnonzero(rank <= np.partition(rank, n - 1)[n - 1]) if n < len(rank) else np.arange(len(rank))
        rows = rows[self.ids[rows] != query_id]
        score = np.sqrt(((self.x[rows] - q) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[rows], score))[:k]
        return self.ids[rows[best]], score[best]


def search(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row for which ``is_query`` (a Column) holds."""
    spark = vectors.sparkSession
    rows = valid(vectors).checkpoint()
    n, n_queries = rows.count(), rows.where(is_query).count()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-n_queries // BLOCK))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(r["v"])
    # A dimension that the sample does not hold has no pivots: all its vectors tie and are reranked.
    pivots = spark.sparkContext.broadcast({d: farthest_first(np.array(x), PIVOTS) for d, x in by_dim.items()})

    def one(data: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [np.zeros(0, np.int64)], "vec_id": [np.zeros(0, np.int64)], "score": [np.zeros(0)]}
        if data.num_rows and queries.num_rows:
            dim = data.column("dim")[0].as_py()
            p = pivots.value.get(dim, np.zeros((0, dim)))
            shard = Shard(data.column("vec_id").to_numpy(), matrix(data.column("v"), dim), p)
            x = matrix(queries.column("v"), dim)
            for query_id, q, order in zip(queries.column("vec_id").to_pylist(), x, orders(x, p), strict=True):
                ids, score = shard.search(query_id, q, order, k)
                out["query_id"].append(np.full(len(ids), query_id))
                out["vec_id"].append(ids)
                out["score"].append(score)
        return pa.table({c: np.concatenate(v) for c, v in out.items()})

    numbers = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    deal = lambda size, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(size)).cast("int")
    data = rows.withColumn("shard", deal(shards, 1)).withColumn("block", numbers(blocks)).groupBy("dim", "shard", "block")
    asked = rows.where(is_query).withColumn("shard", numbers(shards)).withColumn("block", deal(blocks, 2)).groupBy("dim", "shard", "block")
    found = data.cogroup(asked).applyInArrow(one, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@register("op6_permutation_index")
def q_permutation_index(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)
