"""What the operators of this subpackage share: the registry of their queries, the way a task walks
through Arrow batches, and hashing of words."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wordloom.session import spread

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

#: Rows a task turns into Python objects at a time (an Arrow batch may hold many more).
SLICE = 256
#: Entries a task's word cache holds before it starts afresh.
CACHE_WORDS = 200_000
#: A key is hot if it holds more than one in so many of all rows, so there are fewer hot keys than this.
HOT_ONE_IN = 1000
#: Tasks that share the rows of a hot key.
SALTS = 256


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, spread over the cores where its scan has fewer splits than cores."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def fold(doc_id, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``: the fixed train / held-out split."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def map_slices(df: DataFrame, setup: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str,
               rows: int = SLICE) -> DataFrame:
    """``mapInArrow`` by slices of at most ``rows`` rows, so that a task's Python memory does not follow the
    Arrow batch size. ``setup`` runs once in each task and returns the function of a slice, which returns the
    output columns by name (lists or numpy arrays; all of one length)."""
    struct = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(struct)
        fn = None
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                fn = fn or setup()
                got = fn(batch.slice(at, rows))
                out = pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, struct)


def join_hot(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``many`` joined with ``one``, where the rows of a hot key are dealt over ``SALTS`` tasks. ``one`` has a row for each
    key and in ``n`` how many rows of ``many`` have it; it is read twice, so pass a checkpoint. Keys are not null."""
    total = one.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(one.where(F.col("n") * HOT_ONE_IN > total).select(key, F.lit(True).alias("_hot")))  # under HOT_ONE_IN rows
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]), F.lit(SALTS)).cast("int")
    many = many.withColumn("_salt", salt).join(hot, key, "left")
    many = many.withColumn("_salt", F.when(F.col("_hot"), F.col("_salt")).otherwise(0)).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    one = one.drop("n").join(hot, key, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return many.join(one, [key, "_salt"], how).drop("_salt")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files and checkpoints of tables that nothing refers to any more. It does so
    when the driver's memory is collected, which long chains of small jobs do not bring about by themselves."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [b or b"" for b in texts.cast(pa.binary()).to_pylist()]


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered for the words of the current task within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_windows(ids: np.ndarray, width: int) -> np.ndarray:
    """For each start of a ``width``-long window of ``ids``: does the same window start elsewhere too? Exact:
    windows are ranked by doubling, never compared by hash."""
    n = len(ids) - width + 1
    if n < 2:
        return np.zeros(max(n, 0), bool)
    rank, have = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while have < width:
        step = min(have, width - have)
        pair = rank[:len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        rank, have = np.unique(pair, return_inverse=True)[1].astype(np.int64), have + step
    return np.bincount(rank)[rank] > 1
