"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest number of rows a side may have to be broadcast on the strength of a bound check.
MAX_BROADCAST_ROWS = 200_000
# Largest estimated size of a counted table (model vectors, word counts) forced into a broadcast.
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """Bounded check: reads at most ``max_rows + 1`` rows of ``df``."""
    return df.limit(max_rows + 1).count() <= max_rows


def distinct_at_most(df: DataFrame, cols, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``cols`` of ``df`` take at most ``max_rows`` distinct values.

    Only the named columns are read (column pruning), so this is cheap next to the job it
    guards; the aggregate stops early once the bound is crossed.
    """
    return has_at_most(df.select(*cols).distinct(), max_rows)


def fits_broadcast(n_rows: int | None, row_bytes: int) -> bool:
    """A counted table may be broadcast when ``rows x estimated row size`` is within the byte bound."""
    return n_rows is not None and n_rows * row_bytes <= MAX_BROADCAST_BYTES


# Words that :func:`frequent_words` names at most, and counters of its sketch.
FREQUENT_WORDS = 1000
SKETCH_ITEMS = 10_000


def frequent_words(toks: DataFrame, word: str = "word", n: int = FREQUENT_WORDS) -> list[str]:
    """At most ``n`` of the most frequent words, from one pass with a frequency sketch per task (the sketches merge). A
    word that the sketch names by mistake, or misses, costs time alone: callers treat the others alike."""
    got = toks.agg(F.expr(f"approx_top_k(`{word}`, {n}, {max(SKETCH_ITEMS, n)})").alias("top")).first()["top"]
    return sorted(x["item"] for x in got or [] if x["item"] is not None)


def join_words(toks: DataFrame, table: DataFrame, keys: list[str], n_rows: int | None, row_bytes: int,
               count: str, how: str = "inner", known: DataFrame | None = None) -> DataFrame:
    """Rows ``(*keys, word)`` joined with ``table`` on ``word``, whatever the size of either; ``count`` says for how many
    rows each stands.

    A table proven small is broadcast. Otherwise the frequent words, of which there is a fixed number, meet their rows of
    the table by broadcast where they are, so no task gets all rows of a word that every text has; so do the words of
    ``known(word)``, a part of the table that the caller knows to be small and often met. Only the other words are shuffled,
    once. Callers sum the union."""
    if fits_broadcast(n_rows, row_bytes):
        return toks.join(F.broadcast(table), "word", how).withColumn(count, F.lit(1))
    n = max(1, min(FREQUENT_WORDS, MAX_BROADCAST_BYTES // row_bytes))
    hot = toks.sparkSession.createDataFrame([(w,) for w in frequent_words(toks, n=n)], "word string")
    if known is not None:
        hot = hot.union(known.select("word")).distinct()
    often = toks.join(F.broadcast(hot), "word", "left_semi").join(F.broadcast(table.join(F.broadcast(hot), "word", "left_semi")), "word", how)
    rest = toks.join(F.broadcast(hot), "word", "left_anti").join(table, "word", how)
    return often.unionByName(rest).withColumn(count, F.lit(1).cast("bigint"))


def maybe_broadcast(small: DataFrame, proven_small: bool) -> DataFrame:
    """Broadcast only behind a proven bound; otherwise leave the choice to AQE at runtime."""
    return F.broadcast(small) if proven_small else small


def r6(c):
    """Round a double to 6 places (result tables are compared after this rounding)."""
    return F.round(c, 6)


def bounded_distinct(df: DataFrame, col: str, max_rows: int = MAX_BROADCAST_ROWS) -> list | None:
    """Sorted distinct non-null values of one column when there are at most ``max_rows`` of
    them (a one-column job), else None."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return sorted(r[0] for r in rows)


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Cut lineage with a reliable checkpoint (written to the shared checkpoint folder) and
    return the written table with its row count (a proven size for broadcast decisions)."""
    out = df.checkpoint(eager=True)
    return out, out.count()
