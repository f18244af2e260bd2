"""Deterministic hash buckets that Spark and DuckDB compute identically.

``md5_bucket(x, n)`` takes the first 32 bits of ``md5(x)`` (hex) as an unsigned number and
reduces it modulo ``n``. It is used wherever a bucket must be checkable against SQL (term
buckets, train/test split, folds); the ML path keeps Spark's murmur3 ``HashingTF``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.text import col_

TWO_32 = 4294967296.0


def md5_u32(c, part: int = 0) -> Column:
    """Unsigned 32-bit number cut from hex digits ``8*part+1 .. 8*part+8`` of ``md5(c)``."""
    hx = F.substring(F.md5(col_(c).cast("string")), 8 * part + 1, 8)
    return F.conv(hx, 16, 10).cast("bigint")


def md5_bucket(c, n: int) -> Column:
    return (md5_u32(c) % F.lit(n)).cast("int")


def md5_unit(c, part: int) -> Column:
    """A number in [0, 1) from md5 (fixed pseudo word-vector component)."""
    return md5_u32(c, part) / F.lit(TWO_32)
