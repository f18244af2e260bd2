"""Standard preparation of the driver tables into labelled text records.

A record is ``(id, text, label)``; the label may be NULL (unlabelled). ``documents`` stands for
the labelled corpus (class = ``lang`` or ``source``), ``labels`` for partial binary labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.hashing import md5_bucket
from wordloom.functions.text import strip_markup, words_only


def word_records(docs: DataFrame, label: str | None = "lang", id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``(doc_id, label, words)``: markup stripped (T1), then words only."""
    lab = F.col(label) if label else F.lit(None).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), lab.alias("label"),
                       words_only(strip_markup(text)).alias("words"))


def split_column(id_col: str = "doc_id", train_buckets: int = 7, buckets: int = 10):
    """Deterministic split, ``md5 bucket < 7 of 10`` -> train, else test."""
    return F.when(md5_bucket(id_col, buckets) < train_buckets, F.lit("train")).otherwise(F.lit("test"))


def fold_column(id_col: str = "doc_id", k: int = 5):
    """Fold number by the same md5 bucket."""
    return md5_bucket(id_col, k)
