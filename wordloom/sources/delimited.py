"""Delimited text sources (S1-S5) and the cleaned-text sink (K3).

Every reader is split in two: a *parser* (Column expressions over one line, usable on any
DataFrame with a line column) and a thin ``read_*`` that feeds it from ``spark.read.text``.
Rows the original silently dropped or failed on are kept apart in a ``_rejected`` flag
instead of vanishing (D6); ``good()`` / ``rejected()`` select either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import col_, java_split, java_trim

RECORD_COLS = ["id", "text", "label"]


def line_ids() -> Column:
    """Id for lines read from files (D4): the line's position in the scan
    (``monotonically_increasing_id``: partition index in the high bits, row in the low bits),
    unique across the read and repeatable for the same files and split settings."""
    return F.monotonically_increasing_id().cast("string")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"), line_ids().alias("line_id"))


def parse_label_text(df: DataFrame, line: str = "line", delim: str = "|", id_col: str = "line_id") -> DataFrame:
    """``label<delim>text``; exactly two parts and a numeric label, else rejected."""
    parts = java_split(col_(line), delim)
    lab = F.try_element_at(parts, F.lit(1)).try_cast("double")
    ok = (F.size(parts) == 2)
    return df.select(F.col(id_col).cast("string").alias("id"),
                     F.when(ok, F.try_element_at(parts, F.lit(2))).alias("text"),
                     F.when(ok, lab).alias("label"),
                     (~ok | lab.isNull()).alias("_rejected"))


def parse_label_id_text(df: DataFrame, line: str = "line") -> DataFrame:
    """``label|id|text``: the third part is the text (text after a further ``|`` is cut,
    as in the original); fewer than three parts or a non-numeric label is rejected."""
    parts = java_split(col_(line), "|")
    ok = F.size(parts) >= 3
    lab = F.try_element_at(parts, F.lit(1)).try_cast("double")
    return df.select(F.when(ok, F.try_element_at(parts, F.lit(2))).alias("id"),
                     F.when(ok, F.try_element_at(parts, F.lit(3))).alias("text"),
                     F.when(ok, lab).alias("label"),
                     (~ok | lab.isNull()).alias("_rejected"))


def parse_mixed(df: DataFrame, line: str = "line", id_col: str = "line_id", overlap: bool = False) -> DataFrame:
    """S3 (+P3, U1): rows of exactly three ``"; "`` parts ``(raw_label, id, text)`` union all rows
    of exactly two ``|`` parts ``(raw_label, text)`` whose id comes from ``id_col``.

    Formats are exclusive by default, ``"; "`` first (D6); ``overlap=True`` keeps the original
    behaviour where a line matching both is read twice. One pass over the input: the two
    parses are generated per line and exploded, which is a union all without a second scan.
    Lines matching neither are kept once with ``_rejected`` set.
    """
    semi = java_split(col_(line), "; ")
    pipe = java_split(col_(line), "|")
    is_semi = F.size(semi) == 3
    is_pipe = F.size(pipe) == 2
    if not overlap:
        is_pipe = is_pipe & ~is_semi
    a = F.struct(F.try_element_at(semi, F.lit(1)).alias("raw_label"), F.try_element_at(semi, F.lit(2)).alias("id"),
                 F.try_element_at(semi, F.lit(3)).alias("text"), F.lit("semi").alias("fmt"),
                 is_semi.alias("keep"), F.lit(False).alias("_rejected"))
    b = F.struct(F.try_element_at(pipe, F.lit(1)).alias("raw_label"), F.col(id_col).cast("string").alias("id"),
                 F.try_element_at(pipe, F.lit(2)).alias("text"), F.lit("pipe").alias("fmt"),
                 is_pipe.alias("keep"), F.lit(False).alias("_rejected"))
    r = F.struct(F.lit(None).cast("string").alias("raw_label"), F.col(id_col).cast("string").alias("id"),
                 col_(line).alias("text"), F.lit(None).cast("string").alias("fmt"),
                 (~is_semi & ~(F.size(pipe) == 2)).alias("keep"), F.lit(True).alias("_rejected"))
    return (df.select(F.explode(F.filter(F.array(a, b, r), lambda x: x["keep"])).alias("p"))
            .select("p.raw_label", "p.id", "p.text", "p.fmt", "p._rejected"))


def parse_key_text(df: DataFrame, line: str = "line") -> DataFrame:
    """``key;text`` split at the first ``;`` only; a line without ``;`` is rejected."""
    parts = F.split(col_(line), ";", 2)
    ok = F.size(parts) == 2
    return df.select(F.try_element_at(parts, F.lit(1)).alias("key"),
                     F.when(ok, F.try_element_at(parts, F.lit(2))).alias("text"),
                     (~ok).alias("_rejected"))


def parse_transaction(c) -> Column:
    """Trim, split on one space, distinct items keeping first-seen order."""
    return F.array_distinct(java_split(java_trim(col_(c)), " "))


def good(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_rejected")).drop("_rejected")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("_rejected")).drop("_rejected")


def read_label_text(spark: SparkSession, path: str, delim: str = "|") -> DataFrame:
    return parse_label_text(read_lines(spark, path), delim=delim)


def read_label_id_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_label_id_text(read_lines(spark, path))


def read_mixed(spark: SparkSession, path: str, overlap: bool = False) -> DataFrame:
    return parse_mixed(read_lines(spark, path), overlap=overlap)


def read_key_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_key_text(read_lines(spark, path))


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path).select("line_id", parse_transaction("line").alias("items"))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One stopword per line (kept verbatim, as the original reads them)."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def write_key_lines(df: DataFrame, path: str, key: str = "key", text: str = "clean") -> None:
    """K3: ``key;cleaned`` lines as a text data set (one part file per task, no collect)."""
    df.select(F.concat_ws(";", F.col(key), F.col(text)).alias("value")).write.mode("overwrite").text(path)
