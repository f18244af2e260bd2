"""From raw documents to packed sequences, in five stages.

Each stage takes the documents that its predecessor kept, and returns documents again (the last one the packed
pieces). Between the stages they are written as Parquet to the shared checkpoint folder, so that a lost executor
costs a stage at most.

Texts may be null or empty, tables empty and rows repeated: see the operators. Rows that share an id are kept or
rejected together by the first two stages; of rows that repeat id and text one stays. Rows without an id pass both.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import near_dup, packing, quality, secrets, substrings
from wordloom.session import ensure_checkpoint_dir, scratch_path, ship_package, spread

TOKENIZER = "word_bpe_49k.json"
#: Bytes of the shortest passage that counts as repeated: about what 51 words take.
PASSAGE = 200


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = quality.classify(spread(docs), labels).where("predicted = 0").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates."""
    copies = near_dup.near_duplicates(spread(docs)).where("is_copy").select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").withColumn("_same", F.xxhash64("text"))
    return kept.dropDuplicates(["doc_id", "_same"]).select(docs.columns)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document, or the same one earlier on, has already."""
    return substrings.cut(spread(docs), keep="first", length=PASSAGE)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked."""
    docs = spread(docs)
    return secrets.redact(docs, secrets.fit(secrets.samples(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(packing.token_pieces(spread(docs), public_tokenizers.path(TOKENIZER)))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("near-dedup", one_of_each),
    ("suffix-array dedup", no_repeated_passages),
    ("secret scans", no_secrets),
    ("packing", packed),
]

#: SQL expresses neither the classifier nor the genetic packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
