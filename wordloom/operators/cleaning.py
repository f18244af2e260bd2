"""Record-level cleaning (T4-T8) and the table form of the lemma step (T5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as T
from wordloom.operators.common import MAX_BROADCAST_ROWS, has_at_most, maybe_broadcast

# Small English lemma dictionary (surface form -> lemma) standing in for the NLP pipeline's
# lemmatizer. Any (surface, lemma) table can be passed instead.
DEFAULT_LEMMAS: dict[str, str] = {
    "am": "be", "is": "be", "are": "be", "was": "be", "were": "be", "been": "be", "being": "be",
    "has": "have", "had": "have", "having": "have",
    "does": "do", "did": "do", "done": "do", "doing": "do",
    "goes": "go", "went": "go", "gone": "go",
    "made": "make", "makes": "make", "said": "say", "says": "say",
    "children": "child", "people": "person", "men": "man", "women": "woman",
    "better": "good", "best": "good", "worse": "bad", "worst": "bad",
    "explosions": "explosion", "shootings": "shooting", "hurricanes": "hurricane",
    "tornadoes": "tornado", "killed": "kill", "injured": "injure", "storms": "storm",
}


def lemma_table(spark: SparkSession, lemmas: dict[str, str] = DEFAULT_LEMMAS) -> DataFrame:
    return spark.createDataFrame(sorted(lemmas.items()), "surface string, lemma string")


def token_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, pos, token)`` from the word tokenizer after deleting ``#`` (T4, T5 tokenize)."""
    return df.select(F.col(id_col).alias(id_col),
                     F.posexplode(T.word_tokens(T.drop_hash(text))).alias("pos", "token"))


def lemma_join(tokens_df: DataFrame, lemmas: DataFrame, token: str = "token") -> DataFrame:
    """T5 as a join: ``lower(token)`` looked up in a ``(surface, lemma)`` table; a token with
    no entry is its own lemma. The dictionary is broadcast only when it is proven small."""
    small = has_at_most(lemmas, MAX_BROADCAST_ROWS)
    lem = maybe_broadcast(lemmas.select("surface", "lemma"), small)
    return (tokens_df.join(lem, F.lower(F.col(token)) == lem["surface"], "left")
            .drop("surface")
            .withColumn("lemma", F.coalesce(F.col("lemma"), F.col(token))))


def clean_records(df: DataFrame, text: str = "text", lemmas: dict[str, str] | None = DEFAULT_LEMMAS,
                  out: str = "clean") -> DataFrame:
    """``#`` removed, tokenized, lemmatized, filtered (length, stopwords, letters),
    lower-cased and joined by a space; all other columns are kept (no zip, no re-join)."""
    return df.withColumn(out, T.clean_text(F.col(text), lemmas))
