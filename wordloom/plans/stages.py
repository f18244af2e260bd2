"""Row-wise stages that let cleaning and word-vector means be part of one saved pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import clean_text
from wordloom.operators.cleaning import DEFAULT_LEMMAS


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """T8 as a stage: ``#`` removed, tokenized, lemmatized, filtered, lower-cased, joined by a space. The lemma dictionary
    is saved with the stage. A null text is cleaned to the empty one."""

    lemmas = Param(Params._dummy(), "lemmas", "surface form -> lemma")

    @keyword_only
    def __init__(self, *, inputCol: str = "text", outputCol: str = "words", lemmas: dict[str, str] | None = None):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, lemmas=DEFAULT_LEMMAS if lemmas is None else lemmas)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), F.coalesce(clean_text(F.col(self.getInputCol()), self.getOrDefault(self.lemmas)), F.lit("")))


class KnownWordMean(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """D2 as a stage: turns Spark's mean over *all* tokens (``inputCol``) into the mean over the *known* ones, by the number of
    tokens over that of known ones (the sum of the vector ``knownCol``). Texts without known words are dropped."""

    tokensCol = Param(Params._dummy(), "tokensCol", "tokens of a text")
    knownCol = Param(Params._dummy(), "knownCol", "counts of the known words")

    @keyword_only
    def __init__(self, *, inputCol: str = "_w2v", outputCol: str = "features", tokensCol: str = "_toks", knownCol: str = "_known"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, tokensCol=tokensCol, knownCol=knownCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        known = F.aggregate(F.transform(vector_to_array(F.col(self.getOrDefault(self.knownCol))), lambda x: x), F.lit(0.0), lambda s, x: s + x)
        factor = F.size(self.getOrDefault(self.tokensCol)) / F.col("_n_known")
        return (df.withColumn("_n_known", known).where(F.col("_n_known") > 0)
                .withColumn(self.getOutputCol(), array_to_vector(F.transform(vector_to_array(F.col(self.getInputCol())), lambda x: x * factor)))
                .drop("_n_known", self.getInputCol(), self.getOrDefault(self.knownCol)))
