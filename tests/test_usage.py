"""The README's file -> classifier -> reject option -> metrics example, end to end."""

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordloom.operators import metrics, scoring
from wordloom.operators.corpus import split_column, word_records
from wordloom.plans import models
from wordloom.session import table
from wordloom.sources import delimited as D


def test_readme_file_to_metrics(spark, tmp_dir):
    d = table(spark, SF_SMALL, "documents")
    d.select(F.concat_ws("|", F.when(F.col("lang") == "en", "1").otherwise("2"),
                         F.regexp_replace("text", "[|\\n]", " "))).write.mode("overwrite").text(tmp_dir + "/train")
    recs = D.good(D.read_label_text(spark, tmp_dir + "/train", delim="|"))
    recs = word_records(recs, label="label", id_col="id")
    train, test = recs.where(split_column() == "train"), recs.where(split_column() == "test")
    model = Pipeline(stages=models.tfidf_stages() + [models.logistic()]).fit(train)
    rows = models.pivot_rows(model.stages[-1])
    scored = scoring.legacy_scores(model.transform(test).withColumn("f", vector_to_array("features")), rows, "f")
    m = metrics.overall(scored.select("label", F.col("final").alias("prediction"))).first()
    assert m["n_rows"] == test.count() > 0
    assert 0.0 <= m["micro_f1"] <= 1.0 and m["n_unlabelled"] == 0
