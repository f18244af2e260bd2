"""Model queries have no SQL oracle; check invariants on the driver's small tables."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_MID
from wordloom.operators import features as FT
from wordloom.plans import models as MD
from wordloom.plans import q_models as QM


@pytest.fixture(scope="module")
def split(spark):
    return QM._train_test(spark, SF_MID)


def test_tfidf_lr_invariants(spark, split):
    train, test = split
    res = MD.run_tfidf(train, test)
    pred = res.predictions
    n_classes = train.select("label").distinct().count()
    probs = pred.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b).alias("s"))
    assert probs.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0
    assert pred.where((F.col("prediction") < 0) | (F.col("prediction") >= n_classes)).count() == 0
    acc = MD.metric_row(res).first()["micro_f1"]
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert acc > majority


def test_w2v_same_seed_same_vectors(spark, split):
    train, _ = split
    small = train.orderBy("doc_id").limit(200).cache()
    a = MD.word_vectors(MD.fit_word2vec(small, vector_size=10, num_partitions=1))
    b = MD.word_vectors(MD.fit_word2vec(small, vector_size=10, num_partitions=1))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_w2v_vocabulary_is_min_count(spark, split):
    train, _ = split
    small = train.orderBy("doc_id").limit(150).cache()
    from wordloom.functions.text import tokens
    want = (small.select(F.explode(tokens("words")).alias("w")).groupBy("w").count()
            .where(F.col("count") >= 5).count())
    got = MD.word_vectors(MD.fit_word2vec(small, vector_size=5)).count()
    assert got == want


def test_algorithm_factory(spark):
    from pyspark.ml.classification import LogisticRegression, OneVsRest
    assert isinstance(MD.algorithm("logbfgs", 10, 1.0, 0.0), LogisticRegression)
    assert isinstance(MD.algorithm("svm", 10, 1.0, 0.0), OneVsRest)
    with pytest.raises(ValueError):
        MD.algorithm("tree", 1, 1.0, 0.0)


def test_model_roundtrip_same_predictions(spark, split, tmp_dir):
    from pyspark.ml import Pipeline
    train, test = split
    model = Pipeline(stages=MD.tfidf_stages() + [MD.logistic()]).fit(train)
    path = tmp_dir + "/m"
    MD.load_or_fit(path, lambda: model)
    loaded = MD.load_or_fit(path, lambda: None)
    a = model.transform(test).select("doc_id", "prediction")
    b = loaded.transform(test).select("doc_id", "prediction")
    assert a.exceptAll(b).count() == 0


def test_registered_model_queries_run(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ["lr_predict_tfidf", "experiment_single", "model_roundtrip"]:
        assert q[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("classes", [2, 10])
def test_pivot_rows_give_the_models_own_predictions(spark, classes):
    from pyspark.ml.functions import array_to_vector
    from wordloom.operators import scoring
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").where(F.col("label") < classes)
    e = e.select("vec_id", F.col("label").cast("double").alias("label"), F.col("embedding").cast("array<double>").alias("f"))
    model = MD.logistic().fit(e.withColumn("features", array_to_vector("f")))
    own = model.transform(e.withColumn("features", array_to_vector("f"))).select("vec_id", "prediction")
    got = scoring.legacy_scores(e, MD.pivot_rows(model), "f").select("vec_id", F.col("prediction").alias("raw"))
    assert got.join(own, "vec_id").where(F.col("raw") != F.col("prediction")).count() == 0


def test_load_or_fit_refits_only_when_absent(spark, tmp_dir):
    from pyspark.ml import Pipeline
    import os
    path, df = tmp_dir + "/model", spark.createDataFrame([(0, "a b")], "label int, words string")
    fits = []

    def fit():
        fits.append(1)
        return Pipeline(stages=MD.tfidf_stages()).fit(df)
    MD.load_or_fit(path, fit)
    MD.load_or_fit(path, fit)
    assert len(fits) == 1
    os.makedirs(tmp_dir + "/broken")
    with pytest.raises(Exception):
        MD.load_or_fit(tmp_dir + "/broken", fit)
    assert len(fits) == 1


def test_grid_and_report_cover_all_folds(spark, monkeypatch):
    """Every document is tested once for each feature kind; the fits are left out."""
    def no_fit(train, test):
        return MD.RunResult(test.withColumn("prediction", F.col("label").cast("double")), 0.0, 0.0)
    monkeypatch.setattr(MD, "run_tfidf", no_fit)
    monkeypatch.setattr(MD, "run_w2v", no_fit)
    n = QM._records(spark, SF_SMALL).where("label is not null").count()
    rows = QM.q_experiment_grid(spark, SF_SMALL).collect()
    cells = {(f, str(k)) for f in ("tfidf", "w2v") for k in range(5)}
    assert len(rows) == 10 and {(r["feature"], r["suffix"]) for r in rows} == cells
    assert all(sum(r["n_rows"] for r in rows if r["feature"] == f) == n for f in ("tfidf", "w2v"))
    report = QM.q_experiment_report(spark, SF_SMALL).collect()
    for section in ("per set", "ALL"):
        assert sorted((r["feature"], r["suffix"]) for r in report if r["section"] == section) == sorted(cells)


def test_one_saved_model_from_raw_text_to_label(spark, tmp_dir):
    """T8, Word2Vec, mean over known words and logistic regression in one pipeline: saved, loaded in another session, used by
    the stream's scorer; its means are those of the relational form."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    from wordloom.functions.text import clean_text
    from wordloom.operators import features as FT
    from wordloom.operators.cleaning import DEFAULT_LEMMAS
    from wordloom.streaming import scorer
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    index = {"de": 0.0, "en": 1.0, "es": 2.0, "fr": 3.0}
    label = F.element_at(F.create_map(*[x for kv in index.items() for x in map(F.lit, kv)]), F.col("lang"))
    train = docs.select("doc_id", "text", label.alias("label"))
    model = MD.text_pipeline(train, num_partitions=1)
    model.save(tmp_dir + "/model")
    other = spark.newSession()
    loaded = PipelineModel.load(tmp_dir + "/model")
    again = loaded.transform(other.read.parquet(f"{SF_SMALL}/documents.parquet"))
    first = {r["doc_id"]: r["prediction"] for r in model.transform(docs).select("doc_id", "prediction").collect()}
    assert {r["doc_id"]: r["prediction"] for r in again.select("doc_id", "prediction").collect()} == first
    right = [first[r["doc_id"]] == r["label"] for r in train.collect() if r["doc_id"] in first]
    assert sum(right) > 0.85 * len(right) > 0.85 * 0.9 * docs.count()
    words = docs.select("doc_id", clean_text(F.col("text"), DEFAULT_LEMMAS).alias("words"))
    want = {r["doc_id"]: r["features"] for r in FT.doc_vector_mean(words, MD.word_vectors(model.stages[2]), dim=100).collect()}
    got = {r["doc_id"]: r["f"] for r in model.transform(docs).select("doc_id", vector_to_array("features").alias("f")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 1e-9 for k in want for x, y in zip(got[k], want[k]))
    keyed = docs.select("doc_id", "source", "text")
    scored = scorer.pipeline_scorer(loaded, names=False)(keyed)
    assert {r["row_key"].rsplit("-", 1)[1]: float(r["prediction"]) for r in scored.collect()} == {str(k): v for k, v in first.items()}


def test_similar_words_among_all(spark):
    """O1: the same neighbours as the model's own search, for many words at once."""
    from wordloom.operators.corpus import word_records
    model = MD.fit_word2vec(word_records(spark.read.parquet(f"{SF_SMALL}/documents.parquet")), vector_size=10, num_partitions=1)
    asked = spark.createDataFrame([("the",), ("der",), ("no such word",)], "word string")
    got = {}
    for r in MD.similar_words(model, asked, 5).orderBy("of", "rank").collect():
        got.setdefault(r["of"], []).append(r["word"])
    assert sorted(got) == ["der", "the"]
    for w, near in got.items():
        assert near == [r["word"] for r in model.findSynonyms(w, 5).collect()]


def test_word_vector_means_without_a_join(spark):
    """The vectors are read by the tasks in blocks: the plan neither joins nor broadcasts them; rows of one id are one text."""
    rows = [(i, "xy"[i % 2], f"a b c{i % 4} d{i}") for i in range(40)] + [(None, "x", "a"), (None, "x", "b zz"), (7, "y", "c1 c1"), (90, "x", "zz"), (91, None, "a a b"), (92, "x", ""), (93, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, label string, words string")
    model = MD.fit_word2vec(df.dropna(subset=["words"]), vector_size=6, min_count=2, num_partitions=1)
    want = FT.doc_vector_mean(df, MD.word_vectors(model), dim=6, carry=("label",)).collect()
    for block_bytes in (MD.BLOCK_BYTES, 40):
        got = MD.w2v_features(model, df, block_bytes=block_bytes)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "MapInArrow" in plan
        found = {(r["doc_id"], r["label"]): r["features"].toArray().tolist() for r in got.collect()}
        assert len(found) == len(want) == 43
        for r in want:
            assert found[r["doc_id"], r["label"]] == pytest.approx(r["features"])
