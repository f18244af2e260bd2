from pyspark.sql import functions as F
from pyspark.sql import Window

from wordloom import constants as K
from wordloom.operators import labels as L
from wordloom.operators import stats


def test_label_dictionary_train_first(spark):
    df = spark.createDataFrame([("b", "train"), ("a", "train"), ("z", "test"), ("a", "test"), ("c", "test")],
                               "raw_label string, split string")
    d = {r["raw_label"]: r["label"] for r in L.label_dictionary(df, "raw_label", "split", ["train", "test"]).collect()}
    assert d == {"a": 0.0, "b": 1.0, "c": 2.0, "z": 3.0}   # test-only labels after every train label


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id")).repartition(6)
    got = L.global_row_number(spark, df, ["k", "id"], "rn").select("k", "rn")
    want = df.select("k", F.row_number().over(Window.orderBy("k", "id")).alias("rn"))
    assert got.exceptAll(want).count() == 0 and got.count() == 5000


def test_batch_counts(spark):
    df = spark.range(0, 123).select(F.format_string("k%04d", "id").alias("key"))
    rows = sorted(tuple(r) for r in L.batch_counts(spark, df, ["key"], 50).collect())
    assert rows == [(0, 50, 50), (1, 50, 100), (2, 23, 123)]


def test_label_names_and_remap(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.0,), (15.0,), (None,)], "label double")
    names = [r["label_name"] for r in L.label_names(spark, df).orderBy(F.col("label").asc_nulls_last()).collect()]
    assert names == [K.DEFAULT_LABEL_NAME, "ChinaFactoryExplosion", "NewYorkFirefighterShooting",
                     K.DEFAULT_LABEL_NAME, K.DEFAULT_LABEL_NAME]
    remapped = [r["label"] for r in L.remap_labels(spark, df, {0.0: 9.0}).orderBy(F.col("label").asc_nulls_last()).collect()]
    assert sorted(x for x in remapped if x is not None) == [1.0, 9.0, 9.0, 15.0]


def test_corpus_stats_and_histogram(spark):
    tr = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "label string")
    te = spark.createDataFrame([("c",), ("a",)], "label string")
    r = stats.corpus_stats(tr, te).first().asDict()
    assert r == {"train_rows": 4, "test_rows": 2, "num_classes": 3, "min_class_size": 1, "n_min_classes": 2,
                 "max_class_size": 3, "n_unlabelled": 1}
    h = [tuple(x) for x in stats.class_size_histogram(spark, tr.unionByName(te)).orderBy("class_size").collect()]
    assert h == [(1, 2), (2, 0), (3, 1)]


def test_class_word_prob_formula(spark):
    df = spark.createDataFrame([(0, "x", "a b a"), (1, "y", "b")], "doc_id int, label string, words string")
    got = {(r["label"], r["word"]): (r["n"], r["prob"]) for r in stats.class_word_prob(df).collect()}
    assert got[("x", "a")] == (2, round(3 / 5003, 6)) and got[("y", "b")] == (1, round(2 / 5001, 6))


def test_running_total_by_two_levels(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3000).alias("k"), F.when(F.col("id") % 7 != 0, F.col("id") % 11).alias("v")).repartition(6)
    got = L.running_total(df, ["k"], "v").select("k", "running_total")
    want = df.select("k", F.sum(F.coalesce("v", F.lit(0))).over(Window.orderBy("k")).alias("running_total"))
    assert got.exceptAll(want).count() == 0 and got.count() == 3000
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert L.running_total(df.limit(0), ["k"], "v").count() == 0
