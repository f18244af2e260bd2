import pytest
from pyspark.sql import functions as F

from wordloom.operators import features as FT
from wordloom.operators import patterns as P


def test_doc_vector_mean_known_words_only(spark):
    docs = spark.createDataFrame([(1, "x unknown x"), (2, "nothing here")], "doc_id int, words string")
    vecs = spark.createDataFrame([("x", [2.0, 4.0]), ("y", [0.0, 0.0])], "word string, vector array<double>")
    out = {r["doc_id"]: r["features"] for r in FT.doc_vector_mean(docs, vecs).collect()}
    assert out == {1: [2.0, 4.0]}      # unknown words skipped, text without known words dropped


def test_spark_w2v_transform_differs(spark):
    """Spark's Word2VecModel.transform divides by all tokens; ours by known tokens only."""
    from pyspark.ml.feature import Word2Vec
    df = spark.createDataFrame([(["a", "b"] * 10,)] * 5, "t array<string>")
    m = Word2Vec(vectorSize=3, minCount=1, seed=1, inputCol="t", outputCol="v").fit(df)
    va = [r["vector"] for r in m.getVectors().collect() if r["word"] == "a"][0]
    half = m.transform(spark.createDataFrame([(["a", "zzz"],)], "t array<string>")).first()["v"]
    assert list(half) == pytest.approx([x / 2 for x in va])


def test_hash_tf_counts_all_tokens(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "")], "doc_id int, words string")
    tf = FT.hash_tf(docs)
    tot = {r["doc_id"]: r["s"] for r in tf.groupBy("doc_id").agg(F.sum("tf").alias("s")).collect()}
    assert tot == {1: 3, 2: 1}     # "" splits to [""], one empty token


def test_pad(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0] * 80,)], "f array<double>")
    with pytest.raises(Exception, match="longer than 5"):
        FT.pad_features(df, "f", 5).collect()
    rows = FT.pad_features(df, "f", 5, over="null").collect()
    assert rows[0]["f"] == [1.0, 2.0, 0.0, 0.0, 0.0] and rows[1]["f"] is None
    assert FT.pad_features(df, "f", 5, over="truncate").collect()[1]["f"] == [1.0] * 5


def test_pattern_flags_sparse(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"])], "doc_id int, toks array<string>")
    pats = spark.createDataFrame([(0, ["a", "b"]), (1, ["a"]), (2, ["z"])], "pattern_id int, items array<string>")
    got = sorted((r["doc_id"], r["pattern_id"]) for r in P.pattern_flags(docs, "toks", pats).collect())
    assert got == [(1, 0), (1, 1), (2, 1)]


def test_pattern_flags_against_all_pairs(spark):
    """Repeated items and tokens, patterns without items or with unknown ones, ties of rarity, texts without tokens."""
    import random
    rng = random.Random(4)
    texts = [(i, [f"w{min(rng.randrange(30), rng.randrange(30))}" for _ in range(rng.randrange(12))]) for i in range(150)] + [(150, None), (151, [])]
    sets = [(k, [f"w{rng.randrange(31)}" for _ in range(rng.randrange(5))]) for k in range(80)]
    got = P.pattern_flags(spark.createDataFrame(texts, "doc_id int, toks array<string>"), "toks", spark.createDataFrame(sets, "pattern_id int, items array<string>"))
    assert sorted((r["doc_id"], r["pattern_id"]) for r in got.collect()) == [(i, k) for i, t in texts for k, s in sets if s and set(s) <= set(t or [])]


def test_pattern_flags_are_found_where_the_tokens_are(spark, monkeypatch):
    texts = spark.createDataFrame([(1, ["a", "b"]), (1, ["c"]), (None, ["a"]), (None, ["c"]), (2, ["b", None]), (3, [])], "doc_id int, toks array<string>")
    sets = spark.createDataFrame([(0, ["a", "c"]), (1, ["b"]), (2, ["b", "x"]), (3, [])], "pattern_id int, items array<string>")
    flags = P.pattern_flags(texts, "toks", sets)
    assert "Exchange hashpartitioning" not in flags._jdf.queryExecution().toString()
    got = sorted(map(str, flags.collect()))
    monkeypatch.setattr(P, "MAX_INDEX_ROWS", 0)
    assert got == sorted(map(str, P.pattern_flags(texts, "toks", sets).collect()))
    assert len(got) == 4


def test_wcp_scores_smoothing(spark):
    import math
    tr = spark.createDataFrame([(0, "x", "a a b"), (1, "y", "b")], "doc_id int, label string, words string")
    te = spark.createDataFrame([(9, None, "a c")], "doc_id int, label string, words string")
    got = {r["label"]: r["score"] for r in FT.class_log_scores(tr, te).collect()}
    assert got["x"] == pytest.approx(math.log(3 / 5003) + math.log(1 / 5003))
    assert got["y"] == pytest.approx(2 * math.log(1 / 5001))


def test_similar_topk(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [0.9, 0.1]), (3, 0, [0.0, 1.0])],
                               "vec_id int, label int, embedding array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "label int, query array<double>")
    got = [r["vec_id"] for r in FT.similar_topk(df, q, 2).orderBy("rank").collect()]
    assert got == [1, 2]


def test_similar_topk_searches_all_rows_in_blocks(spark):
    """Rows of every label, many tasks, query blocks of two; null, zero, short and repeated vectors."""
    import numpy as np
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).round(2)
    rows = [(i, i % 3, v.tolist()) for i, v in enumerate(x)] + [(300, 0, None), (301, 0, [0.0] * 8), (302, 1, [1.0]), (303, 2, x[5].tolist()), (304, 0, [float("nan")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(7)
    q = spark.createDataFrame([(i, x[i].tolist()) for i in (5, 17, 90, 205, 299)], "label long, query array<double>")
    for own in (False, True):
        got = FT.similar_topk(df, q, 4, skip_own=own, block_bytes=2 * 8 * 8)
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
        found = {(r["label"], r["rank"]): r["vec_id"] for r in got.collect()}
        for key in (5, 17, 90, 205, 299):
            score = [(-float(np.dot(v, x[key]) / np.linalg.norm(v) / np.linalg.norm(x[key])), i) for i, _, v in rows if v and len(v) == 8 and any(v) and v[0] == v[0] and not (own and i == key)]
            want = [i for _, i in sorted((round(s, 12), i) for s, i in score)[:4]]
            assert [found[key, r] for r in (1, 2, 3, 4)] == want
    assert FT.similar_topk(df, q.limit(0), 4).count() == 0


def test_words_meet_large_tables_the_same_way(spark, monkeypatch):
    """Above the broadcast bound frequent words meet the table apart from the others: same means and scores, and the frequent
    word is not shuffled."""
    from wordloom.operators import common as CM
    words = [" ".join(["the"] * 5 + [f"w{i % 40}", f"v{i % 7}", f"u{i}"]) for i in range(200)]
    df = spark.createDataFrame([(i, "xy"[i % 2], w) for i, w in enumerate(words)], "doc_id int, label string, words string")
    vectors = FT.md5_word_vectors(df, min_count=2).checkpoint()
    def results():
        model = FT.fit_wcp(df)
        mean = FT.doc_vector_mean(df, vectors, n_vectors=vectors.count(), dim=4)
        return [sorted((r["doc_id"], *[round(v, 9) for v in r["features"]]) for r in mean.collect()),
                sorted((r["doc_id"], r["label"], round(r["score"], 9)) for r in FT.score_wcp(model, df).collect())]
    want = results()
    monkeypatch.setattr(CM, "MAX_BROADCAST_BYTES", 400)
    monkeypatch.setattr(CM, "FREQUENT_WORDS", 3)
    toks = df.selectExpr("doc_id", "explode(split(words, ' ')) AS word")
    assert "the" in CM.frequent_words(toks, n=3)
    plan = CM.join_words(toks, vectors, ["doc_id"], 10**9, 100, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
    assert results() == want


def test_words_of_a_large_model_are_shuffled_once_if_rare(spark, monkeypatch):
    """Frequent words of the model, whole classes of count, meet the texts by broadcast; no text is pre-counted by a shuffle."""
    from wordloom.operators import common as CM
    words = [" ".join([f"w{i % 20}", f"w{i % 20}", f"u{i}"]) for i in range(100)]
    df = spark.createDataFrame([(i, "xy"[i % 2], w) for i, w in enumerate(words)], "doc_id int, label string, words string")
    model = FT.fit_wcp(df)
    want = sorted((r["doc_id"], r["label"], round(r["score"], 9)) for r in FT.score_wcp(model, df).collect())
    row = FT.WORD_BYTES + 8 * 2
    monkeypatch.setattr(FT, "KNOWN_BYTES", 60 * row)
    assert {r["word"] for r in FT._well_known(model, row).collect()} == {f"w{i}" for i in range(20)}
    monkeypatch.setattr(CM, "MAX_BROADCAST_BYTES", 400)
    monkeypatch.setattr(CM, "FREQUENT_WORDS", 3)
    got = FT.score_wcp(model, df)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [doc_id") == 1
    assert sorted((r["doc_id"], r["label"], round(r["score"], 9)) for r in got.collect()) == want
    monkeypatch.setattr(FT, "KNOWN_BYTES", row)
    assert FT._well_known(model, row) is None
    assert sorted((r["doc_id"], r["label"], round(r["score"], 9)) for r in FT.score_wcp(model, df).collect()) == want


def test_join_features_many_to_many(spark):
    f = spark.createDataFrame([(1, 0.5), (1, 0.7), (2, 0.1)], "doc_id int, v double")
    r = spark.createDataFrame([(1, 1.0), (1, 0.0), (2, None)], "doc_id int, label double")
    out = FT.join_features(f, r)
    assert out.count() == 4                      # repeated id: 2 x 2 rows; unlabelled id 2 dropped
    assert out.where("doc_id = 2").count() == 0


def test_large_model_paths_equal_broadcast_paths(spark):
    """Past the broadcast bound the token joins shuffle; results must not change."""
    from dataclasses import replace
    from conftest import SF_SMALL
    from wordloom.operators.corpus import word_records
    from wordloom.session import table
    d = word_records(table(spark, SF_SMALL, "documents"))
    vecs = FT.md5_word_vectors(d).cache()
    n = vecs.count()
    a = FT.doc_vector_mean(d, vecs, n_vectors=n, dim=4, carry=("label",))
    b = FT.doc_vector_mean(d, vecs, n_vectors=None, dim=4, carry=("label",))
    r = lambda df: df.select("doc_id", "label", F.transform("features", lambda x: F.round(x, 9)).alias("f"))
    assert a.count() == b.count() > 0 and r(a).exceptAll(r(b)).count() == 0
    model = FT.fit_wcp(d)
    s1 = FT.score_wcp(model, d).select("doc_id", "label", F.round("score", 6).alias("s"))
    s2 = FT.score_wcp(replace(model, n_words=None), d).select("doc_id", "label", F.round("score", 6).alias("s"))
    assert s1.count() == s2.count() > 0 and s1.exceptAll(s2).count() == 0


def test_wcp_fit_paths_agree(spark, monkeypatch):
    """Per-class count columns (few classes) and the (label, word) two-step (many classes)."""
    from conftest import SF_SMALL
    from wordloom.operators.corpus import word_records
    from wordloom.session import table
    d = word_records(table(spark, SF_SMALL, "documents"))
    a = FT.score_wcp(FT.fit_wcp(d), d).select("doc_id", "label", F.round("score", 6).alias("s"))
    monkeypatch.setattr(FT, "WIDE_CLASSES", 0)
    b = FT.score_wcp(FT.fit_wcp(d), d).select("doc_id", "label", F.round("score", 6).alias("s"))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_argmax_label_lowest_class_on_ties(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 2.0), (1, "c", 1.0), (2, "c", 5.0), (2, "a", 1.0)],
                               "doc_id int, label string, score double")
    got = {r["doc_id"]: (r["prediction"], r["best_score"]) for r in FT.argmax_label(df).collect()}
    assert got == {1: ("a", 2.0), 2: ("c", 5.0)}


def test_baskets_keep_items_with_spaces(spark):
    li = spark.createDataFrame([(1, 10, 2), (1, 11, 1)], "l_orderkey int, l_partkey int, l_linenumber int")
    pt = spark.createDataFrame([(10, "Brand A"), (11, "B")], "p_partkey int, p_brand string")
    assert P.baskets(li, pt).collect()[0]["items"] == ["B", "Brand A"]
