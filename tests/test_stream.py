from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordloom.plans import q_stream
from wordloom.session import table
from wordloom.streaming import scorer


def test_stream_equals_batch_and_counts(spark):
    paths = q_stream.run(spark, SF_SMALL, batch_bytes=100_000)
    streamed = scorer.latest_labels(spark, paths["cells"])
    model = q_stream.fitted_model(spark, SF_SMALL)
    docs = table(spark, SF_SMALL, "documents")
    batch = scorer.score_records(model, docs).select("row_key", F.col("prediction").alias("value"))
    assert streamed.count() == docs.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    totals = scorer.batch_totals(spark, paths["cells"]).orderBy("batch_id").collect()
    assert len(totals) > 1
    assert totals[-1]["running_total"] == docs.count()


def test_pipeline_model_through_the_same_stream(spark):
    """M7: a fitted TF-IDF + logistic-regression pipeline scores the collection through the
    same foreachBatch sink; label names are written per record and equal the batch result."""
    from pyspark.ml import Pipeline
    from wordloom.plans import models as MD
    from wordloom.plans import q_models as QM
    train, _ = QM._train_test(spark, SF_SMALL)
    model = Pipeline(stages=MD.tfidf_stages() + [MD.logistic()]).fit(train)
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "source", "text")
    p = scorer.new_paths(spark)
    scorer.stage_landing(docs.repartition(3), p["landing"])
    n = scorer.run_stream(spark, scorer.pipeline_scorer(model), p["landing"], docs.schema, p["cells"], p["checkpoint"], 1)
    assert n >= 3
    streamed = scorer.latest_labels(spark, p["cells"])
    batch = scorer.pipeline_scorer(model)(docs).select("row_key", F.col("prediction").alias("value"))
    assert streamed.count() == docs.count()
    assert streamed.exceptAll(batch).count() == 0
    names = {r["value"] for r in streamed.select("value").distinct().collect()}
    assert names and all(isinstance(x, str) and x for x in names)


def test_failed_batch_is_replayed_idempotently(spark):
    """A batch that fails mid-stream is replayed from the checkpoint on restart; its folder is
    overwritten, so the final cells equal the batch result with no duplicates."""
    import pytest
    model = q_stream.fitted_model(spark, SF_SMALL)
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "source", "text")
    p = scorer.new_paths(spark)
    scorer.stage_landing(docs.repartition(3), p["landing"])
    calls = {"n": 0}
    good = scorer.wcp_scorer(model)

    def flaky(df):
        calls["n"] += 1
        out = good(df)
        if calls["n"] == 2:          # the second batch writes part of its work, then fails
            from wordloom.sources import cells as C
            C.append_cells(C.label_cells(out.limit(3), "row_key", "prediction", batch=1), p["cells"], batch_id=1)
            raise RuntimeError("executor lost")
        return out
    with pytest.raises(Exception):
        scorer.run_stream(spark, flaky, p["landing"], docs.schema, p["cells"], p["checkpoint"], 1)
    scorer.run_stream(spark, good, p["landing"], docs.schema, p["cells"], p["checkpoint"], 1)   # restart
    log = spark.read.parquet(p["cells"])
    assert log.count() == docs.count()                       # one cell per record, none duplicated
    batch = scorer.score_records(model, docs).select("row_key", F.col("prediction").alias("value"))
    assert scorer.latest_labels(spark, p["cells"]).exceptAll(batch).count() == 0


def constant(value):
    return lambda df: scorer._keyed(df).select("row_key", F.lit(value).alias("prediction"))


def test_two_runs_share_a_log(spark):
    """K1: runs over different folders keep all records, a record scored again shows the newer label, a replayed run
    changes nothing, and the compacted log says the same."""
    from wordloom.sources import cells as C
    docs = spark.createDataFrame([(i, "s", f"text {i}") for i in range(60)], "doc_id long, source string, text string")
    p, q = scorer.new_paths(spark), scorer.new_paths(spark)
    scorer.stage_landing(docs.where("doc_id < 40").repartition(3), p["landing"])
    scorer.stage_landing(docs.where("doc_id >= 30").repartition(2), q["landing"])
    for paths, value in ((p, "old"), (q, "new")):
        scorer.run_stream(spark, constant(value), paths["landing"], docs.schema, p["cells"], paths["checkpoint"], 1)
    want = {f"s-{i}": "old" if i < 30 else "new" for i in range(60)}
    labels = lambda df: {r["row_key"]: r["value"] for r in df.collect()}
    assert labels(scorer.latest_labels(spark, p["cells"])) == want
    cells = spark.read.parquet(p["cells"]).count()
    assert cells == 70
    scorer.run_stream(spark, constant("old"), p["landing"], docs.schema, p["cells"], p["checkpoint"], 1)  # goes on with the first run: nothing is left
    assert spark.read.parquet(p["cells"]).count() == cells and labels(scorer.latest_labels(spark, p["cells"])) == want
    assert [(r["run"], r["batch_id"]) for r in scorer.batch_totals(spark, p["cells"]).orderBy("run", "batch_id").collect()][-1][0] == 1
    C.compact(C.read_cells(spark, p["cells"]), p["landing"] + "-compact")
    small = C.read_cells(spark, p["landing"] + "-compact")
    assert small.count() == 60 and labels(C.latest(small).select("row_key", "value")) == want
    store = spark.createDataFrame([("s-1", 0)], "row_key string, x int").select(*C.cells(F.col("row_key"), "tweet", "cleantext", F.lit("t")))
    for value in ("third", "again"):
        scorer.score_collection(spark, store, "s", constant(value), p["cells"], run_name="by hand")
    assert labels(scorer.latest_labels(spark, p["cells"]))["s-1"] == "again" and spark.read.parquet(p["cells"]).count() == 71


def test_a_large_model_is_met_by_rare_words_alone(spark, monkeypatch):
    """Past the broadcast bound only rare words of the cleaned texts are shuffled, once; nothing is pre-counted by text,
    and the stream writes the same labels."""
    from wordloom.operators import common as CM
    from wordloom.operators import features as FT
    from wordloom.operators.cleaning import clean_records
    spell = lambda i: "".join(chr(97 + int(d)) for d in f"{i:03d}")
    rows = [(i, "s", "xy"[i % 2], f"#common{spell(i % 20)} common{spell(i % 20)} rare{spell(i)}, the 12") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, label string, text string")
    model = FT.fit_wcp(clean_records(docs, out="words"))
    labels = lambda df: {r["row_key"]: r["prediction"] for r in df.collect()}
    want = labels(scorer.score_records(model, docs))
    assert want == {f"s-{i}": "xy"[i % 2] for i in range(100)}
    monkeypatch.setattr(FT, "KNOWN_BYTES", 60 * (FT.WORD_BYTES + 8 * 2))
    monkeypatch.setattr(CM, "MAX_BROADCAST_BYTES", 400)
    monkeypatch.setattr(CM, "FREQUENT_WORDS", 3)
    got = scorer.score_records(model, docs)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [doc_id") == 1
    assert labels(got) == want
    p = scorer.new_paths(spark)
    scorer.stage_landing(docs.drop("label"), p["landing"])
    scorer.run_stream(spark, scorer.wcp_scorer(model), p["landing"], docs.drop("label").schema, p["cells"], p["checkpoint"])
    assert labels(scorer.latest_labels(spark, p["cells"]).withColumnRenamed("value", "prediction")) == want


def test_batches_are_bounded_by_bytes(spark):
    """Files of unequal size: small ones share a batch, a large one is a batch of its own."""
    import os
    docs = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    p = scorer.new_paths(spark)
    for n, part in enumerate((docs.where("doc_id < 2500"), docs.where("doc_id BETWEEN 2500 AND 2509"), docs.where("doc_id BETWEEN 2510 AND 2519"), docs.where("doc_id >= 2520 AND doc_id < 2530"))):
        part.coalesce(1).write.mode("append").parquet(p["landing"])
    sizes = sorted(os.path.getsize(f"{p['landing']}/{f}") for f in os.listdir(p["landing"]) if f.endswith(".parquet"))
    n = scorer.run_stream(spark, constant("x"), p["landing"], docs.schema, p["cells"], p["checkpoint"], sum(sizes[:3]) + 100)
    assert n == 2 and spark.read.parquet(p["cells"]).count() == 2530
    empty = scorer.new_paths(spark)
    os.makedirs(empty["landing"])
    assert scorer.run_stream(spark, constant("x"), empty["landing"], docs.schema, empty["cells"], empty["checkpoint"]) == 0
