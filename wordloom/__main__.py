"""Command line: the original job's three entry points on top of the library.

    python -m wordloom single TRAIN TEST [--features tfidf|w2v]
    python -m wordloom grid DIR --train train --test test --suffix 1 2 [--repeats N] [--features ...]
    python -m wordloom score LANDING --model MODEL_DIR --cells OUT [--batch-bytes N] [--checkpoint DIR]
    python -m wordloom score-collection STORE COLLECTION_ID --model MODEL_DIR --cells OUT
    python -m wordloom reject TRAIN TEST [--delim '|'] [--threshold 0.25]
    python -m wordloom clean INPUT OUTPUT            (key;text lines -> key;cleaned lines)
    python -m wordloom fpgrowth INPUT [--min-support 0.3]

Train/test files are read with the mixed reader (``label; id; text`` or ``label|text``, labels
indexed train-first). Metric rows are printed as a header and one CSV line per run, per set and
then for all runs. ``score`` streams the files in ``LANDING`` (columns ``doc_id, source, text``)
through a saved pipeline model and writes label names into the cell log ``OUT``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = ("Micro F1,Macro F1,Train Time(Seconds),Weighted Precision,Weighted Recall,Weighted F1,"
          "Prediction Time(Seconds)")
COLS = ["micro_f1", "macro_f1", "train_time", "weighted_precision", "weighted_recall", "weighted_f1",
        "predict_time"]


def _records(spark: SparkSession, train_path: str, test_path: str) -> tuple[DataFrame, DataFrame]:
    from wordloom.functions.text import strip_markup, words_only
    from wordloom.plans.models import indexed_records
    from wordloom.sources import delimited as D
    parts = []
    for split, path in (("train", train_path), ("test", test_path)):
        r = D.good(D.read_mixed(spark, path))
        parts.append(r.select(F.concat_ws(":", F.lit(split), "id").alias("doc_id"), "raw_label",
                              words_only(strip_markup("text")).alias("words"), F.lit(split).alias("split")))
    recs = indexed_records(parts[0].unionByName(parts[1]))
    return recs.where(F.col("split") == "train"), recs.where(F.col("split") == "test")


def _run(train: DataFrame, test: DataFrame, features: str) -> list:
    from wordloom.plans import models
    res = models.run_tfidf(train, test) if features == "tfidf" else models.run_w2v(train, test)
    row = models.metric_row(res).first()
    return [row[c] for c in COLS]


def _print_sets(sets: list[list[list]]) -> None:
    print("Results by set")
    for one in sets:
        print(HEADER)
        for m in one:
            print(",".join(str(v) for v in m))
    print("Results over all sets")
    print(HEADER)
    for one in sets:
        for m in one:
            print(",".join(str(v) for v in m))


def _stats(train: DataFrame, test: DataFrame) -> None:
    """Corpus statistics and the class-size histogram of train union test."""
    from wordloom.operators import stats
    spark = train.sparkSession
    r = stats.corpus_stats(train, test, "raw_label").first()
    print(f"train rows {r['train_rows']}, test rows {r['test_rows']}, classes {r['num_classes']}, "
          f"smallest class {r['min_class_size']} (x{r['n_min_classes']}), largest class {r['max_class_size']}")
    print("Class size, number of classes:")
    hist = stats.class_size_histogram(spark, train.unionByName(test), "raw_label")
    for row in hist.orderBy("class_size").toLocalIterator():
        print(f"{row['class_size']}\t{row['n_classes']}")


def _reject(spark: SparkSession, train_path: str, test_path: str, delim: str, threshold: float) -> None:
    """Word2Vec features, logistic regression, pivot-class scores with the reject option, then the
    confident-error / unsure-hit counts, the class-0 count and the metrics."""
    from pyspark.ml.functions import vector_to_array
    from wordloom.functions.text import strip_markup, words_only
    from wordloom.operators import metrics, scoring
    from wordloom.plans import models
    from wordloom.sources import delimited as D

    def load(path, tag):
        r = D.good(D.read_label_text(spark, path, delim=delim))
        return r.select(F.concat_ws(":", F.lit(tag), "id").alias("doc_id"), "label",
                        words_only(strip_markup("text")).alias("words"))
    train, test = load(train_path, "train"), load(test_path, "test")
    w2v = models.fit_word2vec(train)
    lr = models.logistic().fit(models.w2v_features(w2v, train))
    rows = models.pivot_rows(lr)
    feats = models.w2v_features(w2v, test).withColumn("f", vector_to_array("features"))
    scored = scoring.legacy_scores(feats, rows, "f", threshold).persist()
    print(f"confident errors: {scoring.confident_errors(scored, threshold=threshold).count()}")
    print(f"unsure hits: {scoring.unsure_hits(scored, threshold=threshold).count()}")
    print(f"records of class 0: {scoring.zero_class_count(scored).first()['n_zero']}")
    pred = scored.select("label", F.col("final").alias("prediction"))
    for r in metrics.per_class(pred).orderBy("label").toLocalIterator():
        print(f"class {r['label']}: f1 {r['f1']}, recall {r['recall']}, precision {r['precision']}, "
              f"false alarms {r['fpr']} of the others")
    o = metrics.overall(pred).first()
    print(f"by class size: f1 {o['weighted_f1']}, precision {o['weighted_precision']}, recall {o['weighted_recall']}")
    print(f"mean f1 of the classes: {o['macro_f1']}; of all records: {o['micro_f1']}")
    scored.unpersist()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="wordloom")
    ap.add_argument("--master", default=None, help="only for local runs; clusters use spark-submit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s1 = sub.add_parser("single")
    s1.add_argument("train")
    s1.add_argument("test")
    s1.add_argument("--features", choices=["tfidf", "w2v"], default="w2v")
    s2 = sub.add_parser("grid")
    s2.add_argument("dir")
    s2.add_argument("--train", default="train")
    s2.add_argument("--test", default="test")
    s2.add_argument("--suffix", nargs="+", default=["1"])
    s2.add_argument("--repeats", type=int, default=1)
    s2.add_argument("--features", choices=["tfidf", "w2v"], default="w2v")
    s3 = sub.add_parser("score")
    s3.add_argument("landing")
    s3.add_argument("--model", required=True)
    s3.add_argument("--cells", required=True)
    s3.add_argument("--batch-bytes", type=int, default=1 << 30)
    s3.add_argument("--checkpoint", default=None, help="an earlier run's, to go on with it; otherwise this is a new run")
    s8 = sub.add_parser("train")
    s8.add_argument("input")
    s8.add_argument("model")
    s8.add_argument("--delim", default="|")
    s4 = sub.add_parser("score-collection")
    s4.add_argument("store")
    s4.add_argument("collection")
    s4.add_argument("--model", required=True)
    s4.add_argument("--cells", required=True)
    s4.add_argument("--run", default=None, help="a name, to replace that run's labels; otherwise this is a new run")
    s5 = sub.add_parser("reject")
    s5.add_argument("train")
    s5.add_argument("test")
    s5.add_argument("--delim", default="|")
    s5.add_argument("--threshold", type=float, default=0.25)
    s6 = sub.add_parser("clean")
    s6.add_argument("input")
    s6.add_argument("output")
    s7 = sub.add_parser("fpgrowth")
    s7.add_argument("input")
    s7.add_argument("--min-support", type=float, default=0.3)
    s7.add_argument("--partitions", type=int, default=None)
    a = ap.parse_args(argv)

    from wordloom.session import get_session
    spark = get_session(a.master)
    if a.cmd == "single":
        train, test = _records(spark, a.train, a.test)
        _stats(train, test)
        _print_sets([[_run(train, test, a.features)]])
    elif a.cmd == "reject":
        _reject(spark, a.train, a.test, a.delim, a.threshold)
    elif a.cmd == "train":
        from wordloom.plans import models
        from wordloom.sources import delimited as D
        models.text_pipeline(D.good(D.read_label_text(spark, a.input, delim=a.delim))).save(a.model)
        print(f"wrote {a.model}")
    elif a.cmd == "clean":
        from wordloom.functions.text import clean_text
        from wordloom.operators.cleaning import DEFAULT_LEMMAS
        from wordloom.sources import delimited as D
        rows = D.good(D.read_key_text(spark, a.input))
        D.write_key_lines(rows.withColumn("clean", clean_text(F.col("text"), DEFAULT_LEMMAS)), a.output)
        print(f"wrote {a.output}")
    elif a.cmd == "fpgrowth":
        from wordloom.operators.patterns import frequent_itemsets
        from wordloom.sources import delimited as D
        fi = frequent_itemsets(D.read_transactions(spark, a.input), "items", a.min_support, a.partitions)
        for r in fi.orderBy(F.size("items"), "items").toLocalIterator():
            print("[" + ",".join(r["items"]) + "], " + str(r["freq"]))
    elif a.cmd == "grid":
        sets = []
        for suffix in a.suffix:
            train, test = _records(spark, f"{a.dir}/{a.train}{suffix}", f"{a.dir}/{a.test}{suffix}")
            sets.append([_run(train, test, a.features) for _ in range(a.repeats)])
        _print_sets(sets)
    elif a.cmd == "score-collection":
        from pyspark.ml import PipelineModel
        from wordloom.sources import cells as C
        from wordloom.streaming import scorer
        model = PipelineModel.load(a.model)
        scorer.score_collection(spark, spark.read.parquet(a.store), a.collection, scorer.pipeline_scorer(model),
                                a.cells, a.run)
        n = scorer.latest_labels(spark, a.cells).count()
        print(f"{n} records labelled")
    else:
        from pyspark.ml import PipelineModel
        from wordloom.session import scratch_path
        from wordloom.streaming import scorer
        model = PipelineModel.load(a.model)
        schema = spark.read.parquet(a.landing).schema
        n = scorer.run_stream(spark, scorer.pipeline_scorer(model), a.landing, schema, a.cells,
                              a.checkpoint or scratch_path(spark, "score-checkpoint"), a.batch_bytes)
        for r in scorer.batch_totals(spark, a.cells).orderBy("run", "batch_id").toLocalIterator():
            print(f"run {r['run']} batch {r['batch_id']}: {r['n_rows']} records, {r['running_total']} overall")
        print(f"{n} batches")
    return 0


if __name__ == "__main__":
    sys.exit(main())
