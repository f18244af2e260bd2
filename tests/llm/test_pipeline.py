"""The pipeline's stages in a row, each held against what it should have done to its own input."""

import random

import corpus_pipeline
from conftest import SF_SMALL
from wordloom.llm import near_dup, quality, secrets
from wordloom.session import scratch_path


def test_stages(spark):
    docs = first = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = scratch_path(spark, "stage-test")
        stage(spark, docs, SF_SMALL).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        kept.append((name, before, docs))
        if name != "packing":
            assert docs.columns == first.columns
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    good = {r["doc_id"] for r in quality.classify(first, labels).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept[0][2].collect()} == good
    classes = {r["class_id"] for r in near_dup.near_duplicates(kept[1][1]).collect()}
    assert sorted(r["doc_id"] for r in kept[1][2].collect()) == sorted(classes)
    was = {r["doc_id"]: r["text"] for r in kept[2][1].collect()}
    windows, n = set(), corpus_pipeline.PASSAGE
    for r in sorted(kept[2][2].collect(), key=lambda r: r["doc_id"]):
        text = was[r["doc_id"]].encode()
        new = [text[k:k + n] for k in range(len(text) - n + 1)]
        if r["text"] == was[r["doc_id"]]:  # an untouched text has no passage of an earlier one
            assert len(set(new)) == len(new) and not windows & set(new)
        windows |= set(new)
    left = secrets.scan(kept[3][2], [0.0] * len(secrets.ALPHABET) ** 2).where("size(base) > 0").count()
    assert left == 0
    pieces = kept[4][2].collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in kept[3][2].collect()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_passages_of_over_50_words_go_and_clean_texts_stay(spark):
    """Each planted passage stays in the document of smallest id; texts without one are left alone."""
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(n))
    passages = [text(n) for n in (51, 52, 60, 80, 200)]
    rows = [(i, f"{text(80)} {passages[i % 5]} {text(80)}") for i in range(40)] + [(i, text(200)) for i in range(40, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.no_repeated_passages(spark, docs, SF_SMALL).collect()}
    for i, t in rows:
        assert (got[i] == t) == (i < 5 or i >= 40)
        if 5 <= i < 40:  # at most a few letters next to the passage are equal by chance
            assert len(t) - len(got[i]) - len(passages[i % 5]) in range(12)


def test_odd_repeated_and_empty_tables(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, spans string, start long"
    words = " ".join(f"word{i % 97}x{i}" for i in range(400))
    rows = [(None, words), (None, None), (1, ""), (2, " \n "), (3, "z" * 50_000), (4, words), (4, words), (5, words + " more"), (6, "password = hunter2hunter2")]
    for some in (rows, []):
        docs = spark.createDataFrame([(i, t, None, "s", 0, "x", 7) for i, t in some], kind)
        for name, stage in corpus_pipeline.STAGES:
            out = scratch_path(spark, "odd-test")
            stage(spark, docs, SF_SMALL).write.parquet(out)
            before, docs = docs, spark.read.parquet(out)
            assert name == "packing" or docs.columns == before.columns
        assert (docs.count() > 0) == bool(some)
