"""The command line's three entry points on small files built from the driver tables."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordloom.__main__ import HEADER, main
from wordloom.session import table


def _files(spark, tmp_dir):
    d = table(spark, SF_SMALL, "documents")
    text = F.regexp_replace("text", "[|;\\n]", " ")
    line = F.when(F.col("lang") == "en", F.concat_ws("; ", "lang", F.col("doc_id").cast("string"), text)) \
        .otherwise(F.concat_ws("|", "lang", text))
    tr = d.where(F.col("doc_id") % 3 != 0).select(line)
    te = d.where(F.col("doc_id") % 3 == 0).select(line)
    tr.write.mode("overwrite").text(tmp_dir + "/train1")
    te.write.mode("overwrite").text(tmp_dir + "/test1")


def _run(argv):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        assert main(argv) == 0
    return out.getvalue().splitlines()


def test_single_and_grid(spark, tmp_dir):
    _files(spark, tmp_dir)
    lines = _run(["single", tmp_dir + "/train1", tmp_dir + "/test1", "--features", "tfidf"])
    assert "Class size, number of classes:" in lines
    i = lines.index("Results by set")
    assert lines[i + 1] == HEADER and len(lines[i + 2].split(",")) == 7
    micro = float(lines[i + 2].split(",")[0])
    assert 0.5 < micro <= 1.0
    grid = _run(["grid", tmp_dir, "--suffix", "1", "--repeats", "2", "--features", "tfidf"])
    assert grid.count(HEADER) == 2 and len(grid) == 2 + 2 + 1 + 1 + 2


def test_score(spark, tmp_dir):
    from pyspark.ml import Pipeline
    from wordloom.operators.corpus import word_records
    from wordloom.plans import models
    d = table(spark, SF_SMALL, "documents")
    train = word_records(d.withColumn("y", F.when(F.col("lang") == "en", 1.0).otherwise(2.0)), label="y")
    Pipeline(stages=models.tfidf_stages() + [models.logistic()]).fit(train).write().overwrite().save(tmp_dir + "/model")
    d.select("doc_id", "source", "text").repartition(2).write.mode("overwrite").parquet(tmp_dir + "/landing")
    lines = _run(["score", tmp_dir + "/landing", "--model", tmp_dir + "/model", "--cells", tmp_dir + "/cells", "--batch-bytes", "1"])
    assert lines[-1] == "2 batches" and lines[-2].endswith(f"{d.count()} overall")


def test_train_then_score(spark, tmp_dir):
    """A model trained from a labelled file, cleaning included, is loaded and scores raw text."""
    d = table(spark, SF_SMALL, "documents")
    lines = d.select(F.concat(F.when(F.col("lang") == "en", "1").otherwise("2"), F.lit("|"), F.translate("text", "|\n\r", "   ")).alias("value"))
    lines.coalesce(1).write.text(tmp_dir + "/labelled")
    _run(["train", tmp_dir + "/labelled", tmp_dir + "/whole"])
    d.select("doc_id", "source", "text").write.parquet(tmp_dir + "/in")
    out = _run(["score", tmp_dir + "/in", "--model", tmp_dir + "/whole", "--cells", tmp_dir + "/out"])
    assert out[-1] == "1 batches"
    assert {r["value"] for r in spark.read.parquet(tmp_dir + "/out").select("value").distinct().collect()} == {"ChinaFactoryExplosion", "KentuckyAccidentalChildShooting"}


def test_score_collection(spark, tmp_dir):
    from pyspark.ml import Pipeline
    from wordloom import constants as K
    from wordloom.operators.corpus import word_records
    from wordloom.plans import models
    from wordloom.sources import cells as C
    d = table(spark, SF_SMALL, "documents")
    train = word_records(d.withColumn("y", F.when(F.col("lang") == "en", 1.0).otherwise(2.0)), label="y")
    Pipeline(stages=models.tfidf_stages() + [models.logistic()]).fit(train).write().overwrite().save(tmp_dir + "/m")
    key = F.concat_ws("-", "source", F.col("doc_id").cast("string"))
    C.write_store(d.select(*C.cells(key, K.COLLECTION_FAMILY, K.COLLECTION_QUALIFIER, F.col("text"))), tmp_dir + "/store")
    lines = _run(["score-collection", tmp_dir + "/store", "src1", "--model", tmp_dir + "/m", "--cells", tmp_dir + "/out"])
    n = d.where(F.col("source") == "src1").count()
    assert lines[-1] == f"{n} records labelled" and n > 0


def test_reject_clean_fpgrowth(spark, tmp_dir):
    d = table(spark, SF_SMALL, "documents")
    text = F.regexp_replace("text", "[|;\\n]", " ")
    lab = F.when(F.col("lang") == "en", "1").otherwise("2")
    d.where(F.col("doc_id") % 3 != 0).select(F.concat_ws("|", lab, text)).write.mode("overwrite").text(tmp_dir + "/tr")
    d.where(F.col("doc_id") % 3 == 0).select(F.concat_ws("|", lab, text)).write.mode("overwrite").text(tmp_dir + "/te")
    out = _run(["reject", tmp_dir + "/tr", tmp_dir + "/te"])
    assert any(x.startswith("records of class 0") for x in out) and out[-1].startswith("mean f1 of the classes: ")
    d.select(F.concat_ws(";", "source", "text")).write.mode("overwrite").text(tmp_dir + "/kt")
    _run(["clean", tmp_dir + "/kt", tmp_dir + "/cleaned"])
    cleaned = spark.read.text(tmp_dir + "/cleaned")
    assert cleaned.count() == d.count() and cleaned.where(~F.col("value").contains(";")).count() == 0
    spark.createDataFrame([("a b c",), ("a b",), (" a  c ",), ("b",)], "v string").coalesce(1) \
        .write.mode("overwrite").text(tmp_dir + "/tx")
    fp = _run(["fpgrowth", tmp_dir + "/tx", "--min-support", "0.5"])
    assert "[a], 3" in fp and "[b], 3" in fp and "[a,b], 2" in fp
