"""Plan-shape checks: pushdown, pruning, no Python UDFs, bounded broadcasts."""

import datetime as dt

from conftest import SF_SMALL
from wordloom.sources import cells as C


def plan_text(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_range_reaches_parquet(spark, tmp_dir):
    t = dt.datetime(2020, 1, 1)
    rows = [(k, "tweet", "cleantext", t, 0, "v" + k) for k in ["43-1", "430-1", "43", "44-2"]]
    df = spark.createDataFrame(rows, "row_key string, family string, qualifier string, ts timestamp, seq bigint, value string")
    C.append_cells(df, tmp_dir + "/cells", batch_id=0)
    out = C.scan_collection(C.read_cells(spark, tmp_dir + "/cells"), "43")
    p = plan_text(out)
    assert "GreaterThanOrEqual(row_key,43)" in p and "LessThan(row_key,430)" in p
    assert sorted(r["row_key"] for r in out.collect()) == ["43", "43-1"]


def test_text_query_prunes_columns(spark):
    import __spark_entry__ as E
    p = plan_text(E.queries()["words_only"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p


def test_no_python_udfs_in_registered_queries(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ["class_word_prob", "clean_text", "tfidf", "wcp_features", "legacy_scores", "latest_cells",
                 "read_mixed", "doc_vector_avg", "pattern_flags", "metrics_overall"]:
        p = plan_text(q[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_flagship_counts_shuffled_once(spark):
    """Class totals come from the same word-count exchange (reused), joined back by broadcast."""
    import __spark_entry__ as E
    df = E.queries()["class_word_prob"](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "ReusedExchange" in p


def test_registered_collection_scan_pushes_key_range(spark):
    import __spark_entry__ as E
    p = plan_text(E.queries()["collection_scan"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(row_key,src1)" in p and "LessThan(row_key,src10)" in p


def test_top_k_limits_before_the_shuffle(spark):
    import __spark_entry__ as E
    p = plan_text(E.queries()["similar_topk"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p and "Join" not in p


def test_class_scores_one_shuffle_model_broadcast(spark):
    """Per-class text scores: tokens meet the (counted, small) model by broadcast and are summed
    per text with one shuffle."""
    import __spark_entry__ as E
    df = E.queries()["wcp_features"](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in p
    assert p.count("Exchange hashpartitioning") <= 1
