import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL

from wordloom import constants as K
from wordloom.sources import cells as C

SCHEMA = "row_key string, family string, qualifier string, ts timestamp, seq bigint, value string"


def plan_text(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def cells_df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_prefix_scan_takes_dash_keys_only(spark):
    t = dt.datetime(2020, 1, 1)
    df = cells_df(spark, [(k, "tweet", "cleantext", t, 0, k) for k in ["43-1", "430-1", "43", "42-9", "44-1", "43-2"]])
    got = sorted(r["row_key"] for r in C.scan_collection(df, "43").collect())
    assert got == ["43", "43-1", "43-2"]


def test_latest_version_wins_with_tie_break(spark):
    t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    df = cells_df(spark, [("r", "f", "q", t1, 0, "old"), ("r", "f", "q", t2, 0, "new"), ("r", "f", "q", t2, 5, "newest"),
                          ("s", "f", "q", t1, 0, "only")])
    got = {r["row_key"]: r["value"] for r in C.latest(df).collect()}
    assert got == {"r": "newest", "s": "only"}


def test_latest_row_pivot_and_missing(spark):
    t = dt.datetime(2020, 1, 1)
    df = cells_df(spark, [("r", "f", "a", t, 0, "1"), ("r", "f", "b", t, 0, "2"), ("s", "f", "a", t, 0, "3"),
                          ("r", "g", "a", t, 0, "other family")])
    got = {r["row_key"]: (r["a"], r["b"]) for r in C.latest_row(df, "f", ["a", "b"]).collect()}
    assert got == {"r": ("1", "2"), "s": ("3", None)}


def test_point_lookup_and_value_scan(spark):
    t = dt.datetime(2020, 1, 1)
    df = cells_df(spark, [("r1", "f", "q", t, 0, "x"), ("r2", "f", "q", t, 0, "y"), ("r3", "f", "other", t, 0, "x")])
    keys = spark.createDataFrame([("r1",), ("r9",)], "row_key string")
    assert [tuple(r) for r in C.point_lookup(df, keys, "f", "q").collect()] == [("r1", "x")]
    assert sorted(r["row_key"] for r in C.value_scan(df, "f", "q", "x").collect()) == ["r1"]


def test_upsert_last_write_wins_and_replay(spark, tmp_dir):
    pred = spark.createDataFrame([("a", "N1"), ("b", "N2")], "id string, name string")
    C.append_cells(C.label_cells(pred, "id", "name", 0), tmp_dir + "/log", batch_id=0)
    pred2 = spark.createDataFrame([("a", "N3")], "id string, name string")
    for _ in range(2):  # replaying a batch rewrites the same folder
        C.append_cells(C.label_cells(pred2, "id", "name", 1), tmp_dir + "/log", batch_id=1)
    log = C.read_cells(spark, tmp_dir + "/log")
    assert log.count() == 3
    got = {r["row_key"]: r["value"] for r in C.latest(log).collect()}
    assert got == {"a": "N3", "b": "N2"}


def test_training_cells_roundtrip(spark, tmp_dir):
    recs = spark.createDataFrame([("1", 1.0, "t1"), ("2", None, "t2"), ("3", 0.0, "t3")],
                                 "id string, label double, text string")
    C.append_cells(C.training_cells(recs), tmp_dir + "/tr", batch_id=0)
    cells = C.read_cells(spark, tmp_dir + "/tr")
    assert cells.where(F.col("qualifier") == K.TRAINING_LABEL_QUALIFIER).orderBy("row_key").select("value") \
        .collect()[0]["value"] == "1.0"
    back = sorted(tuple(r) for r in C.training_records(cells).collect())
    assert back == [("1", 1.0, "t1"), ("3", 0.0, "t3")]


def test_store_look_ups_skip_folders_and_row_groups(spark, tmp_dir, monkeypatch):
    """Folders and keys reach the scan; many keys give the same by a join; a store is written once for three queries."""
    from wordloom.plans import q_cells
    rows = spark.range(0, 4000).select(F.concat_ws("-", F.concat(F.lit("c"), F.col("id") % 50), F.col("id")).alias("k"), F.col("id"))
    C.write_store(rows.select(*C.cells(F.col("k"), "f", "q", F.col("id"))), tmp_dir + "/store")
    store = C.read_store(spark, tmp_dir + "/store")
    keys = rows.where("id IN (7, 57, 3999)").select(F.col("k").alias("row_key"))
    got = C.point_lookup(store, keys, "f", "q")
    plan = plan_text(got)
    assert "bucket#" in plan.split("PartitionFilters: ")[1].split("PushedFilters: ")[0]
    assert "In(row_key, [" in plan
    want = {("c7-7", "7"), ("c7-57", "57"), ("c49-3999", "3999")}
    assert {tuple(r) for r in got.collect()} == want
    monkeypatch.setattr(C, "MAX_KEY_FILTER", 1)
    assert {tuple(r) for r in C.point_lookup(store, keys, "f", "q").collect()} == want
    assert C.point_lookup(store, keys.limit(0), "f", "q").count() == 0
    scan = C.scan_collection(store, "c7", "f", "q")
    assert scan.count() == 80 and "bucket#" in plan_text(scan).split("PartitionFilters: ")[1].split("PushedFilters: ")[0]
    q_cells._stores.clear()
    written = []
    monkeypatch.setattr(C, "write_store", lambda df, path, f=C.write_store: (written.append(path), f(df, path)))
    for q in (q_cells.q_collection_scan, q_cells.q_point_lookup, q_cells.q_value_scan):
        q(spark, SF_SMALL).count()
    assert len(written) == 1
