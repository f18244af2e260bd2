from wordloom.session import ensure_checkpoint_dir, scratch_path


def test_configured_checkpoint_dir_is_kept(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    d = ensure_checkpoint_dir(spark)
    assert d and spark.conf.get("spark.checkpoint.dir", None) == (before or d)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d)


def test_spread_only_when_scan_has_few_splits(spark, tmp_dir):
    from wordloom.session import spread
    spark.range(0, 1000).repartition(16).write.mode("overwrite").parquet(tmp_dir + "/many")
    spark.range(0, 1000).coalesce(1).write.mode("overwrite").parquet(tmp_dir + "/one")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    many = spark.read.parquet(tmp_dir + "/many")
    one = spark.read.parquet(tmp_dir + "/one")
    assert "Repartition" not in plan(spread(many, min_partitions=4))      # 16 splits already
    assert "Repartition" in plan(spread(one, min_partitions=4))           # a single split
