"""Session helpers: one place for the settings every job in this package relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wordloom") -> SparkSession:
    """Build (or reuse) a session with AQE on and the web UI off.

    On a cluster ``master`` stays ``None`` so the submit settings win; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the whole cluster; its heap must be set before start.
        b = b.config("spark.driver.memory", os.environ.get("WORDLOOM_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system path and is only read here; it must be
    set there. Only a local master without it (tests, local runs) gets a fresh local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="wordloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would: functions that run in
    Python workers are found by name there."""
    sc = spark.sparkContext
    if getattr(sc, "_wordloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="wordloom-py-"), "wordloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("wordloom", os.path.relpath(full, root)))
    sc.addPyFile(out)
    sc._wordloom_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the checkpoint folder (see :func:`ensure_checkpoint_dir`)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver tables (one parquet each), spread over the cores when the scan
    itself cannot be split (see :func:`spread`)."""
    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan whose partitions are fewer than the cores.

    A file with a single row group is read by one task, which would serialize the CPU-heavy
    text work (regexes, tokenizing). The decision uses the scan's planned splits (files cut by
    ``spark.sql.files.maxPartitionBytes``), so a large input -- many files or one big file with
    many row groups -- is left alone and never shuffled for this; filters and column pruning
    still reach the scan (they are pushed through a round-robin repartition).
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.rdd().getNumPartitions() < want:   # planned scan splits; no job runs
        return df.repartition(want)
    return df
