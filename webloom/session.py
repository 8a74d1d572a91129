"""Spark session helpers: one place for configuration that every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "webloom",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs assume.

    * session time zone UTC: fetch-log timestamps are naive wall times
    * AQE on, with skew-join splitting and partition coalescing, so that a
      hot domain/url does not end up as one oversized shuffle partition
    * Arrow on for the few pandas-backed operators
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings on an existing session (driver-provided)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``webloom`` importable in the Python workers (the pandas operators
    pickle functions that live in this package): zip it once per application
    and hand it to ``addPyFile``, as ``--py-files`` would."""
    import zipfile
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="webloom-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the session.
    Only a local-mode session without the setting (tests, bench) gets a scratch
    folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/…)")
        d = tempfile.mkdtemp(prefix="webloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing a Parquet table into the shared checkpoint
    folder and reading it back (never localCheckpoint): the result survives
    executor loss, and unlike ``Dataset.checkpoint`` the input is computed
    once (an RDD checkpoint recomputes an unpersisted input to write it)."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/webloom-cut-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
