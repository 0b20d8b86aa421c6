"""Spark session helpers.

The library never creates a session behind the user's back: every operator
takes DataFrames.  ``get_session`` is for tests, the bench and the examples.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults tuned for local[N] runs; a cluster deployment sets its own values
# through spark-defaults and these only fill in what is unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sieve") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SIEVE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points to shared storage and is used as is.
    When it is unset, a fresh scratch folder is taken in local mode (tests);
    on a cluster that is an error, as no machine-local folder is shared.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            path = None
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="sieve-ckpt-")
    sc.setCheckpointDir(path)
    return path


#: Drops the shuffle files of an execution when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bounds the bytes of an Arrow batch, besides its rows.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def materialize(df, name: str = "t", batch_bytes: int | None = None):
    """Cut lineage of an intermediate result by writing it as a Parquet table
    under the shared checkpoint folder and reading it back.

    Unlike ``RDD.checkpoint`` the plan runs once; the result survives executor
    loss, and its file size lets AQE pick broadcast joins downstream.  The
    shuffle files of the plan are dropped once the table is written, as nothing
    reads them again.  ``batch_bytes`` bounds the Arrow batches that the plan
    sends to Python, unless the session has a bound of its own."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sieve-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    bounded = batch_bytes is not None and spark.conf.get(_BATCH, None) is None
    spark.conf.set(_CLEANUP, "true")
    if bounded:
        spark.conf.set(_BATCH, str(batch_bytes))
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
        if bounded:
            spark.conf.unset(_BATCH)
    return spark.read.parquet(path)
