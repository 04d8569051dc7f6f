"""Spark session settings the reports are designed for.

* AQE on: runtime broadcast of sides that turn out small, partition
  coalescing, skew-join splitting.
* Session time zone UTC and wall-clock (NTZ) timestamps in the data, so no
  value depends on the zone.
* A checkpoint directory is taken from ``spark.checkpoint.dir`` when the
  cluster sets one; ``ensure_checkpoint_dir`` sets a local one only where it
  is unset (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "binyard",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:  # else whatever the submit names
        b = b.master(master)
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint directory: the context's, else the cluster's
    ``spark.checkpoint.dir`` (registered with the context), else - only where
    neither is set, as in local tests - a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = configured or tempfile.mkdtemp(prefix="binyard-ckpt-",
                                          dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialize(df, spark: SparkSession | None = None):
    """Cut a DataFrame's lineage with a reliable checkpoint in the cluster's
    ``spark.checkpoint.dir`` (shared storage): e.g. ``batch_packout`` built
    once and passed to ``defect_share(..., packout=...)``.  A lost executor
    then re-reads checkpoint files instead of recomputing the whole plan.
    Never ``localCheckpoint`` (executor-local, lost with the executor)."""
    spark = spark or df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)
