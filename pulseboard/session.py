"""Spark session helpers.

All time arithmetic in this engine is UTC epoch based, so the session time
zone is pinned to UTC.  Lineage is cut with ``checkpoint()`` into the folder
named by ``spark.checkpoint.dir``; a cluster sets it to shared storage, and
only local runs (tests, bench) fall back to a scratch folder of their own.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pulseboard") -> SparkSession:
    """Local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``).

    A cluster must name a shared folder; only a local-mode session (tests,
    bench) without one gets a scratch folder of its own.  Never a local
    checkpoint: lineage is cut with reliable checkpoints only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's object store)")
        conf_dir = tempfile.mkdtemp(prefix="pulseboard-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
