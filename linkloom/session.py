"""Spark session defaults and lineage helpers.

Library code never creates a session on its own; callers pass one in.
``local_session`` is for tests, the bench and the smoke entry only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "linkloom",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read.
    Only a local-mode session without the setting (tests, bench) gets a fresh
    scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/...) so iterative jobs can cut lineage")
    scratch = tempfile.mkdtemp(prefix="linkloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
