"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "punctual",
                shuffle_partitions: int | None = None,
                driver_memory: str = "8g") -> SparkSession:
    """Session with the settings every operator assumes: UTC, AQE, no UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    builder = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # keep CPU-heavy window stages spread even when a shuffle is small
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS/S3/...). Only when it is unset, as in
    local tests, a private folder is created and registered.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # the setting itself cannot change at runtime; register a folder
        # with the context instead
        conf_dir = tempfile.mkdtemp(prefix="punctual-ckpt-")
    if not sc.getCheckpointDir():
        # DataFrame.checkpoint() writes under the context's folder
        sc.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
