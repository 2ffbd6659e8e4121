"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", **conf: str) -> SparkSession:
    """Session for tests and the benchmark. On a cluster, submit with its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="postloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "postloom", f"{name}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables below the shared folder.

    Results that still read from them must have been written before.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_dir(spark), "postloom"))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
