"""Paths for tables that only live as long as the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only where driver and executors are one
    process, and nothing is set, a temporary folder serves."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="daybook-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what lies there goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(jvm_path)
    system.deleteOnExit(jvm_path)
    return path
