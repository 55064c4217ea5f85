"""Working folders for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a
    cluster, executors could not read each other's.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="signalstats-")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a fresh subfolder; nothing is created yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
