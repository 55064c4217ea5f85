"""Recommended session settings."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the aggregation after it then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sketch aggregation leaves its hash map for sorting at 128 keys per task by
    # default, which is far too early for windowed keys.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # State of many windows outgrows the heap; RocksDB keeps it off-heap and
    # uploads only changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session_builder(app_name: str = "signal-statistics", **extra: str) -> SparkSession.Builder:
    """Builder with :data:`SETTINGS`; master and resources come from the launcher."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> None:
    """Give a running session the settings for aggregation and state, unless it was
    launched with its own. Time zone and launch-time settings stay as they are."""
    launched = spark.sparkContext.getConf()
    for key in (k for k in SETTINGS if any(p in k for p in ("objectHashAggregate", "stateStore", "forceOptimize"))):
        if not launched.contains(key):
            spark.conf.set(key, SETTINGS[key])


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    Needed for the few Arrow operators when the package is not installed on the
    executors; the archive goes out through ``SparkContext.addPyFile``.
    """
    context = spark.sparkContext
    if getattr(context, "_signalstats_shipped", False):
        return
    here = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="signalstats-")) / "signalstats.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in here.rglob("*.py"):
            out.write(source, source.relative_to(here.parent))
    context.addPyFile(str(archive))
    context._signalstats_shipped = True
