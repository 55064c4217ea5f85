"""What a streaming query keeps, read from its checkpoint as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator and store of a checkpoint: ``operator_id``, its name,
    the store, its partitions and the batches of which state is still there."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"),
        F.col("operatorName").alias("operator"),
        F.col("stateStoreName").alias("store"),
        F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"),
        F.col("maxBatchId").alias("last_batch"),
    )


def open_keys(spark: SparkSession, checkpoint: str, operator_id: int = 0, batch: int | None = None) -> DataFrame:
    """One row per key that a stopped aggregation still holds: the key's columns and the state
    partition; after the last batch or the one given. Read in one task per state partition.

    Columns keep the names they have in the query; a window of
    ``pipeline.window_statistics`` is ``_window``, the bound at which it closes.
    """
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key.*", F.col("partition_id").alias("state_partition"))
