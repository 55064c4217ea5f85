"""Kafka source and sink. The connector package has to be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstats.model import TopicConfig
from signalstats.sources import protobuf


def reader_options(source: TopicConfig) -> dict[str, str]:
    """All configured options plus the topic under its subscription type
    (``subscribe``, ``subscribePattern`` or ``assign``).

    Rate and replay options pass through: ``startingOffsets``,
    ``endingOffsets`` (batch), ``maxOffsetsPerTrigger``, ``failOnDataLoss``,
    ``kafkaConsumer.pollTimeoutMs``, ``fetchOffset.numRetries`` and
    ``fetchOffset.retryIntervalMs``.
    """
    return {**{k: _text(v) for k, v in source.conf.items()}, source.subscription_type: source.topic}


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def read_stream(spark: SparkSession, source: TopicConfig) -> DataFrame:
    return spark.readStream.format("kafka").options(**reader_options(source)).load()


def read_range(spark: SparkSession, source: TopicConfig) -> DataFrame:
    """Bounded replay between ``startingOffsets`` and ``endingOffsets``."""
    options = {k: v for k, v in reader_options(source).items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**options).load()


def to_messages(aggregates: DataFrame, output_format: str = "json", key: str = "dimension_hash") -> DataFrame:
    """``key, value`` columns of a Kafka writer: the row as JSON or protobuf, unset
    fields left out. Protobuf takes rows in the layout of the message."""
    row = F.struct(*aggregates.columns)
    if output_format == "json":
        value = F.to_json(row)
    elif output_format == "protobuf":
        value = protobuf.to_bytes(row, "MetricAggregation", protobuf.in_jvm(aggregates.sparkSession))
    else:
        raise ValueError(f"unknown output format: {output_format}")
    return aggregates.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def writer_options(sink: TopicConfig) -> dict[str, str]:
    return {**{k: _text(v) for k, v in sink.conf.items()}, "topic": sink.topic}
