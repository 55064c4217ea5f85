"""Protobuf payloads.

With the ``spark-protobuf`` package among the session's packages or jars the JVM
decodes them; otherwise Arrow batches go to the protobuf runtime for Python, see
:mod:`signalstats.sources.wire`.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstats.model import message_schema
from signalstats.sources import wire
from signalstats.sources.wire import PACKAGE, descriptor_set


def in_jvm(spark: SparkSession) -> bool:
    """Whether the JVM package is there, and what describes the messages to it."""
    launched = (spark.conf.get(key, "") or "" for key in ("spark.jars.packages", "spark.jars"))
    return wire.descriptor_pb2 is not None and any("spark-protobuf" in names for names in launched)


def from_bytes(payload: Column, message: str = "CallEvent", jvm: bool = False) -> Column:
    """Payload to ``STRUCT``; NULL when it cannot be parsed."""
    if jvm:
        from pyspark.sql.protobuf.functions import from_protobuf

        return from_protobuf(
            payload,
            f"{PACKAGE}.{message}",
            options={"mode": "PERMISSIVE"},
            binaryDescriptorSet=descriptor_set(),
        )

    @F.arrow_udf(message_schema(message))
    def parse(payloads: pa.Array) -> pa.Array:
        return wire.read(payloads, message)

    # Keeps the optimizer from copying the call into filters on the result, which
    # would send every payload through Python once more.
    return parse.asNondeterministic()(payload)


def to_bytes(row: Column, message: str = "CallEvent", jvm: bool = False) -> Column:
    """``STRUCT`` to payload; NULL fields stay unset."""
    if jvm:
        from pyspark.sql.protobuf.functions import to_protobuf

        return to_protobuf(row, f"{PACKAGE}.{message}", binaryDescriptorSet=descriptor_set())

    @F.arrow_udf("binary")
    def serialise(rows: pa.Array) -> pa.Array:
        return wire.write(rows, message)

    return serialise(row)


def decode_protobuf(df: DataFrame, value: str = "value", message: str = "CallEvent") -> DataFrame:
    """Add ``event STRUCT`` decoded from ``value BINARY``; NULL when malformed."""
    return df.withColumn("event", from_bytes(F.col(value), message, in_jvm(df.sparkSession)))
