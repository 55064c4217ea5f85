"""Batch and streaming readers of event tables and JSON event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.model import CALL_EVENT

# `ts` is stored without a time zone. Declared TIMESTAMP, its digits are read as
# UTC whatever the session time zone; it can carry a watermark (TIMESTAMP_NTZ
# cannot) and filters on it still reach the scan. An explicit schema also saves
# the footer reads of schema inference.
EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

_SCENARIO = T.StructType(
    [
        T.StructField("input", T.ArrayType(CALL_EVENT)),
        T.StructField("expected", T.StringType()),
    ]
)


def read_events(spark: SparkSession, directory: str, streaming: bool = False, **options: str) -> DataFrame:
    """The ``events`` parquet table of a directory, as a table or as a file stream."""
    if streaming:
        # A file stream takes a plain path for a folder. Written as a pattern, it
        # may be one file or a folder of files, as for the batch reader.
        return spark.readStream.schema(EVENTS).options(**options).parquet(f"{directory}/{{events}}.parquet")
    return spark.read.schema(EVENTS).options(**options).parquet(f"{directory}/events.parquet")


def read_scenario(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Events of scenario documents ``{"input": [event, ...], "expected": ...}``.

    One document per file, or one per line without ``multi_line``; only the
    latter lets Spark split large files.
    """
    documents = spark.read.schema(_SCENARIO).json(path, multiLine=multi_line)
    return documents.select(F.explode("input").alias("e")).select("e.*")


def read_json_values(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Files with one JSON event per line, as a ``value BINARY`` column like a topic's.

    For a stream, ``maxFilesPerTrigger`` is the rate limit.
    """
    reader = (spark.readStream if streaming else spark.read).options(**options)
    return reader.text(path).select(F.col("value").cast("binary").alias("value"))


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """Schema on stdout and the first rows as a DataFrame."""
    df.printSchema()
    return df.limit(rows)
