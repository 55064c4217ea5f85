"""Spark event logs as tables.

A log is kept as ``app, line``: each reader below picks its kind of event by the
start of the line and only then parses the JSON, with just the fields it needs.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SQL = "org.apache.spark.sql.execution.ui.SparkListener"
_STREAMING = "org.apache.spark.sql.streaming.StreamingQueryListener$"

TASK_END = "SparkListenerTaskEnd"
JOB_START = "SparkListenerJobStart"
TASK_GETTING_RESULT = "SparkListenerTaskGettingResult"
APPLICATION_START = "SparkListenerApplicationStart"
APPLICATION_END = "SparkListenerApplicationEnd"
EXECUTOR_ADDED = "SparkListenerExecutorAdded"
EXECUTOR_REMOVED = "SparkListenerExecutorRemoved"
SQL_START = f"{_SQL}SQLExecutionStart"
SQL_END = f"{_SQL}SQLExecutionEnd"
QUERY_STARTED = f"{_STREAMING}QueryStartedEvent"
QUERY_PROGRESS = f"{_STREAMING}QueryProgressEvent"
QUERY_TERMINATED = f"{_STREAMING}QueryTerminatedEvent"

_TASK_END = """
    `Stage ID` INT, `Stage Attempt ID` INT, `Task Type` STRING,
    `Task End Reason` STRUCT<Reason: STRING>,
    `Task Info` STRUCT<`Task ID`: BIGINT, `Executor ID`: STRING, `Launch Time`: BIGINT, `Finish Time`: BIGINT,
                       Failed: BOOLEAN>,
    `Task Metrics` STRUCT<
        `Executor Deserialize Time`: BIGINT, `Executor Deserialize CPU Time`: BIGINT, `Executor Run Time`: BIGINT,
        `Executor CPU Time`: BIGINT, `Peak Execution Memory`: BIGINT, `Result Size`: BIGINT, `JVM GC Time`: BIGINT,
        `Result Serialization Time`: BIGINT, `Disk Bytes Spilled`: BIGINT,
        `Input Metrics`: STRUCT<`Bytes Read`: BIGINT, `Records Read`: BIGINT>,
        `Output Metrics`: STRUCT<`Bytes Written`: BIGINT, `Records Written`: BIGINT>>
"""


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """``app, line`` of a log folder; the application id is taken from file names,
    single (``app-1``) or rolling (``eventlog_v2_app-1/events_1_app-1``).

    Plain logs and those compressed with Spark's default codec (``.zstd``) are read. A
    compressed file is unpacked in one task, piece by piece; rolling keeps such files
    small.
    """
    file = F.regexp_extract("_metadata.file_name", r"^(?:events_\d+_)?(.+?)(?:\.zstd)?(?:\.inprogress)?$", 1)
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = reader.text(path).where(~F.col("_metadata.file_name").contains(".zstd"))
    packed = reader.option("pathGlobFilter", "*.zstd*").format("binaryFile").load(path)
    unpacked = packed.select(file.alias("app"), "content").mapInArrow(_unpacked, "app STRING, line STRING")
    return lines.select(file.alias("app"), F.col("value").alias("line")).unionByName(unpacked)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of compressed files, a few thousand at a time; a file that is still being
    written ends with its last whole line."""
    import zstandard

    def batch(app: str, lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([app] * len(lines)), pa.array(lines)], ["app", "line"])

    for files in batches:
        for app, content in zip(files.column("app").to_pylist(), files.column("content"), strict=True):
            stream = zstandard.ZstdDecompressor().stream_reader(
                pa.BufferReader(content.as_buffer()), read_across_frames=True
            )
            lines: list[str] = []
            for line in io.TextIOWrapper(stream, "utf-8", errors="replace"):
                if line.endswith("\n"):
                    lines.append(line[:-1])
                if len(lines) >= 5_000:
                    yield batch(app, lines)
                    lines = []
            if lines:
                yield batch(app, lines)


def events_of(log: DataFrame, *kinds: str) -> DataFrame:
    """``app, kind, line`` of some kinds of events."""
    kind = F.substring_index(F.substring_index("line", '"', 4), '"', -1)
    return log.select("app", kind.alias("kind"), "line").filter(F.col("kind").isin(*kinds))


def task_ends(log: DataFrame) -> DataFrame:
    """One row per finished task attempt. Times in ms, CPU times in ns."""
    task = events_of(log, TASK_END).select("app", F.from_json("line", _TASK_END).alias("e")).select("app", "e.*")
    info, metrics = F.col("Task Info"), F.col("Task Metrics")
    return task.select(
        "app",
        F.col("Stage ID").alias("stage"),
        F.col("Stage Attempt ID").alias("stage_attempt"),
        F.col("Task Type").alias("task_type"),
        F.col("Task End Reason")["Reason"].alias("reason"),
        info["Task ID"].alias("task"),
        info["Executor ID"].alias("executor"),
        info["Failed"].alias("failed"),
        (info["Finish Time"] - info["Launch Time"]).alias("duration"),
        metrics["Executor CPU Time"].alias("cpu_time"),
        metrics["JVM GC Time"].alias("gc_time"),
        metrics["Executor Run Time"].alias("run_time"),
        metrics["Executor Deserialize Time"].alias("deserialize_time"),
        metrics["Executor Deserialize CPU Time"].alias("deserialize_cpu_time"),
        metrics["Result Serialization Time"].alias("result_serialization_time"),
        metrics["Result Size"].alias("result_size"),
        metrics["Peak Execution Memory"].alias("peak_memory"),
        metrics["Disk Bytes Spilled"].alias("disk_spilled"),
        metrics["Input Metrics"]["Bytes Read"].alias("bytes_read"),
        metrics["Input Metrics"]["Records Read"].alias("records_read"),
        metrics["Output Metrics"]["Bytes Written"].alias("bytes_written"),
        metrics["Output Metrics"]["Records Written"].alias("records_written"),
    )


def job_starts(log: DataFrame) -> DataFrame:
    """``app, job, execution, stages``: the SQL execution that started a job (null for a job
    without one) and the stages that the job may run."""
    fields = "`Job ID` BIGINT, `Stage IDs` ARRAY<INT>, Properties MAP<STRING, STRING>"
    return events_of(log, JOB_START).select("app", F.from_json("line", fields).alias("e")).select(
        "app",
        F.col("e.Job ID").alias("job"),
        F.try_element_at("e.Properties", F.lit("spark.sql.execution.id")).cast("bigint").alias("execution"),
        F.col("e.Stage IDs").alias("stages"),
    )


def executor_changes(log: DataFrame) -> DataFrame:
    """``app, time, delta``: +1 when an executor joins, -1 when it leaves."""
    changes = events_of(log, EXECUTOR_ADDED, EXECUTOR_REMOVED)
    return changes.select(
        "app",
        F.get_json_object("line", "$.Timestamp").cast("bigint").alias("time"),
        F.when(F.col("kind") == EXECUTOR_ADDED, 1).otherwise(-1).alias("delta"),
    )


def sql_executions(log: DataFrame) -> DataFrame:
    """``app, execution, kind, time`` of starts and ends of SQL executions."""
    fields = F.from_json("line", "executionId BIGINT, time BIGINT").alias("e")
    return (
        events_of(log, SQL_START, SQL_END)
        .select("app", "kind", fields)
        .select("app", F.col("e.executionId").alias("execution"), "kind", F.col("e.time").alias("time"))
    )


def lifecycle_events(log: DataFrame) -> DataFrame:
    """``app, event, time`` of application, result and query events.

    Spark logs no time with the end of a query; it is NULL.
    """
    kinds = events_of(
        log, APPLICATION_START, APPLICATION_END, TASK_GETTING_RESULT, QUERY_STARTED, QUERY_TERMINATED
    )
    time = F.coalesce(
        F.get_json_object("line", "$.Timestamp").cast("bigint"),
        F.get_json_object("line", "$['Task Info']['Getting Result Time']").cast("bigint"),
        F.unix_millis(F.to_timestamp(F.get_json_object("line", "$.timestamp"))),
    )
    return kinds.select("app", F.substring_index(F.substring_index("kind", "$", -1), ".", -1).alias("event"), time.alias("time"))


def progress_reports(log: DataFrame) -> DataFrame:
    """``app, progress`` (JSON text) of streaming queries."""
    report = F.get_json_object("line", "$.progress")
    return events_of(log, QUERY_PROGRESS).select("app", report.alias("progress"))
