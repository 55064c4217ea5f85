"""Operational metrics of Spark applications, as jobs over their event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstats.functions.windows import HOUR_MS
from signalstats.operators.stats import statistics
from signalstats.sources import eventlog

# Names of the published metrics.
TASK_TIMES = {
    "spark.task.duration": "duration",
    "spark.task.executor.cpu.time": "cpu_time",
    "spark.task.jvm.gc.time": "gc_time",
}
STREAM_RATES = {
    "spark.query.progress.processed.rows.rate": "processed_rate",
    "spark.query.progress.input.rows.rate": "input_rate",
}

SUMMED = (
    "records_read",
    "bytes_read",
    "records_written",
    "bytes_written",
    "disk_spilled",
    "cpu_time",
    "deserialize_cpu_time",
    "deserialize_time",
    "run_time",
    "gc_time",
    "result_serialization_time",
)
_PEAKS = ("result_size", "peak_memory")


def _measures(columns: dict[str, str]) -> Column:
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value")) for name, c in columns.items()]
    return F.explode(F.array(*pairs)).alias("m")


def task_time_statistics(log: DataFrame) -> DataFrame:
    """Distributions of task times per application and executor."""
    measured = eventlog.task_ends(log).select("app", "executor", _measures(TASK_TIMES))
    return statistics(measured.select("app", "executor", "m.*"), ["app", "executor", "metric"])


def task_outcomes(log: DataFrame) -> DataFrame:
    """Completed and failed tasks per application and executor."""
    return (
        eventlog.task_ends(log)
        .groupBy("app", "executor")
        .agg(F.count_if(~F.col("failed")).alias("completed"), F.count_if("failed").alias("failed"))
    )


def task_end_reasons(log: DataFrame) -> DataFrame:
    """How often tasks ended for each reason."""
    return eventlog.task_ends(log).groupBy("app", "reason").agg(F.count(F.lit(1)).alias("tasks"))


def stage_measures(log: DataFrame) -> DataFrame:
    """Input, output, spill, time and memory of the tasks of each stage attempt."""
    return (
        eventlog.task_ends(log)
        .groupBy("app", "stage", "stage_attempt")
        .agg(
            F.count(F.lit(1)).alias("tasks"),
            *[F.sum(c).alias(c) for c in SUMMED],
            *[F.max(c).alias(f"max_{c}") for c in _PEAKS],
        )
    )


def execution_measures(log: DataFrame) -> DataFrame:
    """Jobs, stages, tasks and what the tasks did, per application and SQL execution; jobs
    outside SQL have a null execution, and so have tasks of stages that no job start names.

    A stage that several jobs list ran for the first of them; the others skip it. Tasks are
    summed up per stage first, so the join has a row per stage.
    """
    jobs = eventlog.job_starts(log)
    owner = (
        jobs.select("app", F.explode("stages").alias("stage"), F.struct("job", "execution").alias("owner"))
        .groupBy("app", "stage")
        .agg(F.min("owner").alias("owner"))
    )
    measured = (
        stage_measures(log)
        .join(owner, ["app", "stage"], "left")
        .groupBy("app", F.col("owner.execution").alias("execution"))
        .agg(
            F.count_distinct("stage").alias("stages"),
            *[F.sum(c).alias(c) for c in ("tasks", *SUMMED)],
            *[F.max(f"max_{c}").alias(f"max_{c}") for c in _PEAKS],
        )
    )
    started = jobs.groupBy(F.col("app").alias("_app"), F.col("execution").alias("_execution")).agg(F.count("*").alias("jobs"))
    same = (F.col("app") == F.col("_app")) & F.col("execution").eqNullSafe(F.col("_execution"))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("jobs", "stages", "tasks", *SUMMED)]
    return measured.join(started, same, "full").select(
        F.coalesce("app", "_app").alias("app"),
        F.coalesce("execution", "_execution").alias("execution"),
        *counts,
        *[f"max_{c}" for c in _PEAKS],
    )


def executor_counts(log: DataFrame) -> DataFrame:
    """Live executors after every change: a running sum of joins and leaves.

    Changes of the same millisecond are combined first. The sum is then taken
    within hours (at most 3,600,000 rows each) and over hours, so that no task
    sees the whole life of an application at once.
    """
    hour = F.col("time") - F.pmod("time", F.lit(HOUR_MS))
    changes = eventlog.executor_changes(log).groupBy("app", hour.alias("hour"), "time").agg(F.sum("delta").alias("delta"))
    before = Window.partitionBy("app").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = (
        changes.groupBy("app", "hour")
        .agg(F.sum("delta").alias("delta"))
        .select("app", "hour", F.coalesce(F.sum("delta").over(before), F.lit(0)).alias("carried"))
    )
    within = Window.partitionBy("app", "hour").orderBy("time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        changes.withColumn("inside", F.sum("delta").over(within))
        .join(hours, ["app", "hour"])
        .select("app", "time", (F.col("carried") + F.col("inside")).alias("executors"))
    )


def sql_durations(log: DataFrame) -> DataFrame:
    """Start, end and duration of SQL executions; one shuffle, no join.

    An end whose start is in a log that is gone, or an execution that still runs,
    keeps NULL for what is not known.
    """
    started, ended = F.col("kind") == eventlog.SQL_START, F.col("kind") == eventlog.SQL_END
    return (
        eventlog.sql_executions(log)
        .groupBy("app", "execution")
        .agg(F.min(F.when(started, F.col("time"))).alias("started"), F.max(F.when(ended, F.col("time"))).alias("ended"))
        .withColumn("duration", F.col("ended") - F.col("started"))
    )


def lifecycle(log: DataFrame) -> DataFrame:
    """First and last time and number of lifecycle events per application."""
    return (
        eventlog.lifecycle_events(log)
        .groupBy("app", "event")
        .agg(F.min("time").alias("first"), F.max("time").alias("last"), F.count(F.lit(1)).alias("events"))
    )


def stream_rate_statistics(progress: DataFrame) -> DataFrame:
    """Distributions of whole rows per second, from rows of ``progress_rows``."""
    measured = progress.select("query", _measures(STREAM_RATES)).select("query", "m.metric", F.floor("m.value").alias("value"))
    return statistics(measured.withColumn("value", F.col("value").cast("double")), ["query", "metric"])
