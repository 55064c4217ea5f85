"""Operational metrics over event-log lines that Spark derives from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import SQL_MS, sql_stats
from signalstats.plans import ops_metrics
from signalstats.sources import eventlog
from signalstats.sources.tables import read_events
from signalstats.streaming.progress import progress_rows


def log_table(spark, sf_dir):
    """``app, line``: clicks and views are tasks, purchases SQL executions with a job each, signups
    executors that join and (the smaller ones) leave, errors lifecycle events."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = read_events(spark, sf_dir).select(
        "event_id",
        F.unix_millis("ts").alias("ms"),
        "user_id",
        F.col("event_type").alias("kind"),
        "value",
        F.floor("value").alias("size"),
        k.alias("k"),
    )

    def event(name, **fields):
        return F.to_json(F.struct(F.lit(name).alias("Event"), *[c.alias(n.replace("_", " ")) for n, c in fields.items()]))

    failed = (F.col("kind") == "view") & (F.col("value") > 50)
    info = F.struct(
        F.col("event_id").alias("Task ID"),
        F.col("k").cast("string").alias("Executor ID"),
        F.col("ms").alias("Launch Time"),
        (F.col("ms") + F.col("size") * 100).alias("Finish Time"),
        failed.alias("Failed"),
    )
    metrics = F.struct(
        (F.col("size") * 7).alias("Executor CPU Time"),
        F.col("size").alias("JVM GC Time"),
        (F.col("size") * 90).alias("Executor Run Time"),
        F.col("k").alias("Executor Deserialize Time"),
        (F.col("k") * 3).alias("Executor Deserialize CPU Time"),
        F.lit(1).cast("bigint").alias("Result Serialization Time"),
        F.col("user_id").alias("Result Size"),
        (F.col("user_id") * 1024).alias("Peak Execution Memory"),
        F.when(failed, F.col("user_id")).otherwise(0).cast("bigint").alias("Disk Bytes Spilled"),
        F.struct((F.col("user_id") * 10).alias("Bytes Read"), F.col("user_id").alias("Records Read")).alias("Input Metrics"),
        F.struct((F.col("k") * 10).alias("Bytes Written"), F.col("k").alias("Records Written")).alias("Output Metrics"),
    )
    reason = F.struct(
        F.when(failed & (F.col("value") > 100), "ExecutorLostFailure").when(failed, "ExceptionFailure").otherwise("Success").alias("Reason")
    )
    task = event(
        eventlog.TASK_END,
        Stage_ID=F.floor(F.col("k") / 20).cast("int"),
        Stage_Attempt_ID=F.lit(0),
        Task_Type=F.lit("ResultTask"),
        Task_End_Reason=reason,
        Task_Info=info,
        Task_Metrics=metrics,
    )
    execution = {"executionId": F.col("event_id")}
    end = F.col("ms") + F.col("size") * 1000
    lines = (
        F.when(F.col("kind").isin("click", "view"), F.array(task))
        .when(
            F.col("kind") == "purchase",
            F.array(
                event(eventlog.SQL_START, **execution, description=F.lit("q"), time=F.col("ms")),
                event(
                    eventlog.JOB_START,
                    Job_ID=F.col("event_id"),
                    Stage_IDs=F.array(F.floor(F.col("k") / 20).cast("int"), F.lit(-1)),
                    Properties=F.when(F.col("value") > 5, F.create_map(F.lit("spark.sql.execution.id"), F.col("event_id").cast("string"))),
                ),
                F.when(F.col("value") < 100, event(eventlog.SQL_END, **execution, time=end)),
            ),
        )
        .when(
            F.col("kind") == "signup",
            F.array(
                event(eventlog.EXECUTOR_ADDED, Timestamp=F.col("ms")),
                F.when(F.col("value") < 40, event(eventlog.EXECUTOR_REMOVED, Timestamp=end)),
            ),
        )
        .otherwise(
            F.array(
                F.when(F.col("value") < 30, event(eventlog.APPLICATION_START, App_Name=F.lit("a"), Timestamp=F.col("ms"))).otherwise(
                    event(eventlog.APPLICATION_END, Timestamp=F.col("ms"))
                )
            )
        )
    )
    app = F.when(F.col("k") < 50, "app-1").otherwise("app-2")
    exploded = events.select(app.alias("app"), F.explode(lines).alias("line"))
    return exploded.filter(F.col("line").isNotNull())


_EVENTS = f"""(SELECT event_id, user_id, event_type AS kind, value, CAST(floor(value) AS BIGINT) AS size, {SQL_MS} AS ms, k,
        CASE WHEN k < 50 THEN 'app-1' ELSE 'app-2' END AS app, event_type = 'view' AND value > 50 AS failed
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""
_TASKS = f"(SELECT *, CAST(k AS VARCHAR) AS executor FROM {_EVENTS} WHERE kind IN ('click', 'view'))"


@query(
    f"""SELECT app, executor, metric, {sql_stats()} FROM (
        SELECT app, executor, 'spark.task.duration' AS metric, CAST(size * 100 AS DOUBLE) AS value FROM {_TASKS}
        UNION ALL SELECT app, executor, 'spark.task.executor.cpu.time', CAST(size * 7 AS DOUBLE) FROM {_TASKS}
        UNION ALL SELECT app, executor, 'spark.task.jvm.gc.time', CAST(size AS DOUBLE) FROM {_TASKS}) GROUP BY ALL"""
)
def log_task_times(spark, sf_dir):
    return ops_metrics.task_time_statistics(log_table(spark, sf_dir))


@query(
    f"""SELECT app, executor, count(*) FILTER (WHERE NOT failed) AS completed, count(*) FILTER (WHERE failed) AS failed
        FROM {_TASKS} GROUP BY ALL"""
)
def log_task_outcomes(spark, sf_dir):
    return ops_metrics.task_outcomes(log_table(spark, sf_dir))


@query(
    f"""SELECT app, CASE WHEN failed AND value > 100 THEN 'ExecutorLostFailure' WHEN failed THEN 'ExceptionFailure'
                         ELSE 'Success' END AS reason, count(*) AS tasks FROM {_TASKS} GROUP BY ALL"""
)
def log_task_end_reasons(spark, sf_dir):
    return ops_metrics.task_end_reasons(log_table(spark, sf_dir))


def _sums(**columns: str) -> str:
    return ", ".join(f"CAST(sum({sql}) AS BIGINT) AS {name}" for name, sql in columns.items())


_STAGE_SUMS = _sums(
    records_read="user_id",
    bytes_read="user_id * 10",
    records_written="k",
    bytes_written="k * 10",
    disk_spilled="CASE WHEN failed THEN user_id ELSE 0 END",
    cpu_time="size * 7",
    deserialize_cpu_time="k * 3",
    deserialize_time="k",
    run_time="size * 90",
    gc_time="size",
    result_serialization_time="1",
)


@query(
    f"""SELECT app, CAST(k // 20 AS INTEGER) AS stage, 0 AS stage_attempt, count(*) AS tasks, {_STAGE_SUMS},
               max(user_id) AS max_result_size, max(user_id * 1024) AS max_peak_memory FROM {_TASKS} GROUP BY ALL"""
)
def log_stage_measures(spark, sf_dir):
    return ops_metrics.stage_measures(log_table(spark, sf_dir))


@query(
    f"""WITH jobs AS (
            SELECT app, event_id AS job, CASE WHEN value > 5 THEN event_id END AS execution, k // 20 AS stage
            FROM {_EVENTS} WHERE kind = 'purchase'
        ), owner AS (SELECT app, stage, arg_min(struct_pack(e := execution), job).e AS execution FROM jobs GROUP BY ALL),
        measured AS (
            SELECT t.app, o.execution, count(DISTINCT t.k // 20) AS stages, count(*) AS tasks, {_STAGE_SUMS},
                   max(user_id) AS max_result_size, max(user_id * 1024) AS max_peak_memory
            FROM {_TASKS} t LEFT JOIN owner o ON o.app = t.app AND o.stage = t.k // 20 GROUP BY ALL
        ), started AS (SELECT app, execution, count(*) AS jobs FROM jobs GROUP BY ALL)
        SELECT coalesce(m.app, s.app) AS app, coalesce(m.execution, s.execution) AS execution, coalesce(jobs, 0) AS jobs,
               {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("stages", "tasks", *ops_metrics.SUMMED))},
               max_result_size, max_peak_memory
        FROM measured m FULL JOIN started s ON m.app = s.app AND m.execution IS NOT DISTINCT FROM s.execution"""
)
def log_execution_measures(spark, sf_dir):
    """Tasks by way of stages and jobs to the SQL execution that they ran for."""
    return ops_metrics.execution_measures(log_table(spark, sf_dir))


@query(
    f"""SELECT app, time, CAST(sum(sum(delta)) OVER (PARTITION BY app ORDER BY time) AS BIGINT) AS executors FROM (
            SELECT app, ms AS time, 1 AS delta FROM {_EVENTS} WHERE kind = 'signup'
            UNION ALL SELECT app, ms + size * 1000, -1 FROM {_EVENTS} WHERE kind = 'signup' AND value < 40) GROUP BY app, time"""
)
def log_executor_counts(spark, sf_dir):
    return ops_metrics.executor_counts(log_table(spark, sf_dir))


@query(
    f"""SELECT app, event_id AS execution, ms AS started, CASE WHEN value < 100 THEN ms + size * 1000 END AS ended,
               CASE WHEN value < 100 THEN size * 1000 END AS duration
        FROM {_EVENTS} WHERE kind = 'purchase'"""
)
def log_sql_durations(spark, sf_dir):
    return ops_metrics.sql_durations(log_table(spark, sf_dir))


@query(
    f"""SELECT app, CASE WHEN value < 30 THEN 'SparkListenerApplicationStart' ELSE 'SparkListenerApplicationEnd' END AS event,
               min(ms) AS "first", max(ms) AS "last", count(*) AS events FROM {_EVENTS} WHERE kind = 'error' GROUP BY ALL"""
)
def log_lifecycle(spark, sf_dir):
    return ops_metrics.lifecycle(log_table(spark, sf_dir))


@query(
    f"""SELECT query, metric, {sql_stats()} FROM (
        SELECT kind || '-' || k AS query, 'spark.query.progress.processed.rows.rate' AS metric, floor(value) AS value
        FROM {_EVENTS}
        UNION ALL SELECT kind || '-' || k, 'spark.query.progress.input.rows.rate', floor(value / 2) FROM {_EVENTS}
    ) GROUP BY ALL"""
)
def log_stream_rates(spark, sf_dir):
    """Rates of progress reports made from the events, one report per event."""
    report = F.to_json(
        F.struct(
            F.concat_ws("-", "event_type", F.get_json_object("props", "$.k")).alias("name"),
            F.col("event_id").alias("batchId"),
            (F.col("value") / 2).alias("inputRowsPerSecond"),
            F.col("value").alias("processedRowsPerSecond"),
        )
    )
    reports = read_events(spark, sf_dir).select(report.alias("progress"))
    return ops_metrics.stream_rate_statistics(progress_rows(reports))
