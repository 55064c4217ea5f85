import json

import pytest
from pyspark.sql import functions as F

from signalstats.model import JobConfig, TopicConfig
from signalstats.plans import batch, ops_metrics
from signalstats.sources import eventlog, kafka
from signalstats.sources.scratch import new_folder, shared_folder
from signalstats.sources.tables import read_events
from signalstats.streaming import pipeline
from signalstats.streaming.progress import progress_rows

SOURCE = TopicConfig(
    "call.events",
    conf={
        "kafka.bootstrap.servers": "broker:9092",
        "startingOffsets": "earliest",
        "failOnDataLoss": False,
        "kafkaConsumer.pollTimeoutMs": 5000,
        "maxOffsetsPerTrigger": 200000,
    },
)


def test_reader_options():
    assert kafka.reader_options(SOURCE) == {
        "kafka.bootstrap.servers": "broker:9092",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafkaConsumer.pollTimeoutMs": "5000",
        "maxOffsetsPerTrigger": "200000",
        "subscribe": "call.events",
    }
    assert kafka.reader_options(TopicConfig("call.*", "subscribePattern")) == {"subscribePattern": "call.*"}


def test_writer_options():
    sink = TopicConfig("call.aggregations", conf={"kafka.bootstrap.servers": "broker:9092"})
    assert kafka.writer_options(sink) == {"kafka.bootstrap.servers": "broker:9092", "topic": "call.aggregations"}


def test_topic_jobs_need_both_ends(spark):
    with pytest.raises(ValueError):
        pipeline.run_job(spark, JobConfig())
    with pytest.raises(ValueError):
        pipeline.to_kafka(spark.range(1), JobConfig(source=SOURCE))


def test_messages_are_json_without_unset_fields(spark):
    rows = spark.createDataFrame([("pdd", 1, "h", None, "us")], "metric string, n int, dimension_hash string, route string, country string")
    message = kafka.to_messages(rows).head()
    assert message.key == "h"
    assert json.loads(message.value) == {"metric": "pdd", "n": 1, "dimension_hash": "h", "country": "us"}


def test_events_do_not_depend_on_the_session_time_zone(spark, conf, sf_dir):
    query = read_events(spark, sf_dir).agg(F.sum(F.unix_millis("ts"))).head()[0]
    conf("spark.sql.session.timeZone", "America/New_York")
    assert read_events(spark, sf_dir).agg(F.sum(F.unix_millis("ts"))).head()[0] == query


def test_time_filter_and_columns_reach_the_scan(spark, sf_dir, capsys):
    events = read_events(spark, sf_dir).filter(F.col("ts") >= F.timestamp_millis(F.lit(1705000000000)))
    rows = events.select(F.col("event_type").alias("metric"), F.unix_millis("ts").alias("event_time"), "value")
    batch.window_statistics(rows, 60, []).explain("formatted")
    plan = capsys.readouterr().out
    lines = plan.splitlines()
    assert "GreaterThanOrEqual(ts" in next(line for line in lines if line.startswith("PushedFilters"))
    assert "ReadSchema: struct<ts:timestamp,event_type:string,value:double>" in lines
    # One exchange, fed by rows that are already merged per key.
    assert sum("Exchange" in line and line.startswith("(") for line in lines) == 1
    assert "partial_kll_sketch_agg_double" in plan


def test_scratch_folder_is_the_shared_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


LINES = [
    ("a", '{"Event":"SparkListenerApplicationStart","App Name":"n","App ID":"a","Timestamp":10,"User":"u"}'),
    ("a", '{"Event":"SparkListenerExecutorAdded","Timestamp":20,"Executor ID":"1","Executor Info":{"Host":"h"}}'),
    ("a", '{"Event":"SparkListenerExecutorAdded","Timestamp":20,"Executor ID":"2","Executor Info":{"Host":"h"}}'),
    ("a", '{"Event":"SparkListenerExecutorRemoved","Timestamp":4000000,"Executor ID":"1","Removed Reason":"lost"}'),
    ("a", '{"Event":"SparkListenerExecutorAdded","Timestamp":9000000,"Executor ID":"3","Executor Info":{"Host":"h"}}'),
    ("b", '{"Event":"SparkListenerExecutorAdded","Timestamp":5,"Executor ID":"1","Executor Info":{"Host":"h"}}'),
    ("a", '{"Event":"SparkListenerTaskGettingResult","Task Info":{"Task ID":1,"Getting Result Time":77}}'),
    ("a", '{"Event":"org.apache.spark.sql.streaming.StreamingQueryListener$QueryStartedEvent","id":"i","runId":"r",'
     '"name":"q","timestamp":"1970-01-01T00:00:01.500Z"}'),
    ("a", '{"Event":"org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart","executionId":3,"time":100}'),
    ("a", '{"Event":"org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd","executionId":3,"time":350}'),
    ("a", '{"Event":"org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart","executionId":4,"time":100}'),
    ("a", '{"Event":"org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd","executionId":5,"time":90}'),
    ("b", '{"Event":"org.apache.spark.sql.streaming.StreamingQueryListener$QueryTerminatedEvent","id":"i","runId":"r"}'),
    ("a", "not an event"),
]


def test_compressed_logs_are_read(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    lines = [line for _, line in LINES]
    frames = [zstandard.ZstdCompressor().compress(f"{line}\n".encode()) for line in lines]
    (tmp_path / "eventlog_v2_app-1").mkdir()
    (tmp_path / "eventlog_v2_app-1" / "events_1_app-1.zstd").write_bytes(b"".join(frames))
    (tmp_path / "app-2.zstd.inprogress").write_bytes(b"".join(frames))
    (tmp_path / "app-3").write_text("\n".join(lines))
    log = eventlog.read_event_log(spark, str(tmp_path))
    assert sorted(tuple(r) for r in log.collect()) == sorted((f"app-{i}", x) for i in (1, 2, 3) for x in lines)
    ends = eventlog.lifecycle_events(log).where("event = 'QueryTerminatedEvent'").collect()
    assert [r.time for r in ends] == [None] * 3


def test_metrics_of_log_lines(spark):
    log = spark.createDataFrame(LINES, "app string, line string")
    counts = sorted(map(tuple, ops_metrics.executor_counts(log).collect()))
    assert counts == [("a", 20, 2), ("a", 4000000, 1), ("a", 9000000, 2), ("b", 5, 1)]
    durations = sorted(map(tuple, ops_metrics.sql_durations(log).collect()), key=repr)
    assert durations == [("a", 3, 100, 350, 250), ("a", 4, 100, None, None), ("a", 5, None, 90, None)]
    times = {r.event: (r.first, r.events) for r in ops_metrics.lifecycle(log).collect()}
    assert times == {
        "SparkListenerApplicationStart": (10, 1),
        "SparkListenerTaskGettingResult": (77, 1),
        "QueryStartedEvent": (1500, 1),
        "QueryTerminatedEvent": (None, 1),
    }


def test_metrics_of_a_real_log(spark, tmp_path):
    """The log of a second session that runs a query, a failing task and a stream."""
    import subprocess
    import sys

    script = tmp_path / "job.py"
    script.write_text(
        f"""
import pathlib
from pyspark.sql import SparkSession, functions as F
folder = {str(tmp_path)!r}
pathlib.Path(folder + "/log").mkdir()
spark = (SparkSession.builder.master("local[2]").appName("watched").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.compress", "false").config("spark.eventLog.dir", "file:" + folder + "/log").getOrCreate())
spark.range(1000).groupBy((F.col("id") % 3).alias("k")).count().write.parquet(folder + "/out")
try:
    spark.range(1).select(F.raise_error(F.lit("no"))).collect()
except Exception:
    pass
stream = spark.readStream.schema("k long, count long").parquet(folder + "/out")
stream.writeStream.queryName("copied").trigger(availableNow=True).format("parquet").option("path", folder + "/copy").option(
    "checkpointLocation", folder + "/checkpoint").start().awaitTermination()
spark.stop()
"""
    )
    subprocess.run([sys.executable, str(script)], check=True, capture_output=True, timeout=300)
    log = eventlog.read_event_log(spark, str(tmp_path / "log")).persist()
    apps = [r.app for r in log.select("app").distinct().collect()]
    assert len(apps) == 1 and apps[0].startswith("local-")
    outcomes = ops_metrics.task_outcomes(log).head()
    assert outcomes.completed > 2 and outcomes.failed == 1 and outcomes.executor == "driver"
    reasons = {r.reason: r.tasks for r in ops_metrics.task_end_reasons(log).collect()}
    assert reasons["ExceptionFailure"] == 1 and reasons["Success"] == outcomes.completed
    times = {r.metric: r for r in ops_metrics.task_time_statistics(log).collect()}
    assert set(times) == set(ops_metrics.TASK_TIMES)
    assert times["spark.task.duration"].samples == outcomes.completed + outcomes.failed
    assert ops_metrics.stage_measures(log).agg(F.sum("records_written")).head()[0] >= 3
    assert [r.executors for r in ops_metrics.executor_counts(log).collect()] == [1]
    assert ops_metrics.sql_durations(log).filter("duration >= 0").count() >= 2
    executions = ops_metrics.execution_measures(log).collect()
    assert sum(r.tasks for r in executions) == outcomes.completed + outcomes.failed
    known = {r.execution for r in ops_metrics.sql_durations(log).collect()}
    assert {r.execution for r in executions if r.execution is not None} <= known
    assert sum(r.records_written for r in executions if r.execution is not None) >= 3
    assert {"SparkListenerApplicationStart", "SparkListenerApplicationEnd", "QueryStartedEvent"} <= {
        r.event for r in ops_metrics.lifecycle(log).collect()
    }
    rows = progress_rows(eventlog.progress_reports(log))
    assert rows.filter("query = 'copied'").agg(F.sum("input_rows")).head()[0] == 3
    rates = ops_metrics.stream_rate_statistics(rows)
    assert {r.metric for r in rates.collect()} == set(ops_metrics.STREAM_RATES)
