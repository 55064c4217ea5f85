"""The ``events`` table read as a file stream and drained into a result table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry import query
from registry.aggregates import _MANY, _sql_histogram, sql_window_stats
from registry.inputs import (
    SQL_CALLS,
    SQL_METRICS,
    SQL_MS,
    SQL_PDD,
    as_call_events,
    as_metric_rows,
    as_payloads,
    call_events,
    event_struct,
    sql_window_start,
)
from signalstats.model import DIMENSIONS, JobConfig
from signalstats.operators.dedup import SeenEvents, drop_repeated
from signalstats.operators.histogram import histogram, histogram_rows
from signalstats.plans import batch
from signalstats.session import ship_package
from signalstats.sources import protobuf
from signalstats.sources.ledger import LedgerTable
from signalstats.sources.scratch import new_folder
from signalstats.sources.tables import EVENTS, read_events
from signalstats.streaming import late, pipeline, progress, state
from signalstats.streaming.progress import ProgressLog, progress_rows

_DELAY = 120  # watermark delay in minutes
_HOUR = 60


def drained(spark, result, mode, name="drained"):
    """Run a stream over everything there is, then give its result table."""
    folder = new_folder(spark, name)
    pipeline.to_table(result, f"{folder}/table", f"{folder}/checkpoint", mode, name=name).awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/table").select(*result.columns)


def metric_stream(spark, sf_dir):
    return as_metric_rows(read_events(spark, sf_dir, streaming=True))


# The whole table arrives in one trigger, so the watermark that follows is the
# latest window less the delay.
_WATERMARK = f"(SELECT max({sql_window_start('event_time', _HOUR)}) - {_DELAY * 60000} FROM {SQL_METRICS})"
_CLOSED = f"HAVING window_start <= {_WATERMARK}"

@query(sql_window_stats(SQL_METRICS, _HOUR, [], _CLOSED))
def stream_append(spark, sf_dir):
    """Closed windows only."""
    result = pipeline.window_statistics(metric_stream(spark, sf_dir), _HOUR, _DELAY, [])
    return drained(spark, result, "append", "stream_append")


@query(sql_window_stats(SQL_METRICS, _HOUR, ["route"]))
def stream_update(spark, sf_dir):
    """A row per key that a trigger touched."""
    result = pipeline.window_statistics(metric_stream(spark, sf_dir), _HOUR, _DELAY, ["route"])
    return drained(spark, result, "update", "stream_update")


_EVENT_CLOSED = f"HAVING window_start + {_HOUR * 60000} <= (SELECT max(event_time) - {_DELAY * 60000} FROM {SQL_METRICS})"


@query(sql_window_stats(SQL_METRICS, _HOUR, [], _EVENT_CLOSED))
def stream_aligned_append(spark, sf_dir):
    """Spark's own windows, with the watermark on event time."""
    result = pipeline.aligned_statistics(metric_stream(spark, sf_dir), _HOUR, _DELAY, [])
    return drained(spark, result, "append", "stream_aligned")


@query(sql_window_stats(SQL_METRICS, _HOUR, []))
def stream_complete_many_triggers(spark, sf_dir):
    """The table cut into files and read one file per trigger; state adds up to the
    batch result."""
    folder = new_folder(spark, "stream_complete")
    read_events(spark, sf_dir).repartition(4, "event_id").write.parquet(f"{folder}/input")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/input")
    result = pipeline.window_statistics(as_metric_rows(stream), _HOUR, _DELAY, [])
    pipeline.to_table(result, f"{folder}/table", f"{folder}/checkpoint", "complete").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/table").select(*result.columns)


# -- several triggers, with late rows -----------------------------------------

_CHUNKS = 4
# A quarter of the time span per chunk; every tenth event comes two chunks late.
_SQL_CHUNKED = f"""(
    SELECT *, CASE WHEN late THEN least(quarter + 2, {_CHUNKS - 1}) ELSE quarter END AS chunk FROM (
        SELECT event_type AS metric, {SQL_MS} AS event_time, json_extract_string(props, '$.k') AS route, value,
               event_id % 10 = 3 AS late,
               {_CHUNKS} * ({SQL_MS} - (SELECT min({SQL_MS}) FROM events))
                   // ((SELECT max({SQL_MS}) - min({SQL_MS}) FROM events) + 1) AS quarter
        FROM events))"""
# Every row with the watermark with which the trigger before its own ran, which the
# chunks before that one have left.
_SQL_JUDGED = f"""(
    SELECT r.*, w.watermark FROM {_SQL_CHUNKED} r
    LEFT JOIN (SELECT c.chunk, max({sql_window_start('e.event_time', _HOUR)}) - {_DELAY * 60000} AS watermark
               FROM (SELECT unnest(range({_CHUNKS})) AS chunk) c JOIN {_SQL_CHUNKED} e ON e.chunk < c.chunk - 1
               GROUP BY c.chunk) w ON w.chunk = r.chunk)"""
# A row is late when its window starts at or before that watermark.
_SQL_ON_TIME = f"""(
    SELECT * FROM {_SQL_JUDGED} WHERE watermark IS NULL OR {sql_window_start('event_time', _HOUR)} > watermark)"""
# With windows that close at their end, when it ends at or before it.
_SQL_ON_TIME_AT_END = f"""(
    SELECT * FROM {_SQL_JUDGED}
    WHERE watermark IS NULL OR {sql_window_start('event_time', _HOUR)} + {_HOUR * 60000} > watermark)"""


def _sql_updates(dims: list[str], rows: str = _SQL_ON_TIME) -> str:
    """A row per chunk and key that it touched, with all rows so far."""
    return " UNION ALL ".join(
        sql_window_stats(f"(SELECT * FROM {rows} WHERE chunk <= {c})", _HOUR, dims, f"HAVING max(chunk) = {c}")
        for c in range(_CHUNKS)
    )


#: Rows per file of a chunk.
_FILE_ROWS = 1_000_000


def chunked_stream(spark, sf_dir):
    """The table in the order of time, with late rows, a chunk per trigger. All chunks have the
    same number of files, enough for the largest, and a trigger takes that many."""
    folder = new_folder(spark, "chunks")
    events = read_events(spark, sf_dir).withColumn("_ms", F.unix_millis("ts"))
    low, high = events.agg(F.min("_ms"), F.max("_ms")).first()
    quarter = F.floor(_CHUNKS * (F.col("_ms") - low) / (high - low + 1))
    late = F.col("event_id") % 10 == 3
    chunk = F.when(late, F.least(quarter + 2, F.lit(_CHUNKS - 1))).otherwise(quarter)
    numbered = events.withColumn("_chunk", chunk)
    sizes = [r["count"] for r in numbered.groupBy("_chunk").count().collect()]
    files = min(max(4, max(sizes) // _FILE_ROWS + 1), min(sizes))
    for i in range(_CHUNKS):  # one after the other: the source reads files by age
        rows = numbered.where(F.col("_chunk") == i).select("event_id", "ts", "user_id", "event_type", "value", "props")
        # Dealt out in turn, so no file is left out for want of rows.
        rows.repartition(files).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(folder)
    return as_metric_rows(stream)


@query(sql_window_stats(_SQL_ON_TIME, _HOUR, [], _CLOSED))
def stream_late_append(spark, sf_dir):
    """State over several triggers; late rows are dropped."""
    return drained(
        spark, pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, []), "append", "stream_late"
    )


@query(_sql_updates(["route"]))
def stream_late_update(spark, sf_dir):
    """Every trigger's rows for the keys it touched, merged with what was there."""
    result = pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, ["route"])
    return drained(spark, result, "update", "stream_late_update")


@query(f"{_sql_updates([])} UNION ALL {sql_window_stats(_SQL_ON_TIME, _HOUR, [], _CLOSED)}")
def stream_timeout_update(spark, sf_dir):
    """Every key when touched, and once more when its window is closed."""
    result = pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, [])
    touched = drained(spark, result, "update", "stream_touched")
    return touched.unionByName(drained(spark, result, "append", "stream_final"))


@query(sql_window_stats(_SQL_ON_TIME, _HOUR, ["route"], _CLOSED))
def stream_timeout_append(spark, sf_dir):
    """Keys once, when their window is closed."""
    result = pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, ["route"])
    return drained(spark, result, "append", "stream_timeout_append")


# -- windows that close at their end -------------------------------------------

_ENDED = f"HAVING window_start + {_HOUR * 60000} <= {_WATERMARK}"


@query(sql_window_stats(_SQL_ON_TIME_AT_END, _HOUR, ["route"], _ENDED))
def stream_end_append(spark, sf_dir):
    """Keys once, when the watermark has passed the end of their window; rows count until then."""
    result = pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, ["route"], closes="end")
    return drained(spark, result, "append", "stream_end_append")


@query(
    f"{_sql_updates([], _SQL_ON_TIME_AT_END)} UNION ALL {sql_window_stats(_SQL_ON_TIME_AT_END, _HOUR, [], _ENDED)}"
)
def stream_end_update(spark, sf_dir):
    """Every key when touched, and once more when the watermark has passed its window's end."""
    result = pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, [], closes="end")
    touched = drained(spark, result, "update", "stream_end_touched")
    return touched.unionByName(drained(spark, result, "append", "stream_end_final"))


# -- late rows, state, offsets ---------------------------------------------------


@query(
    f"""SELECT chunk AS batch, metric, event_time, route, value, watermark FROM {_SQL_JUDGED}
        WHERE {sql_window_start('event_time', _HOUR)} <= watermark"""
)
def stream_late_rows(spark, sf_dir):
    """The rows that the hourly statistics drop as late, by trigger, with the watermark they missed."""
    folder = new_folder(spark, "stream_late_rows")
    rows = chunked_stream(spark, sf_dir)
    late.late_rows_to_table(rows, folder, f"{folder}/checkpoint", _HOUR, _DELAY).awaitTermination()
    return late.late_rows(spark, folder, rows.schema)


@query(
    f"""SELECT chunk AS batch_id, count(*) AS input_rows,
               count(*) FILTER ({sql_window_start('event_time', _HOUR)} <= watermark) AS late_events,
               count(*) FILTER ({sql_window_start('event_time', _HOUR)} <= watermark) > 0 AS state_dropped
        FROM {_SQL_JUDGED} GROUP BY chunk"""
)
def stream_late_counts(spark, sf_dir):
    """Late events per trigger as counted aside, and whether the aggregation itself reports
    drops in the same trigger (it counts merged rows, not events)."""
    folder = new_folder(spark, "stream_late_counts")
    rows = chunked_stream(spark, sf_dir)
    log = ProgressLog(spark, f"{folder}/progress")
    spark.streams.addListener(log)
    try:
        late.late_rows_to_table(rows, folder, f"{folder}/checkpoint", _HOUR, _DELAY).awaitTermination()
        result = pipeline.window_statistics(rows, _HOUR, _DELAY, [])
        counted = pipeline.to_table(result, f"{folder}/table", f"{folder}/state", "append", name="late_counts")
        counted.awaitTermination()
        log.wait(counted)
    finally:
        spark.streams.removeListener(log)
    aside = late.late_rows(spark, folder, rows.schema).groupBy(F.col("batch").alias("batch_id")).agg(F.count("*").alias("late_events"))
    reported = log.rows().where((F.col("query_id") == str(counted.id)) & (F.col("input_rows") > 0))
    return reported.join(aside, "batch_id", "left").select(
        "batch_id",
        "input_rows",
        F.coalesce("late_events", F.lit(0)).alias("late_events"),
        (F.col("late_partials") > 0).alias("state_dropped"),
    )


@query(
    f"""SELECT metric, window_start AS closes_at FROM (
            SELECT DISTINCT metric, {sql_window_start('event_time', _HOUR)} AS window_start FROM {_SQL_ON_TIME})
        WHERE window_start > {_WATERMARK}"""
)
def stream_open_keys(spark, sf_dir):
    """Keys that a stopped query still holds, read from its checkpoint: those not yet final."""
    folder = new_folder(spark, "stream_open_keys")
    result = pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, [])
    pipeline.to_table(result, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    held = state.open_keys(spark, f"{folder}/checkpoint")
    return held.select("metric", F.unix_millis("_window").alias("closes_at"))


@query(
    f"""SELECT chunk AS batch_id, chunk AS to_offset, count(*) AS rows,
               sum(count(*)) OVER (ORDER BY chunk) AS rows_so_far FROM {_SQL_CHUNKED} GROUP BY chunk"""
)
def stream_offsets(spark, sf_dir):
    """What each trigger has read from the source, and the running total."""
    folder = new_folder(spark, "stream_offsets")
    log = ProgressLog(spark, f"{folder}/progress")
    spark.streams.addListener(log)
    try:
        run = pipeline.to_table(chunked_stream(spark, sf_dir), f"{folder}/table", f"{folder}/checkpoint", name="offsets")
        run.awaitTermination()
        log.wait(run)
    finally:
        spark.streams.removeListener(log)
    own = log.rows().where((F.col("query_id") == str(run.id)) & (F.col("input_rows") > 0))
    return progress.consumption(progress.offset_rows(own)).select("batch_id", "to_offset", "rows", "rows_so_far")


# -- several lengths, one table, one sight of each event --------------------------

_SQL_LATE_BY_TIME = f"""(
    SELECT r.* FROM {_SQL_CHUNKED} r
    LEFT JOIN (SELECT c.chunk, max(e.event_time) - {_DELAY * 60000} AS watermark
               FROM (SELECT unnest(range({_CHUNKS})) AS chunk) c JOIN {_SQL_CHUNKED} e ON e.chunk < c.chunk - 1
               GROUP BY c.chunk) w ON w.chunk = r.chunk
    WHERE w.watermark IS NULL OR r.event_time - r.event_time % 300000 + 300000 > w.watermark)"""
_SQL_DAYS = sql_window_stats(
    _SQL_LATE_BY_TIME,
    1440,
    [],
    f"HAVING window_start + 86400000 <= (SELECT max(event_time) - {_DELAY * 60000} FROM {SQL_METRICS})",
    start="(event_time - event_time % 86400000)",
)


@query(_SQL_DAYS)
def stream_rolled_up(spark, sf_dir):
    """Events to 5 minutes, these to hours, these to days, in one query over several triggers."""
    result = pipeline.rolled_up_statistics(chunked_stream(spark, sf_dir), [5, 60, 1440], _DELAY, [])
    return drained(spark, result, "append", "stream_rolled_up")


@query(sql_window_stats(_SQL_ON_TIME, _HOUR, ["route"]))
def stream_latest_rows(spark, sf_dir):
    """One row per key, the latest of update mode, in a table that is merged day by day."""
    folder = new_folder(spark, "stream_latest")
    result = pipeline.window_statistics(chunked_stream(spark, sf_dir), _HOUR, _DELAY, ["route"])
    table = LedgerTable(
        spark,
        f"{folder}/table",
        result.schema,
        ["metric", "window_start", "route"],
        F.floor(F.col("window_start") / 86_400_000),
        merge_every=3,
    )
    pipeline.to_latest(result, table, f"{folder}/checkpoint").awaitTermination()
    return table.latest()


@query(f"SELECT 'E' || event_id AS event_id, {SQL_MS} AS event_time FROM events")
def stream_seen_events(spark, sf_dir):
    """All events delivered three times: at once, and again after the watermark has passed them."""
    folder = new_folder(spark, "stream_seen")
    events = as_call_events(read_events(spark, sf_dir)).select("event_id", "event_time")
    for copies in (2, 1):
        events.withColumn("copy", F.explode(F.array(*map(F.lit, range(copies))))).drop("copy").write.mode("append").parquet(
            f"{folder}/input"
        )
    files = len(spark.read.parquet(f"{folder}/input").inputFiles()) // 2
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(files, 1)).parquet(f"{folder}/input")

    def sink(rows, batch):
        rows.write.mode("overwrite").parquet(f"{folder}/new/batch={batch}")

    seen = SeenEvents(spark, f"{folder}/seen", merge_every=1)
    pipeline.writer(stream, "append", f"{folder}/checkpoint", drain=True).foreachBatch(seen.keep(sink)).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{folder}/new").select("event_id", "event_time")


@query(
    f"""SELECT round(avg(p99), 6) AS avg_p99, count(*) AS keys FROM ({sql_window_stats(SQL_METRICS, _HOUR, ["route"])})"""
)
def stream_memory_table(spark, sf_dir):
    """A named query with its result in memory, and SQL on that name."""
    result = pipeline.window_statistics(metric_stream(spark, sf_dir), _HOUR, _DELAY, ["route"])
    name = f"memory_{uuid.uuid4().hex}"
    running = pipeline.to_memory(pipeline.writer(result, "update"), name)
    try:
        running.processAllAvailable()
        return spark.sql(f"SELECT round(avg(p99), 6) AS avg_p99, count(*) AS keys FROM {name}")
    finally:
        running.stop()


@query(sql_window_stats(SQL_METRICS, _HOUR, []))
def stream_processing_time(spark, sf_dir):
    """A trigger every second until the source is drained; the latest rows per key."""
    folder = new_folder(spark, "stream_every")
    result = pipeline.window_statistics(metric_stream(spark, sf_dir), _HOUR, _DELAY, [])
    running = pipeline.to_table(
        result, f"{folder}/table", f"{folder}/checkpoint", "complete", every="1 second", drain=False
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(result.schema).parquet(f"{folder}/table").select(*result.columns)


@query(_sql_histogram(_MANY[:40], "metric", SQL_METRICS))
def stream_histogram_many_splits(spark, sf_dir):
    """Forty splits on a stream, by the plan that serves tables."""
    result = histogram(metric_stream(spark, sf_dir), ["metric"], _MANY[:40])
    return histogram_rows(drained(spark, result, "update", "stream_histogram"), _MANY[:40]).drop("samples")


@query(sql_window_stats(SQL_PDD, 5, list(DIMENSIONS)))
def stream_call_statistics(spark, sf_dir):
    """The whole job as a stream: payloads, decoding, filter, windows, state."""
    process = pipeline.event_processor(JobConfig())
    result = process(as_payloads(read_events(spark, sf_dir, streaming=True)))
    return batch.flattened(drained(spark, result, "update", "stream_calls"))


@query(f"SELECT 'E' || event_id AS event_id, {SQL_MS} AS event_time FROM events")
def stream_dedup(spark, sf_dir):
    """Events delivered twice in a stream, kept once."""
    events = as_call_events(read_events(spark, sf_dir, streaming=True)).select("event_id", "event_time")
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    timed = twice.withColumn("at", F.timestamp_millis("event_time")).withWatermark("at", "2 hours")
    return drained(spark, drop_repeated(timed).select("event_id", "event_time"), "append", "stream_dedup")


@query("SELECT 'stream_progress' AS query, count(*) AS input_rows FROM events")
def stream_progress_rates(spark, sf_dir):
    """Progress reports of a run over the table, from the table they are appended to.
    Rates differ from run to run; the rows read do not."""
    log = ProgressLog(spark, new_folder(spark, "progress"))
    spark.streams.addListener(log)
    try:
        folder = new_folder(spark, "stream_progress")
        result = pipeline.window_statistics(metric_stream(spark, sf_dir), _HOUR, _DELAY, [])
        run = pipeline.to_table(result, f"{folder}/table", f"{folder}/checkpoint", name="stream_progress")
        run.awaitTermination()
        log.wait(run)
    finally:
        spark.streams.removeListener(log)
    return (
        log.rows()
        .where((F.col("query_id") == str(run.id)) & (F.col("input_rate") >= 0) & (F.col("processed_rate") >= 0))
        .groupBy("query")
        .agg(F.sum("input_rows").alias("input_rows"))
    )


# -- the whole job ----------------------------------------------------------


def _job(spark, sf_dir):
    """Protobuf payloads, some of them cut, through the job as it is configured."""
    ship_package(spark)
    folder = new_folder(spark, "job")
    whole = protobuf.to_bytes(event_struct(), jvm=protobuf.in_jvm(spark))
    sent = call_events(spark, sf_dir).select("signaling_event.name", whole.alias("whole"))
    cut = F.expr("substring(whole, 1, octet_length(whole) - 1)")
    value = F.when(F.col("name") == "signup", cut).otherwise(F.col("whole"))
    sent.select(value.alias("value")).write.parquet(f"{folder}/topic")
    config = JobConfig(
        query_name=f"job-{folder[-8:]}", payload_format="protobuf", final_rows=True, reject_path=f"{folder}/rejects"
    )
    log = ProgressLog(spark, f"{folder}/progress")
    spark.streams.addListener(log)

    def sink(rows, mode, name):
        path = f"{folder}/{'final' if name.endswith('.final') else 'table'}"
        return pipeline.to_table(rows, path, f"{path}-checkpoint", mode, name)

    try:
        messages = spark.readStream.schema("value BINARY").parquet(f"{folder}/topic")
        queries = pipeline.start_job(messages, config, sink, drain=True)
        for running in queries:
            running.awaitTermination()
            log.wait(running)
    finally:
        spark.streams.removeListener(log)
    return folder, config

@query(sql_window_stats(SQL_PDD, 5, list(DIMENSIONS)))
def stream_job_protobuf(spark, sf_dir):
    """Aggregate rows of the configured job over protobuf payloads."""
    folder, _ = _job(spark, sf_dir)
    return batch.flattened(spark.read.parquet(f"{folder}/table").drop("batch"))

@query(
    f"""SELECT CASE WHEN signal_name = 'signup' THEN 'failed_to_parse'
                    WHEN event_type <> 'signaling_event' THEN 'unknown_call_event_type'
                    WHEN signal_type = 'unknown_event_type' THEN 'unknown' ELSE 'unsupported' END AS reason,
               count(*) AS events
        FROM {SQL_CALLS}
        WHERE signal_name = 'signup' OR event_type <> 'signaling_event' OR signal_type <> 'pdd' GROUP BY ALL
        UNION ALL SELECT 'quarantined', count(*) FROM {SQL_CALLS} WHERE signal_name = 'signup'"""
)
def stream_job_rejects(spark, sf_dir):
    """Left-out events as the job reports them, and the payloads it has put aside."""
    folder, config = _job(spark, sf_dir)
    reports = spark.read.parquet(f"{folder}/progress").where("kind = 'progress'")
    counts = (
        progress_rows(reports, "report")
        .where(F.col("query") == config.query_name)
        .select(F.explode(F.col("observed")["rejects"]).alias("reason", "events"))
        .groupBy("reason")
        .agg(F.sum("events").alias("events"))
        .where("events > 0")
    )
    aside = spark.read.schema("value BINARY").parquet(f"{folder}/rejects/rows")
    return counts.unionByName(aside.select(F.lit("quarantined").alias("reason")).groupBy("reason").agg(F.count("*").alias("events")))
