"""Progress of streaming queries as rows."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Offsets are JSON whose shape depends on the source, so they stay text; see offset_rows.
PROGRESS = """
    id STRING, runId STRING, name STRING, timestamp STRING, batchId BIGINT, numInputRows BIGINT,
    inputRowsPerSecond DOUBLE, processedRowsPerSecond DOUBLE, durationMs MAP<STRING, BIGINT>,
    eventTime MAP<STRING, STRING>,
    stateOperators ARRAY<STRUCT<operatorName STRING, numRowsTotal BIGINT, numRowsUpdated BIGINT,
                                numRowsRemoved BIGINT, memoryUsedBytes BIGINT,
                                numRowsDroppedByWatermark BIGINT>>,
    sources ARRAY<STRUCT<description STRING, startOffset STRING, endOffset STRING, latestOffset STRING,
                         numInputRows BIGINT, inputRowsPerSecond DOUBLE, processedRowsPerSecond DOUBLE>>,
    sink STRUCT<description STRING>, observedMetrics MAP<STRING, MAP<STRING, BIGINT>>
"""


def _total(field: str, zero: Column) -> Column:
    """A figure of the whole query; reports in event logs have it per source only."""
    per_source = F.aggregate(
        F.col(f"sources.{field}"), zero, lambda total, x: total + F.coalesce(x, zero)
    )
    return F.coalesce(F.col(field), per_source)


def _state(field: str) -> Column:
    """A figure of all state operators of the query; null for a query without state."""
    figures = F.col(f"stateOperators.{field}")
    total = F.aggregate(figures, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.when(F.size(figures) > 0, total)


def progress_rows(reports: DataFrame, column: str = "progress") -> DataFrame:
    """Progress reports (JSON text) to one row per query and trigger.

    ``state_rows`` are the keys kept after the trigger, ``state_bytes`` their memory,
    ``state_updated`` and ``state_removed`` the keys that the trigger wrote and closed.
    ``late_partials`` counts what the watermark has dropped: rows that a task had merged
    before, one per key, so late *events* are more; see ``streaming.late`` for those.
    ``watermark`` is the one the trigger ran with.
    """
    return (
        reports.select(F.from_json(column, PROGRESS).alias("p"))
        .select("p.*")
        .select(
            F.col("name").alias("query"),
            F.col("id").alias("query_id"),
            F.col("runId").alias("run_id"),
            F.col("batchId").alias("batch_id"),
            F.to_timestamp("timestamp").alias("at"),
            _total("numInputRows", F.lit(0).cast("bigint")).alias("input_rows"),
            _total("inputRowsPerSecond", F.lit(0.0)).alias("input_rate"),
            _total("processedRowsPerSecond", F.lit(0.0)).alias("processed_rate"),
            F.col("durationMs").alias("durations"),
            F.to_timestamp(F.col("eventTime")["watermark"]).alias("watermark"),
            _state("numRowsTotal").alias("state_rows"),
            _state("numRowsUpdated").alias("state_updated"),
            _state("numRowsRemoved").alias("state_removed"),
            _state("memoryUsedBytes").alias("state_bytes"),
            _state("numRowsDroppedByWatermark").alias("late_partials"),
            "sources",
            F.col("sink.description").alias("sink"),
            F.col("observedMetrics").alias("observed"),
        )
    )


_PARTITIONS = "map<string,map<string,bigint>>"


def _per_partition(offset: Column) -> Column:
    """``MAP<STRUCT<topic, partition>, BIGINT>`` of an offset: topics with partitions, the
    log position of a file source, or a plain number."""
    topics = F.map_entries(F.from_json(offset, _PARTITIONS))
    pairs = F.flatten(
        F.transform(
            topics,
            lambda t: F.transform(
                F.map_entries(t.value),
                lambda p: F.struct(
                    F.struct(t.key.alias("topic"), p.key.cast("int").alias("partition")).alias("at"), p.value.alias("offset")
                ),
            ),
        )
    )
    position = F.coalesce(F.get_json_object(offset, "$.logOffset"), F.regexp_extract(offset, r"^\s*(-?\d+)\s*$", 1))
    position = F.when(position != "", position).cast("bigint")
    whole = F.struct(F.lit(None).cast("string").alias("topic"), F.lit(None).cast("int").alias("partition"))
    single = F.array(F.struct(whole.alias("at"), position.alias("offset")))
    return F.map_from_entries(F.when(position.isNotNull(), single).otherwise(pairs))


def offset_rows(progress: DataFrame) -> DataFrame:
    """Rows of :func:`progress_rows` to one row per trigger, source and partition.

    ``from_offset`` (null in a query's first trigger) and ``to_offset`` are what the trigger
    has read. For topics ``rows`` is their difference, and ``backlog`` what the broker
    held beyond; a source without partitions has its own count of rows in its single row.
    Offsets of other shapes leave the offset columns null.
    """
    source = progress.select(
        "query", "query_id", "run_id", "batch_id", "at", F.posexplode("sources").alias("source", "s")
    )
    read = source.select(
        *(c for c in source.columns if c != "s"),
        F.col("s.description").alias("description"),
        F.col("s.numInputRows").alias("_rows"),
        _per_partition(F.col("s.startOffset")).alias("_from"),
        _per_partition(F.col("s.endOffset")).alias("_to"),
        _per_partition(F.col("s.latestOffset")).alias("_latest"),
    )
    return read.select(
        *(c for c in read.columns if not c.startswith("_")),
        "_rows",
        "_from",
        "_latest",
        F.explode_outer("_to").alias("_at", "to_offset"),
    ).select(
        "query",
        "query_id",
        "run_id",
        "batch_id",
        "at",
        "source",
        "description",
        F.col("_at.topic").alias("topic"),
        F.col("_at.partition").alias("partition"),
        F.try_element_at("_from", F.col("_at")).alias("from_offset"),
        "to_offset",
        F.when(F.col("_at.topic").isNull(), F.col("_rows"))
        .otherwise(F.col("to_offset") - F.try_element_at("_from", F.col("_at")))
        .alias("rows"),
        (F.try_element_at("_latest", F.col("_at")) - F.col("to_offset")).alias("backlog"),
    )


def consumption(offsets: DataFrame) -> DataFrame:
    """Rows of :func:`offset_rows` with running figures of each query's source and partition:
    ``rows_so_far`` up to the trigger, and ``backlog_change`` since the trigger before."""
    history = Window.partitionBy("query_id", "source", "topic", "partition").orderBy("batch_id")
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return offsets.withColumn("rows_so_far", F.sum("rows").over(so_far)).withColumn(
        "backlog_change", F.col("backlog") - F.lag("backlog").over(history)
    )


REPORTS = "kind STRING, query_id STRING, query STRING, report STRING"


class ProgressLog(StreamingQueryListener):
    """Appends every progress report, start and end of the session's queries to a table.

    Reports are written in groups of ``every``, and all that are left when a query
    ends or :meth:`flush` is called; nothing is dropped.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self._spark, self._path, self._every = spark, path, every
        self._waiting: list[tuple] = []
        self._changed = threading.Condition()
        self._ended: set[str] = set()

    def _add(self, kind: str, query_id, query: str | None, report: str | None) -> None:
        with self._changed:
            self._waiting.append((kind, str(query_id), query, report))
            full = kind == "terminated" or len(self._waiting) >= self._every
        if full:
            self.flush()

    def onQueryStarted(self, event):
        self._add("started", event.id, event.name, None)

    def onQueryProgress(self, event):
        self._add("progress", event.progress.id, event.progress.name, event.progress.json)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._add("terminated", event.id, None, event.exception)
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def flush(self) -> None:
        with self._changed:
            rows, self._waiting = self._waiting, []
        if rows:
            table = self._spark.createDataFrame(rows, REPORTS)
            table.coalesce(1).write.mode("append").parquet(self._path)

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the end of this run of a query, and so all its reports, are in the table."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.id} within {seconds} s")

    def table(self) -> DataFrame:
        """``kind`` (``started``, ``progress``, ``terminated``), ``query_id, query, report``."""
        self.flush()
        return self._spark.read.schema(REPORTS).parquet(self._path)

    def rows(self) -> DataFrame:
        return progress_rows(self.table().where("kind = 'progress'"), "report")


_LOGS = "_signalstats_progress_logs"


def record_progress(spark: SparkSession, path: str) -> ProgressLog:
    """The session's log of that path; registered when first asked for, so that a job that
    starts again after a failure does not write each report once more."""
    logs = spark.__dict__.setdefault(_LOGS, {})
    if path not in logs:
        logs[path] = ProgressLog(spark, path)
        spark.streams.addListener(logs[path])
    return logs[path]


def stop_recording(spark: SparkSession, path: str) -> None:
    """Write what is left and take the log of that path off the session."""
    log = spark.__dict__.get(_LOGS, {}).pop(path, None)
    if log is not None:
        spark.streams.removeListener(log)
        log.flush()
