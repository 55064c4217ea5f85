"""Streaming form of the aggregation, its triggers and its sinks.

The plan is the batch plan plus a watermark: a built-in ``groupBy().agg()``, so
every task first merges its own rows into one partial row per key and only those
go to the shuffle and the state store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from signalstats.functions.windows import MINUTE_MS, event_window_start, window_end
from signalstats.model import DIMENSIONS, SKETCH_K, JobConfig
from signalstats.operators.decode import decode_json, metric_rows, observe_rejects, quarantine, valid
from signalstats.operators.rollup import merge_parts
from signalstats.operators.stats import aggregate, finalize
from signalstats.plans.batch import describe_windows, nested
from signalstats.session import ship_package
from signalstats.sources import kafka, protobuf
from signalstats.sources.ledger import LedgerTable
from signalstats.streaming.progress import record_progress

Processor = Callable[[DataFrame], DataFrame]

_WINDOW = "_window"


def output_mode(name: str | None) -> str:
    """``complete``, ``update`` or ``append``; anything else means update."""
    return name if name in ("complete", "update", "append") else "update"


def with_window_watermark(
    rows: DataFrame, minutes: int, watermark_minutes: int, closes: str = "start"
) -> DataFrame:
    """Add ``_window``, the start or end of the window, and let the watermark follow it.

    The watermark is the latest window start less the delay in both cases. With
    ``closes="start"`` a window is closed, and its rows are late, once the watermark has
    reached its start; with ``closes="end"`` once it has reached its end: the same bound,
    reckoned from the end of the latest window, is one window longer ago.
    """
    start = event_window_start(F.col("event_time"), minutes)
    if closes == "start":
        return rows.withColumn(_WINDOW, F.timestamp_millis(start)).withWatermark(_WINDOW, f"{watermark_minutes} minutes")
    if closes != "end":
        raise ValueError(f"a window closes at its start or its end, not at {closes!r}")
    end = F.timestamp_millis(window_end(start, minutes))
    return rows.withColumn(_WINDOW, end).withWatermark(_WINDOW, f"{watermark_minutes + minutes} minutes")


def window_statistics(
    rows: DataFrame,
    minutes: int,
    watermark_minutes: int,
    dimensions: Sequence[str] = DIMENSIONS,
    k: int = SKETCH_K,
    id_algorithm: str = "md5",
    closes: str = "start",
) -> DataFrame:
    """Flat aggregate rows of a stream (or table) of metric rows.

    In update mode a row per touched key and trigger, in append mode one row per
    key once the watermark has passed its window's start, or its end with
    ``closes="end"``, in complete mode all.
    """
    keyed = with_window_watermark(rows, minutes, watermark_minutes, closes)
    stats = finalize(aggregate(keyed, ["metric", _WINDOW, *dimensions], k=k))
    start = F.unix_millis(_WINDOW) - (0 if closes == "start" else minutes * MINUTE_MS)
    started = stats.withColumn("window_start", start).drop(_WINDOW)
    return describe_windows(started, minutes, dimensions, id_algorithm)


def aligned_statistics(
    rows: DataFrame,
    minutes: int,
    watermark_minutes: int,
    dimensions: Sequence[str] = DIMENSIONS,
    k: int = SKETCH_K,
    id_algorithm: str = "md5",
) -> DataFrame:
    """The same with Spark's own tumbling windows and the watermark on event time."""
    timed = rows.withColumn("_at", F.timestamp_millis("event_time")).withWatermark("_at", f"{watermark_minutes} minutes")
    windowed = timed.withColumn(_WINDOW, F.window("_at", f"{minutes} minutes"))
    stats = finalize(aggregate(windowed, ["metric", _WINDOW, *dimensions], k=k))
    started = stats.withColumn("window_start", F.unix_millis(f"{_WINDOW}.start")).drop(_WINDOW)
    return describe_windows(started, minutes, dimensions, id_algorithm)


def rolled_up_statistics(
    rows: DataFrame,
    minutes: Sequence[int],
    watermark_minutes: int,
    dimensions: Sequence[str] = DIMENSIONS,
    k: int = SKETCH_K,
    id_algorithm: str = "md5",
) -> DataFrame:
    """Statistics of the last of several window lengths, each built from the one before
    inside one query: events to 5 minutes, these to 1 hour, these to 1 day.

    Windows are calendar-aligned and every length is a multiple of the one before. Append
    mode only: a closed window's mergeable row goes on to the next length, so the state of
    a length holds a sketch per open window and, of the windows that have closed inside it,
    their counts and moments; events are kept at the first length alone. Moments are merged
    in the order of time, by the formula for two parts, so values far from zero lose no
    digits and the order in which tasks deliver does not matter.
    """
    first, *longer = minutes
    if any(b % a for a, b in zip(minutes[:-1], longer, strict=True)):
        raise ValueError(f"the lengths {list(minutes)} do not nest")
    timed = rows.withColumn("_at", F.timestamp_millis("event_time")).withWatermark("_at", f"{watermark_minutes} minutes")
    partial = aggregate(
        timed.withColumn(_WINDOW, F.window("_at", f"{first} minutes")), ["metric", _WINDOW, *dimensions], k=k
    )
    for length in longer:
        partial = merge_parts(_widened(partial, length), ["metric", _WINDOW, *dimensions], "_part", k)
    stats = finalize(partial)
    started = stats.withColumn("window_start", F.unix_millis(f"{_WINDOW}.start")).drop(_WINDOW)
    return describe_windows(started, minutes[-1], dimensions, id_algorithm)


def _widened(partial: DataFrame, minutes: int) -> DataFrame:
    """Mergeable rows with ``_part``, the start of their window, in a longer window."""
    timed = partial.withColumn("_part", F.col(f"{_WINDOW}.start")).withColumn("_time", F.window_time(_WINDOW))
    return timed.drop(_WINDOW).withColumn(_WINDOW, F.window("_time", f"{minutes} minutes"))


def decoder(config: JobConfig) -> Processor:
    """Adds ``event`` decoded from ``value`` in the configured format."""
    if config.payload_format == "json":
        return decode_json
    if config.payload_format == "protobuf":
        return protobuf.decode_protobuf
    raise ValueError(f"unknown payload format: {config.payload_format}")


def event_processor(config: JobConfig, decode: Processor | None = None) -> Processor:
    """The whole job as one function from ``value`` payloads to aggregate rows.

    Left-out events are counted per trigger under the name ``rejects``.
    """

    def process(messages: DataFrame) -> DataFrame:
        decoded = observe_rejects((decode or decoder(config))(messages), config.metric)
        rows = metric_rows(valid(decoded), config.metric)
        return nested(
            window_statistics(
                rows,
                config.window_minutes,
                config.watermark_minutes,
                id_algorithm=config.id_algorithm,
                closes=config.closing,
            )
        )

    return process


# -- writing ----------------------------------------------------------------


def writer(
    result: DataFrame,
    mode: str = "update",
    checkpoint: str | None = None,
    name: str | None = None,
    every: str | None = None,
    drain: bool = False,
) -> DataStreamWriter:
    """Stream writer with mode, name, checkpoint and trigger set.

    ``every`` is a processing-time interval; ``drain`` processes what is there,
    in as many triggers as the source's rate limit asks for, and ends.
    """
    stream = result.writeStream.outputMode(output_mode(mode))
    if name:
        stream = stream.queryName(name)
    if checkpoint:
        stream = stream.option("checkpointLocation", checkpoint)
    if drain:
        return stream.trigger(availableNow=True)
    return stream.trigger(processingTime=every) if every else stream


def to_memory(stream: DataStreamWriter, name: str) -> StreamingQuery:
    """Result as an in-memory table, for tests and looking around: it is held on
    the driver."""
    return stream.format("memory").queryName(name).start()


def to_kafka(result: DataFrame, config: JobConfig, mode: str | None = None, name: str | None = None) -> StreamingQuery:
    """Aggregate rows to the configured topic, keyed by dimension hash."""
    if config.sink is None or config.checkpoint_path is None:
        raise ValueError("a topic sink needs a sink topic and a checkpoint path")
    checkpoint = config.checkpoint_path if name is None else f"{config.checkpoint_path}/{name}"
    stream = writer(
        kafka.to_messages(result, config.output_format),
        mode or config.output_mode,
        checkpoint,
        name or config.query_name,
        config.trigger_interval,
    )
    return stream.format("kafka").options(**kafka.writer_options(config.sink)).start()


def to_table(
    result: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    name: str | None = None,
    every: str | None = None,
    drain: bool = True,
) -> StreamingQuery:
    """Parquet folder. Append mode uses Spark's file sink. Update mode writes each
    trigger to its own ``batch=`` folder, replaced as a whole if the trigger runs
    again after a failure. Complete mode replaces the one table that it keeps."""
    stream = writer(result, mode, checkpoint, name, every, drain)
    if output_mode(mode) == "append":
        return stream.format("parquet").option("path", path).start()
    complete = output_mode(mode) == "complete"

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(path if complete else f"{path}/batch={batch}")

    return stream.foreachBatch(write).start()


def to_latest(
    result: DataFrame,
    table: LedgerTable,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    drain: bool = True,
) -> StreamingQuery:
    """Rows of update mode to a table of the latest row per key, see
    :class:`~signalstats.sources.ledger.LedgerTable`: readers see one row per key while the
    query runs, and a trigger that runs again after a failure changes nothing. A table
    belongs to one checkpoint."""
    return writer(result, "update", checkpoint, name, every, drain).foreachBatch(table.write).start()


#: Starts a query that writes rows in a mode under a name.
Sink = Callable[[DataFrame, str, str], StreamingQuery]


def start_job(messages: DataFrame, config: JobConfig, sink: Sink, drain: bool = False) -> list[StreamingQuery]:
    """Start the queries of a job: statistics, their final rows, malformed payloads.

    A window is final when the watermark has passed its start or, with
    ``config.closing`` at the ``end``, its end; with ``final_rows`` a second query in append
    mode then writes its keys once more, in the first trigger after that. Both queries
    read the source on their own, keep built-in state only and take the same rows as late.
    """
    name = config.query_name
    queries = [sink(event_processor(config)(messages), config.output_mode, name)]
    if config.final_rows and output_mode(config.output_mode) == "update":
        rows = metric_rows(valid(decoder(config)(messages)), config.metric)
        final = window_statistics(
            rows,
            config.window_minutes,
            config.watermark_minutes,
            id_algorithm=config.id_algorithm,
            closes=config.closing,
        )
        queries.append(sink(nested(final), "append", f"{name}.final"))
    if config.reject_path:
        rejects = quarantine(decoder(config)(messages))
        queries.append(
            to_table(
                rejects,
                f"{config.reject_path}/rows",
                f"{config.reject_path}/checkpoint",
                name=f"{name}.rejects",
                every=config.trigger_interval,
                drain=drain,
            )
        )
    return queries


def run_job(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Topic in, statistics, topic out; the query of the statistics."""
    if config.source is None:
        raise ValueError("no source topic configured")
    if "protobuf" in (config.payload_format, config.output_format) or config.id_algorithm == "murmur3":
        ship_package(spark)
    if config.progress_path:
        record_progress(spark, config.progress_path)

    def sink(rows: DataFrame, mode: str, name: str) -> StreamingQuery:
        return to_kafka(rows, config, mode, None if name == config.query_name else name)

    return start_job(kafka.read_stream(spark, config.source), config, sink)[0]
