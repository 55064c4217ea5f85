"""The aggregation pipeline: metric rows -> window -> key -> statistics.

Each function takes and gives a DataFrame and serves tables and streams alike;
reading and writing stay outside.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstats.functions.ids import dimension_hash
from signalstats.functions.windows import event_window_start, interval_name, window_end
from signalstats.model import DIMENSIONS, SKETCH_K, WINDOW_MINUTES, JobConfig
from signalstats.operators.decode import decode_json, metric_rows, valid
from signalstats.operators.stats import BINS, STATS, aggregate, finalize

KEY = ("metric", "window_start")


def windowed(rows: DataFrame, minutes: int) -> DataFrame:
    """Add ``window_start`` (epoch ms) to rows with an ``event_time`` in epoch ms."""
    return rows.withColumn("window_start", event_window_start(F.col("event_time"), minutes))


def window_partials(
    rows: DataFrame, minutes: int, dimensions: Sequence[str] = DIMENSIONS, k: int = SKETCH_K
) -> DataFrame:
    """Mergeable rows per (metric, window, dimensions), for storing and rolling up.

    The window's end and label follow from its start, so only the start is part
    of the shuffled key. The column ``window_start`` carries the length as metadata,
    which Parquet keeps.
    """
    partial = aggregate(windowed(rows, minutes), [*KEY, *dimensions], k=k)
    return partial.withMetadata("window_start", {WINDOW_MINUTES: minutes})


def describe_windows(stats: DataFrame, minutes: int, dimensions: Sequence[str], id_algorithm: str = "md5") -> DataFrame:
    """Add window end, label and dimension hash to finished rows."""
    dims = {d: F.col(d) for d in dimensions}
    return stats.withColumns(
        {
            "window_end": window_end(F.col("window_start"), minutes),
            "window_interval": F.lit(interval_name(minutes)),
            "dimension_hash": dimension_hash(dims, id_algorithm),
        }
    )


def window_statistics(
    rows: DataFrame,
    minutes: int,
    dimensions: Sequence[str] = DIMENSIONS,
    k: int = SKETCH_K,
    id_algorithm: str = "md5",
) -> DataFrame:
    """Flat aggregate rows of metric rows."""
    stats = finalize(window_partials(rows, minutes, dimensions, k))
    return describe_windows(stats, minutes, dimensions, id_algorithm)


def _nested(fields: Sequence[str], present: Sequence[str]) -> Column:
    return F.struct(*[(F.col(f) if f in present else F.lit(None).cast("string")).alias(f) for f in fields])


def nested(flat: DataFrame) -> DataFrame:
    """Flat aggregate rows in the layout of the output message."""
    return flat.select(
        "metric",
        "window_start",
        "window_end",
        "window_interval",
        "samples",
        F.struct(*STATS).alias("stats"),
        F.struct(*BINS).alias("histogram"),
        _nested(DIMENSIONS, flat.columns).alias("dimensions"),
        "dimension_hash",
    )


def flattened(aggregates: DataFrame) -> DataFrame:
    """Output message layout to flat columns."""
    return aggregates.select(
        "metric",
        "window_start",
        "window_end",
        "window_interval",
        "samples",
        "stats.*",
        "histogram.*",
        "dimensions.*",
        "dimension_hash",
    )


def call_statistics(
    messages: DataFrame,
    config: JobConfig,
    decode: Callable[[DataFrame], DataFrame] = decode_json,
    id_algorithm: str = "md5",
) -> DataFrame:
    """Batch form of the whole job: ``value`` payloads to aggregate rows."""
    rows = metric_rows(valid(decode(messages)), config.metric)
    return nested(window_statistics(rows, config.window_minutes, id_algorithm=id_algorithm))
