"""Event-time windows in UTC epoch milliseconds.

Two families: :func:`event_window` keeps the hour-anchored rules of the
aggregation protocol (each event lands in exactly one window, but windows of two
hours and more trail the event), :func:`aligned_window` is Spark's own tumbling
window, the one to use when the protocol does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS


def event_window_start(event_ms: Column, minutes: int) -> Column:
    """Start of the window holding an event, as BIGINT epoch milliseconds.

    ====================  =====================================================
    length                start
    ====================  =====================================================
    0 min                 the hour of the event (empty window)
    under 1 h             hour + whole multiples of the length within the hour
    1 h up to 2 h         the hour of the event
    2 h up to 24 h        the hour of the event, less the whole hours of length
    24 h and more         the same, floored to midnight
    ====================  =====================================================

    Only integer arithmetic, so it stays inside whole-stage codegen.
    """
    if minutes < 0:
        raise ValueError("window length must not be negative")
    into_hour = F.pmod(event_ms, F.lit(HOUR_MS))
    hour = event_ms - into_hour
    hours = minutes // 60
    if minutes == 0:
        return hour
    if hours == 0:
        return hour + into_hour - F.pmod(into_hour, F.lit(minutes * MINUTE_MS))
    if hours == 1:
        return hour
    start = hour - F.lit(hours * HOUR_MS)
    return start if hours < 24 else start - F.pmod(start, F.lit(DAY_MS))


def window_end(start_ms: Column, minutes: int) -> Column:
    return start_ms + F.lit(minutes * MINUTE_MS)


def interval_name(minutes: int) -> str:
    """Label of a window length: ``5m``, ``1h``, ``1d``."""
    if minutes < 60:
        return f"{minutes}m"
    if minutes < 24 * 60:
        return f"{minutes // 60}h"
    return f"{minutes // (24 * 60)}d"


def interval_label(start_ms: Column, end_ms: Column) -> Column:
    """Same label from a window's bounds, for tables that hold several lengths."""
    span = end_ms - start_ms

    def whole(unit_ms: int, suffix: str) -> Column:
        return F.concat(F.floor(span / F.lit(unit_ms)).cast("string"), F.lit(suffix))

    return (
        F.when(span < HOUR_MS, whole(MINUTE_MS, "m"))
        .when(span < DAY_MS, whole(HOUR_MS, "h"))
        .otherwise(whole(DAY_MS, "d"))
    )


def event_window(event_ms: Column, minutes: int) -> Column:
    """``STRUCT<start_ms, end_ms, interval>`` for an event."""
    start = event_window_start(event_ms, minutes)
    return F.struct(
        start.alias("start_ms"),
        window_end(start, minutes).alias("end_ms"),
        F.lit(interval_name(minutes)).alias("interval"),
    )


def aligned_window(event_time: Column, minutes: int) -> Column:
    """Spark's tumbling window on a TIMESTAMP column."""
    return F.window(event_time, f"{minutes} minutes")


def millis_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)
