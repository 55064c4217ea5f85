"""Bytes to typed events, and events to metric rows.

Everything after the decoder is column expressions, so filters and column
pruning pass through to the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.model import CALL_EVENT, DIMENSIONS

_CORRUPT = "_corrupt"

#: Where the number of a signal type is, below ``signaling_event``.
VALUES = {"pdd": "pdd.pdd"}

# Reasons for leaving an event out of the metrics.
UNSUPPORTED = "unsupported"
UNKNOWN = "unknown"
UNKNOWN_CALL_EVENT = "unknown.call.event.type"
MALFORMED = "failed.to.parse"


def decode_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``event STRUCT`` decoded from JSON bytes or text; NULL when malformed.

    A payload is one JSON object; anything after it makes the payload malformed.

    The parsed struct goes through a one-element ``explode``: filters on its
    fields stop above that, where the optimizer would otherwise copy the parser
    into each of them and parse every payload several times.
    """
    # The parser would stop after a first document. Inside an array, whatever follows
    # it is a syntax error or a second element.
    schema = T.StructType(
        [T.StructField("e", T.ArrayType(CALL_EVENT)), T.StructField(_CORRUPT, T.StringType())]
    )
    text = F.concat(F.lit('{"e":['), F.col(value).cast("string"), F.lit("]}"))
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    decoded = df.withColumn("_parsed", F.explode(F.array(parsed)))
    good = F.col(f"_parsed.{_CORRUPT}").isNull() & (F.size("_parsed.e") == 1)
    return decoded.withColumn("event", F.when(good, F.get("_parsed.e", F.lit(0)))).drop("_parsed")


def encode_json(event: Column) -> Column:
    """JSON text of an event; unset fields are left out, enums go by name."""
    return F.to_json(event)


def valid(decoded: DataFrame) -> DataFrame:
    """The fields of the events that decoded."""
    return decoded.filter(F.col("event").isNotNull()).select("event.*")


def quarantine(decoded: DataFrame, value: str = "value") -> DataFrame:
    """The payloads that did not decode."""
    return decoded.filter(F.col("event").isNull()).select(value)


def _event_type(prefix: str) -> Column:
    return F.coalesce(F.col(f"{prefix}event_type"), F.lit("unknown_call_event"))


def _signal_type(prefix: str) -> Column:
    return F.coalesce(F.col(f"{prefix}signaling_event.event_type"), F.lit("unknown_event_type"))


def reject_reason(metric: str = "pdd", prefix: str = "") -> Column:
    """Why an event is not a ``metric`` sample; NULL for a sample."""
    return (
        F.when(_event_type(prefix) != "signaling_event", F.lit(UNKNOWN_CALL_EVENT))
        .when(_signal_type(prefix) == metric, F.lit(None).cast("string"))
        .when(_signal_type(prefix) == "unknown_event_type", F.lit(UNKNOWN))
        .otherwise(F.lit(UNSUPPORTED))
    )


def decoded_reject_reason(metric: str = "pdd") -> Column:
    """The same on the output of a decoder, where malformed payloads count too."""
    return F.when(F.col("event").isNull(), F.lit(MALFORMED)).otherwise(reject_reason(metric, "event."))


def reject_counts(decoded: DataFrame, metric: str = "pdd") -> DataFrame:
    """``reason, events`` over the left-out events of a batch."""
    return (
        decoded.select(decoded_reject_reason(metric).alias("reason"))
        .filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def observe_rejects(decoded: DataFrame, metric: str = "pdd", name: str = "rejects") -> DataFrame:
    """Count the left-out events of each batch or trigger on the side.

    The counts arrive as observed metrics (``Observation`` or query progress),
    without a second pass and without state.
    """
    reason = decoded_reject_reason(metric)
    counts = [
        F.count_if(reason == r).alias(r.replace(".", "_"))
        for r in (UNSUPPORTED, UNKNOWN, UNKNOWN_CALL_EVENT, MALFORMED)
    ]
    return decoded.observe(name, *counts)


def signal_events(events: DataFrame, metric: str = "pdd") -> DataFrame:
    """Keep signalling events of one signal type.

    Plain comparisons, which reach the scan: an unset type is never equal to a
    wanted one, so the defaults of ``reject_reason`` make no difference here.
    """
    if metric == "unknown_event_type":
        raise ValueError("the unset signal type is not a metric")
    return events.filter((F.col("event_type") == "signaling_event") & (F.col("signaling_event.event_type") == metric))


def metric_rows(events: DataFrame, metric: str = "pdd") -> DataFrame:
    """``metric, event_time, <dimensions>, value`` of the events of one signal type.

    Unset event times and values take the protocol's default, zero. A signal type
    that carries no number is no metric.
    """
    if metric not in VALUES:
        raise ValueError(f"{metric} has no value; metrics are {sorted(VALUES)}")
    return signal_events(events, metric).select(
        F.col("signaling_event.event_type").alias("metric"),
        F.coalesce("event_time", F.lit(0).cast("long")).alias("event_time"),
        *[F.col(f"event_dimensions.{d}").alias(d) for d in DIMENSIONS],
        F.coalesce(F.col(f"signaling_event.{VALUES[metric]}").cast("double"), F.lit(0.0)).alias("value"),
    )
