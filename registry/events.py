"""Decoding, filtering, projection and output of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import (
    SQL_CALLS,
    SQL_METRICS,
    SQL_MS,
    SQL_PDD,
    call_events,
    event_struct,
    metric_table,
    payloads,
)
from registry.aggregates import sql_window_stats
from signalstats.model import AGGREGATION, CALL_EVENT, DIMENSIONS
from signalstats.operators import decode
from signalstats.operators.dedup import drop_repeated
from signalstats.plans import batch
from signalstats.session import ship_package
from signalstats.sources import kafka, protobuf
from signalstats.sources.scratch import new_folder
from signalstats.sources.tables import read_events, read_scenario


def _flat(events):
    return events.select(
        "event_time",
        "logged_event_time",
        "event_id",
        "route_id",
        "event_type",
        F.col("signaling_event.name").alias("signal_name"),
        F.col("signaling_event.event_type").alias("signal_type"),
        F.col("signaling_event.pdd.pdd").cast("double").alias("pdd"),
        "signaling_event.call_state.state",
        "event_dimensions.*",
    )


_SQL_FLAT = "SELECT * REPLACE (CAST(pdd AS DOUBLE) AS pdd)"


@query(f"{_SQL_FLAT} FROM {SQL_CALLS} WHERE signal_name <> 'signup'")
def decode_json_events(spark, sf_dir):
    """JSON payloads to typed events; the malformed ones drop out."""
    return _flat(decode.valid(decode.decode_json(payloads(spark, sf_dir))))


@query(f"SELECT signal_name, count(*) AS payloads FROM {SQL_CALLS} WHERE signal_name = 'signup' GROUP BY ALL")
def quarantined_payloads(spark, sf_dir):
    """The malformed payloads, kept aside."""
    rejected = decode.quarantine(decode.decode_json(payloads(spark, sf_dir)))
    name = F.regexp_extract(F.col("value").cast("string"), '"signaling_event":\\{"name":"([a-z]+)"', 1)
    return rejected.groupBy(name.alias("signal_name")).agg(F.count(F.lit(1)).alias("payloads"))


@query(f"{_SQL_FLAT} FROM {SQL_CALLS}")
def event_json_roundtrip(spark, sf_dir):
    """Event to JSON text without unset fields, and back."""
    text = call_events(spark, sf_dir).select(decode.encode_json(event_struct()).alias("text"))
    return _flat(text.select(F.from_json("text", CALL_EVENT).alias("e")).select("e.*"))


@query(f"{_SQL_FLAT} FROM {SQL_CALLS} UNION ALL {_SQL_FLAT} FROM {SQL_CALLS}")
def scenario_load(spark, sf_dir):
    """Scenario documents, each with an event and its repetition."""
    folder = new_folder(spark, "scenario")
    events = call_events(spark, sf_dir)
    document = F.to_json(F.struct(F.array(event_struct(), event_struct()).alias("input"), F.lit("twice").alias("expected")))
    events.select(document.alias("value")).write.text(folder)
    return _flat(read_scenario(spark, folder, multi_line=False))


@query(f"{_SQL_FLAT} FROM {SQL_CALLS} WHERE signal_name <> 'signup'")
def decode_protobuf_events(spark, sf_dir):
    """Protobuf payloads to typed events; cut payloads drop out."""
    ship_package(spark)
    jvm = protobuf.in_jvm(spark)
    events = call_events(spark, sf_dir)
    sent = events.select("signaling_event.name", protobuf.to_bytes(event_struct(), jvm=jvm).alias("whole"))
    cut = F.expr("substring(whole, 1, octet_length(whole) - 1)")
    messages = sent.select(F.when(F.col("name") == "signup", cut).otherwise(F.col("whole")).alias("value"))
    return _flat(decode.valid(protobuf.decode_protobuf(messages)))

@query(sql_window_stats(SQL_PDD, 60, list(DIMENSIONS)))
def sink_protobuf_roundtrip(spark, sf_dir):
    """Aggregate rows as protobuf messages, and back."""
    ship_package(spark)
    jvm = protobuf.in_jvm(spark)
    rows = decode.metric_rows(call_events(spark, sf_dir))
    aggregates = batch.nested(batch.window_statistics(rows, 60))
    sent = aggregates.select(protobuf.to_bytes(F.struct(*AGGREGATION.names), "MetricAggregation", jvm).alias("value"))
    return batch.flattened(
        sent.select(protobuf.from_bytes(F.col("value"), "MetricAggregation", jvm).alias("a")).select("a.*")
    )


@query(f"SELECT event_id, event_time, route_id FROM {SQL_CALLS} WHERE event_type = 'signaling_event' AND signal_type = 'pdd'")
def signal_filter(spark, sf_dir):
    return decode.signal_events(call_events(spark, sf_dir)).select("event_id", "event_time", "route_id")


@query(f"SELECT event_id, state FROM {SQL_CALLS} WHERE event_type = 'signaling_event' AND signal_type = 'call_state'")
def signal_filter_call_state(spark, sf_dir):
    """The same filter for another signal type."""
    events = decode.signal_events(call_events(spark, sf_dir), "call_state")
    return events.select("event_id", "signaling_event.call_state.state")


@query(f"SELECT metric, event_time, country, direction, carrier, route, value FROM {SQL_PDD}", name="metric_rows")
def rows(spark, sf_dir):
    return decode.metric_rows(call_events(spark, sf_dir))


@query(
    f"""SELECT CASE WHEN signal_name = 'signup' THEN 'failed.to.parse'
                    WHEN event_type <> 'signaling_event' THEN 'unknown.call.event.type'
                    WHEN signal_type = 'unknown_event_type' THEN 'unknown' ELSE 'unsupported' END AS reason,
               count(*) AS events
        FROM {SQL_CALLS}
        WHERE signal_name = 'signup' OR event_type <> 'signaling_event' OR signal_type <> 'pdd' GROUP BY ALL""",
    name="reject_counts",
)
def rejects(spark, sf_dir):
    return decode.reject_counts(decode.decode_json(payloads(spark, sf_dir)))


@query(
    f"""SELECT CASE WHEN signal_name IN ('signup', 'purchase', 'view') THEN 'failed.to.parse'
                    ELSE 'unknown.call.event.type' END AS reason, count(*) AS events
        FROM {SQL_CALLS}
        WHERE signal_name IN ('signup', 'purchase', 'view') OR event_type <> 'signaling_event' GROUP BY ALL"""
)
def reject_counts_of_joined_payloads(spark, sf_dir):
    """Payloads with two events or with text after the event are malformed, as cut ones are."""
    name = F.col("event.signaling_event.name")
    decoded = decode.decode_json(payloads(spark, sf_dir))
    whole = F.col("value").cast("string")
    more = F.when(name == "purchase", F.concat(whole, whole)).when(name == "view", F.concat(whole, F.lit(" trailing")))
    joined = decoded.select(F.coalesce(more, whole).cast("binary").alias("value"))
    return decode.reject_counts(decode.decode_json(joined))


@query(
    f"""SELECT event_id, CASE WHEN event_type <> 'signaling_event' THEN 'unknown.call.event.type'
                              WHEN signal_type = 'pdd' THEN NULL
                              WHEN signal_type = 'unknown_event_type' THEN 'unknown' ELSE 'unsupported' END AS reason
        FROM {SQL_CALLS}"""
)
def reject_reasons(spark, sf_dir):
    """Every event with its reason, NULL for samples."""
    return call_events(spark, sf_dir).select("event_id", decode.reject_reason().alias("reason"))


@query(f"SELECT event_id, {SQL_MS} AS event_time, value FROM events")
def dedup_by_event_id(spark, sf_dir):
    """Every event delivered twice, counted once."""
    events = read_events(spark, sf_dir).select("event_id", F.unix_millis("ts").alias("event_time"), "value")
    return drop_repeated(events.unionByName(events))


@query(
    f"""SELECT event_id, {SQL_MS} AS event_time FROM events WHERE event_type <> 'error'
        UNION ALL SELECT CAST(NULL AS BIGINT), {SQL_MS} FROM events WHERE event_type = 'error'
        UNION ALL SELECT CAST(NULL AS BIGINT), {SQL_MS} FROM events WHERE event_type = 'error'"""
)
def dedup_keeps_unidentified(spark, sf_dir):
    """Events without an id are all kept, however often they come."""
    events = read_events(spark, sf_dir).select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("event_id"),
        F.unix_millis("ts").alias("event_time"),
    )
    return drop_repeated(events.unionByName(events))


@query(sql_window_stats(SQL_METRICS, 60, ["route"]))
def sink_message_roundtrip(spark, sf_dir):
    """Aggregate rows as key and JSON value of an output topic, and back."""
    aggregates = batch.window_statistics(metric_table(spark, sf_dir), 60, ["route"])
    messages = kafka.to_messages(aggregates)
    return messages.select(F.from_json("value", aggregates.schema).alias("a")).select("a.*")
