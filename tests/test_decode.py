import json

import pyarrow as pa
import pytest
from golden import PDD_EVENTS, call_state_events, pdd_event, pdd_events
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from signalstats.model import AGGREGATION, CALL_EVENT, ENUMS, JobConfig, message_schema
from signalstats.operators import decode
from signalstats.operators.dedup import drop_repeated
from signalstats.plans import batch
from signalstats.sources import protobuf, wire
from signalstats.sources.tables import preview, read_scenario

def messages(spark, values):
    rows = [((v if isinstance(v, str) else json.dumps(v)).encode(),) for v in values]
    return spark.createDataFrame(rows, T.StructType([T.StructField("value", T.BinaryType())]))


def events(spark, values):
    return decode.valid(decode.decode_json(messages(spark, values)))


def test_scenario_document(spark, tmp_path):
    path = tmp_path / "scenario.json"
    path.write_text(json.dumps({"input": pdd_events()}, indent=2))
    loaded = read_scenario(spark, str(path))
    assert loaded.schema == CALL_EVENT
    assert [(r.event_time, r.event_id) for r in loaded.collect()] == [(e[0], e[2]) for e in PDD_EVENTS]
    rows = decode.metric_rows(loaded)
    assert batch.window_statistics(rows, 5).count() == 5


def test_call_state_scenario_gives_no_rows(spark, tmp_path):
    path = tmp_path / "scenario.json"
    path.write_text(json.dumps({"input": call_state_events(), "expected": []}))
    loaded = read_scenario(spark, str(path))
    assert loaded.count() == 6
    assert decode.metric_rows(loaded).count() == 0
    assert [r.state for r in loaded.select("signaling_event.call_state.state").collect()][0] == "initialized"


# The JSON text of two events.
JSON_TEXTS = [
    '{"event_time": 1527966284972,"logged_event_time": 1527966304972,"event_id": "CE1234",'
    '"event_type": "signaling_event","signaling_event": {"name": "progress","event_type": "call_state",'
    '"call_state": {"state": "initialized"}},'
    '"event_dimensions": {"country": "us","direction": "outbound","carrier": "telco_a"}}',
    '{"event_time": 1527966284972,"logged_event_time": 1527966304972,"event_id": "CE1234","route_id": "RI123",'
    '"event_type": "signaling_event","signaling_event": {"name": "preflight","event_type": "pdd",'
    '"pdd": {"pdd": 2.8}},"event_dimensions": {"country": "us","direction": "outbound","carrier": "telco_a"}}',
]


def test_json_text_of_events(spark):
    decoded = events(spark, JSON_TEXTS)
    texts = [r[0] for r in decoded.select(decode.encode_json(F.struct(*CALL_EVENT.names))).collect()]
    # The same document; only the blank after each colon is not written.
    assert texts == [t.replace('": ', '":') for t in JSON_TEXTS]


def test_unset_fields_take_defaults(spark):
    bare = {"event_type": "signaling_event", "signaling_event": {"event_type": "pdd"}}
    row = decode.metric_rows(events(spark, [bare])).head()
    assert (row.metric, row.event_time, row.value, row.country, row.route) == ("pdd", 0, 0.0, None, None)
    only = batch.window_statistics(decode.metric_rows(events(spark, [bare])), 5).head()
    assert (only.window_start, only.samples, only.max) == (0, 1, 0.0)


def test_values_keep_their_single_precision(spark):
    row = decode.metric_rows(events(spark, [pdd_event(1, 1, "a", 2.8)])).head()
    assert row.value == 2.799999952316284


@pytest.mark.parametrize(
    "event, reason",
    [
        (pdd_event(1, 1, "a", 1.0), None),
        (call_state_events()[0], "unsupported"),
        ({"event_type": "signaling_event", "signaling_event": {"event_type": "unknown_event_type"}}, "unknown"),
        ({"event_type": "signaling_event"}, "unknown"),
        ({"event_type": "unknown_call_event"}, "unknown.call.event.type"),
        ({"event_id": "x"}, "unknown.call.event.type"),
        ("{broken", "failed.to.parse"),
        ("", "failed.to.parse"),
        ('{"event_time":"soon"}', "failed.to.parse"),
    ],
)
def test_reject_reasons(spark, event, reason):
    decoded = decode.decode_json(messages(spark, [event]))
    assert decoded.select(decode.decoded_reject_reason().alias("r")).head().r == reason
    assert decode.reject_counts(decoded).count() == (0 if reason is None else 1)
    assert decode.metric_rows(decode.valid(decoded)).count() == (1 if reason is None else 0)


def test_malformed_payloads_go_to_quarantine(spark):
    decoded = decode.decode_json(messages(spark, [pdd_events()[0], "{broken", "null"]))
    assert decode.valid(decoded).count() == 1
    assert {bytes(r.value) for r in decode.quarantine(decoded).collect()} == {b"{broken", b"null"}


def test_observed_rejects_of_a_batch(spark):
    seen = Observation("seen")
    decoded = decode.decode_json(messages(spark, [*pdd_events()[:2], *call_state_events(), "x"]))
    reason = decode.decoded_reject_reason()
    observed = decoded.observe(seen, F.count_if(reason == decode.UNSUPPORTED).alias("unsupported"))
    assert decode.metric_rows(decode.valid(observed)).count() == 2
    assert seen.get["unsupported"] == 6


def test_filters_and_columns_reach_the_scan(spark, tmp_path, capsys):
    events(spark, [*pdd_events(), *call_state_events()]).write.parquet(str(tmp_path / "t"))
    rows = decode.metric_rows(spark.read.schema(CALL_EVENT).parquet(str(tmp_path / "t")))
    batch.window_statistics(rows, 5, ["carrier"]).explain("formatted")
    plan = capsys.readouterr().out
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert read == (
        "ReadSchema: struct<event_time:bigint,event_type:string,"
        "signaling_event:struct<event_type:string,pdd:struct<pdd:float>>,event_dimensions:struct<carrier:string>>"
    )
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(event_type,signaling_event)" in pushed and "EqualTo(signaling_event.event_type,pdd)" in pushed


def test_repeated_events_count_unless_dropped(spark):
    found = decode.metric_rows(events(spark, pdd_events()))
    assert found.count() == 22
    assert drop_repeated(events(spark, pdd_events())).count() == 21


def test_preview(spark, capsys):
    assert preview(events(spark, pdd_events()), 3).count() == 3
    assert "event_dimensions: struct" in capsys.readouterr().out


def test_protobuf_round_trip(spark):
    sent = events(spark, [*pdd_events(), *call_state_events(), {"event_id": "bare", "event_dimensions": {}}])
    payloads = sent.select(protobuf.to_bytes(F.struct(*CALL_EVENT.names)).alias("value"))
    back = decode.valid(protobuf.decode_protobuf(payloads))
    assert back.schema == CALL_EVENT
    assert sorted(map(repr, back.collect())) == sorted(map(repr, sent.collect()))


def test_protobuf_malformed_and_unknown(spark):
    payloads = messages(spark, [])
    bad = spark.createDataFrame([(b"\xff\xff\xff",), (b"\x0a",), (None,)], payloads.schema)
    decoded = protobuf.decode_protobuf(bad)
    assert decode.valid(decoded).count() == 0
    # An enum number that is not in the table counts as unset.
    future = spark.createDataFrame([(bytes([5 << 3, 77]),)], payloads.schema)
    assert decode.valid(protobuf.decode_protobuf(future)).head().event_type is None
    empty = spark.createDataFrame([(b"",)], payloads.schema)
    assert decode.reject_counts(protobuf.decode_protobuf(empty)).head().reason == "unknown.call.event.type"


def test_job_on_protobuf_payloads(spark):
    sent = events(spark, pdd_events()).select(protobuf.to_bytes(F.struct(*CALL_EVENT.names)).alias("value"))
    config = JobConfig(window_minutes=5)
    found = batch.call_statistics(sent, config, protobuf.decode_protobuf)
    expected = batch.call_statistics(messages(spark, pdd_events()), config)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    aggregates = found.select(protobuf.to_bytes(F.struct(*AGGREGATION.names), "MetricAggregation").alias("v"))
    back = aggregates.select(protobuf.from_bytes(F.col("v"), "MetricAggregation").alias("a")).select("a.*")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, found.collect()))


def test_wire_format(spark):
    """Fixed bytes: field numbers and types of the wire layout."""
    rows = pa.array([pdd_event(1, 2, "a", 2.0), None, {}], to_arrow_type(CALL_EVENT))
    assert wire.write(rows, "CallEvent").to_pylist() == [
        b"\x08\x01\x10\x02\x1a\x01a\x22\x03RI1\x28\x01"
        b"\x32\x14\x0a\x09preflight\x10\x01\x1a\x05\x0d\x00\x00\x00\x40"
        b"\x3a\x0b\x08\x0a\x10\x02\x18\x01\x22\x03RI1",
        None,
        b"",
    ]


def _library(message):
    """Message class of the protobuf package, from this package's description."""
    pool = pytest.importorskip("google.protobuf.descriptor_pool").DescriptorPool()
    from google.protobuf import descriptor_pb2, message_factory

    for file in descriptor_pb2.FileDescriptorSet.FromString(protobuf.descriptor_set()).file:
        pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"signalstats.{message}"))


def _as_row(message):
    names = {f"{e}": ENUMS[e] for e in ENUMS}
    row = {}
    for field, value in message.ListFields():
        if field.message_type:
            value = _as_row(value)
        elif field.enum_type:
            value = names[field.enum_type.name][value]
        row[field.name] = value
    return row


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6), st.randoms(use_true_random=False))
def test_reader_agrees_with_the_library(junk, rng):
    """Valid, cut, doubled, joined and random payloads."""
    new = _library("CallEvent")
    from google.protobuf.message import DecodeError

    whole = wire.write(pa.array([pdd_event(2**40, 0, "é" * 70, 0.5), {"event_dimensions": {}}], to_arrow_type(CALL_EVENT)), "CallEvent")
    good = whole.to_pylist()
    payloads = [None, b"", *good, *junk, good[0] + good[1], good[1] + good[0] + good[0]]
    payloads += [p[: rng.randrange(len(p) + 1)] for p in good] + [rng.choice(junk or [b"\x01"]) + good[0]]
    want = []
    for payload in payloads:
        try:
            want.append(None if payload is None else _as_row(new.FromString(payload)))
        except (DecodeError, UnicodeDecodeError):
            want.append(None)
    expected = pa.array(want, to_arrow_type(CALL_EVENT))
    found = wire.read(pa.array(payloads, pa.binary()), "CallEvent")
    for payload, a, b in zip(payloads, found.to_pylist(), expected.to_pylist(), strict=True):
        assert repr(a) == repr(b) or a is None, payload
    # Groups aside, what the library reads is read.
    assert all(a is not None for a, b, p in zip(found.to_pylist(), want, payloads, strict=True) if b is not None and p in good)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**63 - 1), st.text(max_size=5), st.floats(width=32), st.booleans()), max_size=8))
def test_writer_agrees_with_the_library(values):
    new = _library("CallEvent")
    rows = [
        {"event_time": n, "event_id": text, "signaling_event": {"pdd": {"pdd": x}} if flag else None, "event_type": "signaling_event"}
        for n, text, x, flag in values
    ]
    payloads = wire.write(pa.array(rows, to_arrow_type(CALL_EVENT)), "CallEvent").to_pylist()
    for row, payload in zip(rows, payloads, strict=True):
        message = new.FromString(payload)
        assert message.SerializeToString() == payload
        assert (message.event_time, message.event_id) == (row["event_time"], row["event_id"])


def test_samples_beyond_the_field_are_sent_as_the_largest():
    rows = pa.array([{"samples": 2**32 + 5}, {"samples": 2**32 - 1}], to_arrow_type(AGGREGATION))
    read = wire.read(wire.write(rows, "MetricAggregation"), "MetricAggregation")
    assert [r["samples"] for r in read.to_pylist()] == [2**32 - 1] * 2



def test_schema_of_events():
    assert CALL_EVENT.simpleString() == (
        "struct<event_time:bigint,logged_event_time:bigint,event_id:string,route_id:string,event_type:string,"
        "signaling_event:struct<name:string,event_type:string,pdd:struct<pdd:float>,call_state:struct<state:string>>,"
        "event_dimensions:struct<country:string,direction:string,carrier:string,route:string>>"
    )
    assert len(ENUMS["Country"]) == 11 and len(ENUMS["CallState"]) == 10
    assert [f.name for f in message_schema("Histogram")] == [f"bin{i}" for i in range(1, 7)]
