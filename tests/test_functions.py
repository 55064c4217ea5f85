import base64
import datetime as dt
import math

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalstats.functions import (
    aligned_window,
    array_mean,
    array_variance,
    call_state_for,
    dimension_hash,
    enum_name,
    enum_number,
    event_window,
    event_window_start,
    generate_id,
    grouping_key,
    interval_label,
    round_half_up,
    series_id,
)
from signalstats.functions.ids import dimensions_bytes, murmur3_128
from signalstats.model import ENUMS
from signalstats.sources import protobuf

HOUR = 3_600_000


def ms(text):
    return int(dt.datetime.fromisoformat(text + "+00:00").timestamp() * 1000)


@pytest.mark.parametrize(
    "at, minutes, start, end, label",
    [
        ("2018-06-02T19:04:44.972", 5, "2018-06-02T19:00:00", "2018-06-02T19:05:00", "5m"),
        ("2018-06-02T19:59:59.999", 25, "2018-06-02T19:50:00", "2018-06-02T20:15:00", "25m"),
        ("2018-06-02T19:04:44.972", 0, "2018-06-02T19:00:00", "2018-06-02T19:00:00", "0m"),
        ("2018-06-02T19:04:44.972", 60, "2018-06-02T19:00:00", "2018-06-02T20:00:00", "1h"),
        ("2018-06-02T19:04:44.972", 90, "2018-06-02T19:00:00", "2018-06-02T20:30:00", "1h"),
        ("2018-06-02T19:04:44.972", 120, "2018-06-02T17:00:00", "2018-06-02T19:00:00", "2h"),
        ("2018-06-02T19:04:44.972", 1440, "2018-06-01T00:00:00", "2018-06-02T00:00:00", "1d"),
        ("2018-06-02T19:04:44.972", 2880, "2018-05-31T00:00:00", "2018-06-02T00:00:00", "2d"),
        ("1969-12-31T23:58:00.000", 5, "1969-12-31T23:55:00", "1970-01-01T00:00:00", "5m"),
    ],
)
def test_event_window(spark, at, minutes, start, end, label):
    w = spark.range(1).select(event_window(F.lit(ms(at)), minutes).alias("w")).head().w
    assert (w.start_ms, w.end_ms, w.interval) == (ms(start), ms(end), label)
    shown = spark.range(1).select(interval_label(F.lit(w.start_ms), F.lit(w.end_ms))).head()[0]
    assert shown == label


def test_negative_window_length_is_refused():
    with pytest.raises(ValueError):
        event_window_start(None, -1)


def test_windows_ignore_the_session_time_zone(spark, conf):
    at = F.lit(ms("2018-03-25T01:30:00"))
    before = spark.range(1).select(event_window(at, 360).alias("w")).head().w
    conf("spark.sql.session.timeZone", "Asia/Kolkata")
    assert spark.range(1).select(event_window(at, 360).alias("w")).head().w == before


def test_aligned_window_holds_its_event(spark):
    row = spark.range(1).select(F.timestamp_millis(F.lit(ms("2018-06-02T19:04:44"))).alias("t"))
    w = row.select(aligned_window(F.col("t"), 5).alias("w")).select(F.unix_millis("w.start"), F.unix_millis("w.end")).head()
    assert tuple(w) == (ms("2018-06-02T19:00:00"), ms("2018-06-02T19:05:00"))


ROUNDED = [
    (-0.125, -0.12),
    (0.125, 0.13),
    (1.005, 1.0),
    (2.675, 2.68),
    (0.0, 0.0),
    (float("nan"), 0.0),
    (0.0049999999999999996, 0.0),
    (-7.0, -7.0),
    (1e15 + 0.3, 1e15 + 0.3),
    (float("inf"), float("inf")),
    (1e17, 1e17),
    (-1e18, -1e18),
]


def test_round_half_up(spark):
    rows = spark.createDataFrame([(float(v),) for v, _ in ROUNDED], "v double").select("v", round_half_up(F.col("v")).alias("r"))
    found = {repr(r.v): r.r for r in rows.collect()}
    for value, expected in ROUNDED:
        assert found[repr(float(value))] == pytest.approx(expected, rel=1e-15), value


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=200, max_size=200))
def test_round_half_up_is_floor_of_half_more(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_half_up(F.col("v")).alias("r"))
    for r in rows.collect():
        scaled = r.v * 100.0
        expected = math.floor(scaled) + (1 if scaled - math.floor(scaled) >= 0.5 else 0)
        assert r.r == expected / 100.0


def test_array_statistics(spark):
    rows = spark.createDataFrame([([],), ([4.0],), ([1e9 + 1, 1e9 + 2, 1e9 + 3],)], "l array<double>")
    found = rows.select(array_mean(F.col("l")), array_variance(F.col("l"))).collect()
    assert tuple(found[0]) == (0.0, 0.0)
    assert found[1][0] == 4.0 and math.isnan(found[1][1])
    assert tuple(found[2]) == (1e9 + 2, 1.0)


def test_enums_round_trip(spark):
    for enum, names in ENUMS.items():
        rows = spark.createDataFrame([(n,) for n in [*names, 99]], "n int")
        found = rows.select("n", enum_name(enum, F.col("n")).alias("name")).withColumn("back", enum_number(enum, F.col("name")))
        for r in found.collect():
            assert r.name == names.get(r.n)
            assert r.back == (r.n if r.n in names else None)


def test_short_call_states(spark):
    rows = spark.range(5).select(call_state_for(F.col("id"))).collect()
    assert [r[0] for r in rows] == ["initialized", "answered", "completed", "failed", None]


def test_ids_are_short_and_url_safe(spark):
    found = spark.range(50).select(generate_id(F.col("id").cast("string")).alias("i")).collect()
    assert all(len(r.i) == 22 and set(r.i) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_") for r in found)
    with pytest.raises(ValueError):
        generate_id("id", "crc32")


def test_dimension_hash_tells_unset_from_empty_and_split_values(spark):
    rows = spark.createDataFrame([("a", "b"), ("a|b=", None), (None, "b"), ("", "b"), ("a\\", "b")], "x string, y string")
    found = rows.select(dimension_hash({"x": F.col("x"), "y": F.col("y")}).alias("h")).collect()
    assert len({r.h for r in found}) == 5
    text = spark.createDataFrame([("1|y=2", None), ("1", "2")], "x string, y string")
    assert text.select(dimension_hash({"x": F.col("x"), "y": F.col("y")})).distinct().count() == 2


def test_grouping_key_and_series_id(spark):
    row = spark.range(1).select(
        grouping_key(F.lit("calls"), F.lit("pdd"), F.lit("h")).alias("k"),
        generate_id(F.concat(generate_id(F.lit("calls.pdd.")), F.lit("h"))).alias("same"),
        series_id(F.lit("pdd"), F.lit(1)).alias("s"),
    ).head()
    assert row.k == row.same and len(row.s) == 22


@pytest.mark.parametrize("length", [0, 1, 7, 8, 9, 15, 16, 17, 31, 32, 33, 100])
def test_murmur3_equals_the_jvm_library(spark, length):
    data = bytes((i * 37 + 200) % 256 for i in range(length))
    hashing = spark._jvm.com.google.common.hash.Hashing.murmur3_128()
    batch = pa.array([b"x", data, None, data + b"y" * 40, data], pa.binary()).slice(1)
    found = [bytes(row) for row in murmur3_128(batch)]
    assert found[0] == found[3] == bytes(hashing.hashBytes(bytearray(data)).asBytes())
    assert found[2] == bytes(hashing.hashBytes(bytearray(data + b"y" * 40)).asBytes())


def test_murmur3_column(spark):
    row = spark.range(1).select(generate_id(F.lit("foo"), "murmur3").alias("i")).head()
    digest = spark._jvm.com.google.common.hash.Hashing.murmur3_128().hashBytes(bytearray(b"foo")).asBytes()
    assert row.i == base64.urlsafe_b64encode(bytes(digest)).decode().rstrip("=")


def test_dimension_bytes_equal_the_message(spark):
    dims = ["country", "direction", "carrier", "route"]
    data = [
        ("us", "outbound", "telco_a", "RI1"),
        (None, None, None, None),
        ("unknown_country", None, "telco_e", ""),
        ("br", "inbound", None, "r" * 200),
        ("br", "inbound", None, "é" * 9000),
    ]
    rows = spark.createDataFrame(data, ", ".join(f"{d} string" for d in dims))
    built = dimensions_bytes({d: F.col(d) for d in dims})
    both = rows.select(built.alias("a"), protobuf.to_bytes(F.struct(*dims), "Dimensions").alias("b")).collect()
    assert all(bytes(r.a) == bytes(r.b) for r in both)
