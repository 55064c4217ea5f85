"""Scalar functions: windows, labels, ids, rounding, arrays, enums."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import SQL_CALLS, SQL_MS, call_events, sql_dimension_text, sql_id, sql_window_start
from signalstats.functions import (
    aligned_window,
    array_mean,
    array_variance,
    call_state_for,
    dimension_hash,
    enum_name,
    enum_number,
    event_window,
    generate_id,
    grouping_key,
    interval_label,
    interval_name,
    millis_to_timestamp,
    round_half_up,
    sd,
    series_id,
)
from signalstats.model import DIMENSIONS, ENUMS
from signalstats.session import ship_package
from signalstats.sources.tables import read_events

# Window lengths in minutes, one or more for every rule.
WINDOWS = {
    "0m": 0,
    "5m": 5,
    "7m": 7,
    "25m": 25,
    "60m": 60,
    "90m": 90,
    "2h": 120,
    "6h": 360,
    "1d": 1440,
    "25h": 1500,
    "2d": 2880,
}


def _register_window(name: str, minutes: int) -> None:
    start = sql_window_start(SQL_MS, minutes)

    @query(
        f"""SELECT event_id, {start} AS start_ms, {start} + {minutes * 60000} AS end_ms,
                   '{interval_name(minutes)}' AS "interval" FROM events""",
        name=f"event_window_{name}",
    )
    def run(spark, sf_dir):
        events = read_events(spark, sf_dir)
        return events.select("event_id", event_window(F.unix_millis("ts"), minutes).alias("w")).select("event_id", "w.*")


for _name, _minutes in WINDOWS.items():
    _register_window(_name, _minutes)


@query(f"SELECT event_id, {SQL_MS} - {SQL_MS} % 300000 AS start_ms, {SQL_MS} - {SQL_MS} % 300000 + 300000 AS end_ms FROM events")
def aligned_window_5m(spark, sf_dir):
    events = read_events(spark, sf_dir)
    return events.select("event_id", aligned_window(F.col("ts"), 5).alias("w")).select(
        "event_id", F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms")
    )


@query(f"SELECT event_id, make_timestamp({SQL_MS} * 1000) AS at FROM events", name="millis_to_timestamp")
def millis(spark, sf_dir):
    events = read_events(spark, sf_dir)
    at = millis_to_timestamp(F.unix_millis("ts"))
    # The oracle's timestamps carry no zone; drop ours the same way.
    return events.select("event_id", F.to_utc_timestamp(at, F.current_timezone()).cast("timestamp_ntz").alias("at"))


_LABEL = """CASE WHEN span < 3600000 THEN (span // 60000) || 'm' WHEN span < 86400000 THEN (span // 3600000) || 'h'
            ELSE (span // 86400000) || 'd' END"""


@query(
    f"""SELECT event_id, {_LABEL} AS label
        FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) * 1800000 AS span FROM events)""",
    name="interval_label",
)
def labels(spark, sf_dir):
    """Labels of windows of 0 to 49.5 hours."""
    events = read_events(spark, sf_dir)
    start = F.unix_millis("ts")
    end = start + F.get_json_object("props", "$.k").cast("bigint") * 1_800_000
    return events.select("event_id", interval_label(start, end).alias("label"))


@query(f"SELECT event_id, {sql_id('props')} AS id FROM events", name="generate_id")
def ids(spark, sf_dir):
    return read_events(spark, sf_dir).select("event_id", generate_id("props").alias("id"))


@query(
    f"""SELECT event_id, {sql_id(sql_dimension_text(list(DIMENSIONS)))} AS dimension_hash FROM {SQL_CALLS}""",
    name="dimension_hash",
)
def dimension_hashes(spark, sf_dir):
    events = call_events(spark, sf_dir).select("event_id", "event_dimensions.*")
    return events.select("event_id", dimension_hash({d: F.col(d) for d in DIMENSIONS}).alias("dimension_hash"))


_TWO_64 = "18446744073709551616::UHUGEINT"


def _sql_times(x: str, factor: int) -> str:
    """Product modulo 2**64."""
    return f"((({x}) * {factor}::UHUGEINT) % {_TWO_64})"


def _sql_rotl(x: str, bits: int) -> str:
    return f"((({x}) * {2**bits}::UHUGEINT) % {_TWO_64} + (({x}) // {2 ** (64 - bits)}::UHUGEINT))"


def _sql_shift_xor(x: str) -> str:
    return f"xor({x}, ({x}) // {2**33}::UHUGEINT)"


def sql_murmur3(source: str, columns: str) -> str:
    """``columns`` and the 128-bit hash as an id of the bytes (at most 15, as numbers)
    in the list ``b`` of the rows of ``source``."""
    c1, c2 = 0x87C37B91114253D5, 0x4CF5AD432745937F

    def word(first: int) -> str:
        return " + ".join(f"coalesce(b[{first + i}], 0)::UHUGEINT * {256 ** (i - 1)}::UHUGEINT" for i in range(1, 9))

    def step(select: str, rows: str) -> str:
        return f"SELECT *, {select} FROM ({rows})"

    rows = step(f"{word(0)} AS k1, {word(8)} AS k2, len(b)::UHUGEINT AS n", source)
    rows = step(f"{_sql_times('k1', c1)} AS m1, {_sql_times('k2', c2)} AS m2", rows)
    rows = step(
        f"xor({_sql_times(_sql_rotl('m1', 31), c2)}, n) AS u, xor({_sql_times(_sql_rotl('m2', 33), c1)}, n) AS v", rows
    )
    rows = step(f"(u + v) % {_TWO_64} AS s, (u + 2 * v) % {_TWO_64} AS t", rows)
    rows = step(f"{_sql_shift_xor('s')} AS s1, {_sql_shift_xor('t')} AS t1", rows)
    rows = step(f"{_sql_times('s1', 0xFF51AFD7ED558CCD)} AS s2, {_sql_times('t1', 0xFF51AFD7ED558CCD)} AS t2", rows)
    rows = step(f"{_sql_shift_xor('s2')} AS s3, {_sql_shift_xor('t2')} AS t3", rows)
    rows = step(f"{_sql_times('s3', 0xC4CEB9FE1A85EC53)} AS s4, {_sql_times('t3', 0xC4CEB9FE1A85EC53)} AS t4", rows)
    rows = step(f"{_sql_shift_xor('s4')} AS s5, {_sql_shift_xor('t4')} AS t5", rows)
    rows = step(f"(s5 + t5) % {_TWO_64} AS h1, (s5 + 2 * t5) % {_TWO_64} AS h2", rows)
    digits = " || ".join(
        f"printf('%02x', CAST(({h} // {256**i}::UHUGEINT) % 256 AS INTEGER))" for h in ("h1", "h2") for i in range(8)
    )
    return (
        f"SELECT {columns}, translate(rtrim(to_base64(unhex({digits})), '='), '+/', '-_') AS dimension_hash FROM ({rows})"
    )


def _sql_number(enum: str, column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{name}' THEN {n}" for n, name in ENUMS[enum].items()) + " END"


# Protobuf bytes of the set dimensions: tag and number, the route with its length.
_SQL_DIMENSION_BYTES = f"""
    SELECT DISTINCT country, direction, carrier, route,
           CASE WHEN country IS NULL THEN [] ELSE [8, {_sql_number("Country", "country")}] END
           || CASE WHEN direction IS NULL THEN [] ELSE [16, {_sql_number("Direction", "direction")}] END
           || CASE WHEN carrier IS NULL THEN [] ELSE [24, {_sql_number("Carrier", "carrier")}] END
           || CASE WHEN route IS NULL THEN []
                   ELSE [34, CAST(length(route) AS INTEGER)] || list_transform(string_split(route, ''), lambda c: ascii(c)) END AS b
    FROM {SQL_CALLS}"""


@query(sql_murmur3(_SQL_DIMENSION_BYTES, ", ".join(DIMENSIONS)))
def dimension_hash_murmur3(spark, sf_dir):
    """Ids equal to those of existing topics."""
    ship_package(spark)
    events = call_events(spark, sf_dir).select("event_dimensions.*").distinct()
    dims = {d: F.col(d) for d in DIMENSIONS}
    return events.select(*DIMENSIONS, dimension_hash(dims, "murmur3").alias("dimension_hash"))


@query(
    f"""SELECT event_id, {sql_id(f"{sql_id("event_type || '.' || signal_name || '.'")} || {sql_id("coalesce(route, '')")}")} AS grouping_key
        FROM {SQL_CALLS}""",
    name="grouping_key",
)
def grouping_keys(spark, sf_dir):
    events = call_events(spark, sf_dir)
    route = generate_id(F.coalesce("event_dimensions.route", F.lit("")))
    key = grouping_key(F.col("event_type"), F.col("signaling_event.name"), route)
    return events.select("event_id", key.alias("grouping_key"))


@query(
    f"""SELECT event_id, {sql_id("concat_ws('|', '0=' || event_type, '1=' || (" + SQL_MS + " // 300000 * 300000), '2=' || user_id)")} AS series
        FROM events""",
    name="series_id",
)
def series(spark, sf_dir):
    events = read_events(spark, sf_dir)
    window = event_window(F.unix_millis("ts"), 5)["start_ms"]
    return events.select("event_id", series_id(F.col("event_type"), window, F.col("user_id")).alias("series"))


@query(
    """SELECT event_id, floor(v * 100 + 0.5) / 100 AS rounded, floor(-v * 100 + 0.5) / 100 AS rounded_negative
       FROM (SELECT event_id, value / 8 AS v FROM events)""",
    name="round_half_up",
)
def rounding(spark, sf_dir):
    """Eighths of cents hit the ties that ``round`` treats differently."""
    events = read_events(spark, sf_dir).select("event_id", (F.col("value") / 8).alias("v"))
    return events.select(
        "event_id", round_half_up(F.col("v")).alias("rounded"), round_half_up(-F.col("v")).alias("rounded_negative")
    )


@query(
    """SELECT event_id, CASE WHEN len(l) = 0 THEN 0.0 ELSE list_sum(l) / len(l) END AS mean,
              CASE len(l) WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE round(list_var_samp(l), 6) END AS variance,
              CASE len(l) WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE round(sqrt(list_var_samp(l)), 6) END AS sd
       FROM (SELECT event_id, CASE event_type WHEN 'click' THEN CAST([] AS DOUBLE[]) WHEN 'view' THEN [value]
                                   ELSE [value, CAST(user_id AS DOUBLE), value * 3] END AS l FROM events)"""
)
def array_mean_variance(spark, sf_dir):
    """Arrays of no, one and three values; the NaN of one value is shown as NULL."""
    kind, value = F.col("event_type"), F.col("value")
    three = F.array(value, F.col("user_id").cast("double"), value * 3)
    values = F.when(kind == "click", F.array().cast("array<double>")).when(kind == "view", F.array(value)).otherwise(three)
    arrays = read_events(spark, sf_dir).select("event_id", values.alias("l"))
    variance = array_variance(F.col("l"))

    def shown(x):
        return F.when(~F.isnan(x), F.round(x, 6))

    return arrays.select(
        "event_id",
        array_mean(F.col("l")).alias("mean"),
        shown(variance).alias("variance"),
        shown(sd(variance)).alias("sd"),
    )


@query(
    f"""SELECT event_id, country, carrier, CASE carrier WHEN 'unknown_carrier' THEN 0 ELSE ascii(right(carrier, 1)) - 96 END AS carrier_number,
               state, CASE k WHEN 0 THEN 'initialized' WHEN 1 THEN 'answered' WHEN 2 THEN 'completed' WHEN 3 THEN 'failed' END AS short_state
        FROM (SELECT *, CAST(substr(route_id, 3) AS INTEGER) // 10 AS k FROM {SQL_CALLS})"""
)
def enum_decode(spark, sf_dir):
    """Names to numbers and numbers to names, with NULL for unknown ones."""
    events = call_events(spark, sf_dir)
    k = F.floor(F.substring("route_id", 3, 9).cast("int") / 10)
    country = enum_name("Country", enum_number("Country", F.col("event_dimensions.country")))
    return events.select(
        "event_id",
        country.alias("country"),
        "event_dimensions.carrier",
        enum_number("Carrier", F.col("event_dimensions.carrier")).alias("carrier_number"),
        "signaling_event.call_state.state",
        call_state_for(k).alias("short_state"),
    )
