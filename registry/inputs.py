"""The ``events`` table seen as metric rows, as call events and as payloads.

Each view comes twice: as a DataFrame and as the SQL text the oracles use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstats.functions import enum_name
from signalstats.model import CALL_EVENT, ENUMS, PERCENTILES
from signalstats.operators.decode import encode_json
from signalstats.operators.stats import STATS
from signalstats.sources.tables import read_events

# -- metric rows ------------------------------------------------------------


def as_metric_rows(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("metric"),
        F.unix_millis("ts").alias("event_time"),
        F.get_json_object("props", "$.k").alias("route"),
        "value",
    )


def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric, event_time, route, value."""
    return as_metric_rows(read_events(spark, sf_dir))


SQL_MS = "(epoch_us(ts) // 1000)"
SQL_METRICS = f"""(
    SELECT event_type AS metric, {SQL_MS} AS event_time,
           json_extract_string(props, '$.k') AS route, value
    FROM events)"""

# -- call events ------------------------------------------------------------


def as_call_events(events: DataFrame) -> DataFrame:
    """Call events with every kind of signal, unset fields and unknown types."""
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    kind, k = F.col("event_type"), F.col("k")
    is_pdd = kind.isin("click", "view")
    signal = F.struct(
        kind.alias("name"),
        F.when(is_pdd, "pdd").when(kind == "purchase", "call_state").when(kind == "signup", "unknown_event_type").alias("event_type"),
        F.when(is_pdd, F.struct(F.col("value").cast("float").alias("pdd"))).alias("pdd"),
        F.when(kind == "purchase", F.struct(enum_name("CallState", F.floor(k / 10)).alias("state"))).alias("call_state"),
    )
    dims = F.struct(
        enum_name("Country", F.floor(k / 10)).alias("country"),
        F.when(kind == "click", "inbound").when(kind == "view", "outbound").alias("direction"),
        enum_name("Carrier", F.floor(k / 20)).alias("carrier"),
        F.when(k >= 50, F.concat(F.lit("RI"), k.cast("string"))).alias("route"),
    )
    return events.select(
        F.unix_millis("ts").alias("event_time"),
        F.unix_millis("ts").alias("logged_event_time"),
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("RI"), k.cast("string")).alias("route_id"),
        F.when(kind == "error", "unknown_call_event").otherwise("signaling_event").alias("event_type"),
        signal.alias("signaling_event"),
        dims.alias("event_dimensions"),
    )


def call_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_call_events(read_events(spark, sf_dir))


def event_struct() -> Column:
    return F.struct(*CALL_EVENT.names)


def as_payloads(events: DataFrame) -> DataFrame:
    """``value BINARY`` JSON payloads; those of ``signup`` events lose their last byte."""
    # One-element explodes keep the encoder from being copied into filters.
    text = F.explode(F.array(encode_json(event_struct())))
    cut = F.when(F.col("signaling_event.name") == "signup", F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return as_call_events(events).select(text.alias("text"), "signaling_event").select(cut.cast("binary").alias("value"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_payloads(read_events(spark, sf_dir))


def sql_enum(enum: str, number: str) -> str:
    cases = " ".join(f"WHEN {n} THEN '{name}'" for n, name in ENUMS[enum].items())
    return f"CASE CAST({number} AS INTEGER) {cases} END"


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
SQL_CALLS = f"""(
    SELECT {SQL_MS} AS event_time, {SQL_MS} AS logged_event_time,
           'E' || event_id AS event_id, 'RI' || {_K} AS route_id,
           CASE WHEN event_type = 'error' THEN 'unknown_call_event' ELSE 'signaling_event' END AS event_type,
           event_type AS signal_name,
           CASE WHEN event_type IN ('click', 'view') THEN 'pdd' WHEN event_type = 'purchase' THEN 'call_state'
                WHEN event_type = 'signup' THEN 'unknown_event_type' END AS signal_type,
           CASE WHEN event_type IN ('click', 'view') THEN CAST(value AS FLOAT) END AS pdd,
           CASE WHEN event_type = 'purchase' THEN {sql_enum("CallState", f"{_K} // 10")} END AS state,
           {sql_enum("Country", f"{_K} // 10")} AS country,
           CASE event_type WHEN 'click' THEN 'inbound' WHEN 'view' THEN 'outbound' END AS direction,
           {sql_enum("Carrier", f"{_K} // 20")} AS carrier,
           CASE WHEN {_K} >= 50 THEN 'RI' || {_K} END AS route
    FROM events)"""

SQL_PDD = f"""(
    SELECT signal_type AS metric, event_time, country, direction, carrier, route,
           CAST(pdd AS DOUBLE) AS value
    FROM {SQL_CALLS} WHERE event_type = 'signaling_event' AND signal_type = 'pdd')"""

# -- SQL of the statistics --------------------------------------------------


def sql_round(x: str) -> str:
    return f"floor(({x}) * 100 + 0.5) / 100"


def sql_quantile(p: float, value: str = "value") -> str:
    n = f"count({value})"
    return f"list({value} ORDER BY {value})[CAST(least(floor({p} * {n}), {n} - 1) AS INTEGER) + 1]"


def sql_bins(value: str = "value") -> list[str]:
    edges = ["< -2", ">= -2 AND {v} < -1", ">= -1 AND {v} < 0", ">= 0 AND {v} < 1", ">= 1 AND {v} < 2", ">= 2"]
    return [
        f"CAST(count(*) FILTER (WHERE {value} {edge.format(v=value)}) AS DOUBLE) AS bin{i}"
        for i, edge in enumerate(edges, 1)
    ]


def sql_stats(value: str = "value") -> str:
    """Select list of the flat statistics of a group."""
    variance = f"coalesce(var_samp({value}), 0.0)"
    exact = {
        "min": f"min({value})",
        "max": f"max({value})",
        # Nine decimals first: the last bits of a sum depend on its order.
        "mean": f"round(avg({value}), 9)",
        "variance": f"round({variance}, 9)",
        "sd": f"round(sqrt({variance}), 9)",
        **{name: sql_quantile(p, value) for name, p in PERCENTILES.items()},
    }
    columns = [f"CAST(count({value}) AS BIGINT) AS samples"]
    columns += [f"{sql_round(exact[name])} AS {name}" for name in STATS]
    return ",\n           ".join(columns + sql_bins(value))


def sql_id(text: str) -> str:
    """md5, base64url, without padding."""
    return f"translate(rtrim(to_base64(unhex(md5({text}))), '='), '+/', '-_')"


def sql_dimension_text(names: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"'{name}=' || {name}" for name in names) + ")"


def sql_window_start(ms: str, minutes: int) -> str:
    """The window rules as SQL arithmetic."""
    hour = f"({ms} - {ms} % 3600000)"
    hours = minutes // 60
    if minutes == 0 or hours == 1:
        return hour
    if hours == 0:
        return f"({hour} + {minutes * 60000} * (({ms} % 3600000) // {minutes * 60000}))"
    start = f"({hour} - {hours * 3600000})"
    return start if hours < 24 else f"({start} - {start} % 86400000)"
