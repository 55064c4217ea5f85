"""Queries in SQL text alone, with the rules of the package as SQL functions."""

from __future__ import annotations

from registry import query
from registry.aggregates import sql_window_stats
from registry.inputs import SQL_METRICS, SQL_MS, metric_table, sql_id, sql_round, sql_window_start
from signalstats.functions import sql
from signalstats.model import HISTOGRAM_SPLITS, SKETCH_K
from signalstats.sources.tables import read_events

_LENGTHS = (0, 5, 45, 60, 90, 120, 1440, 2880)


def _sql_label(minutes: int) -> str:
    if minutes < 60:
        return f"{minutes}m"
    return f"{minutes // 60}h" if minutes < 1440 else f"{minutes // 1440}d"


@query(
    " UNION ALL ".join(
        f"""SELECT event_id, {n} AS minutes, {sql_window_start(SQL_MS, n)} AS start_ms,
                   {sql_window_start(SQL_MS, n)} + {n * 60000} AS end_ms, '{_sql_label(n)}' AS label,
                   '{_sql_label(n)}' AS label_of_bounds FROM events"""
        for n in _LENGTHS
    )
)
def sql_event_windows(spark, sf_dir):
    """Windows of every event at several lengths."""
    sql.register(spark)
    read_events(spark, sf_dir).createOrReplaceTempView("sql_text_events")
    return spark.sql(f"""
        SELECT event_id, minutes, w.start_ms, w.end_ms, w.`interval` AS label,
               interval_label(w.start_ms, w.end_ms) AS label_of_bounds
        FROM (SELECT event_id, minutes, event_window(unix_millis(ts), minutes) AS w
              FROM sql_text_events LATERAL VIEW explode(array{_LENGTHS}) AS minutes)""")


@query(
    f"""SELECT event_id, {sql_round("value")} AS rounded, {sql_round("-value / 3")} AS third,
               {sql_id("event_type || '|' || event_id")} AS id FROM events"""
)
def sql_scalars(spark, sf_dir):
    """Rounded values and ids."""
    sql.register(spark)
    read_events(spark, sf_dir).createOrReplaceTempView("sql_text_events")
    return spark.sql("""
        SELECT event_id, round_half_up(value) AS rounded, round_half_up(-value / 3) AS third,
               generate_id(CAST(concat(event_type, '|', event_id) AS BINARY)) AS id FROM sql_text_events""")


_EDGES = [float(x) for x in HISTOGRAM_SPLITS]
_BOUNDS = zip([None, *_EDGES], [*_EDGES, None], strict=True)
_BINS = ", ".join(
    "CAST(count_if(" + " AND ".join([*([f"value >= {a}D"] if a is not None else []), *([f"value < {b}D"] if b is not None else [])])
    + f") AS DOUBLE) AS bin{i}"
    for i, (a, b) in enumerate(_BOUNDS, 1)
)


@query(sql_window_stats(SQL_METRICS, 60, ["route"]))
def sql_window_statistics(spark, sf_dir):
    """The whole aggregate rows of every metric, hour and route."""
    sql.register(spark)
    metric_table(spark, sf_dir).createOrReplaceTempView("sql_text_metrics")
    return spark.sql(f"""
        WITH windowed AS (
            SELECT metric, route, value, event_window(event_time, 60) AS w FROM sql_text_metrics
        ), merged AS (
            SELECT metric, route, w, count(value) AS samples, min(value) AS min, max(value) AS max,
                   round(avg(value), 9) AS mean, coalesce(var_samp(value), 0D) AS variance,
                   kll_sketch_agg_double(value, {SKETCH_K}) AS sketch, {_BINS}
            FROM windowed GROUP BY metric, route, w
        ), read AS (SELECT *, sketch_percentiles(sketch) AS q FROM merged)
        SELECT metric, w.start_ms AS window_start, w.end_ms AS window_end, w.`interval` AS window_interval, route,
               generate_id(CAST(concat('route=', route) AS BINARY)) AS dimension_hash, samples,
               round_half_up(min) AS min, round_half_up(q.p25) AS p25, round_half_up(q.median) AS median,
               round_half_up(q.p75) AS p75, round_half_up(q.p90) AS p90, round_half_up(q.p95) AS p95,
               round_half_up(q.p99) AS p99, round_half_up(max) AS max, round_half_up(mean) AS mean,
               round_half_up(round(sqrt(variance), 9)) AS sd, round_half_up(round(variance, 9)) AS variance,
               bin1, bin2, bin3, bin4, bin5, bin6
        FROM read""")
