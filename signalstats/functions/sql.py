"""The rules of this package as functions of SQL text.

They are temporary SQL functions: Spark inlines their bodies into the query, so filters on
them and columns they do not need are treated as if written out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from signalstats.functions.windows import DAY_MS, HOUR_MS, MINUTE_MS
from signalstats.model import PERCENTILES
from signalstats.operators.quantiles import rank_above

_PERCENTILES = ", ".join(f"{rank_above(p)!r}D" for p in PERCENTILES.values())
_NAMES = ", ".join(f"'{name}', q[{i}]" for i, name in enumerate(PERCENTILES))

#: Parameters, result and body of every function, in the order in which they build on each other.
FUNCTIONS = {
    "event_window_start": (
        "ms BIGINT, minutes INT",
        "BIGINT",
        f"""CASE WHEN minutes < 0 THEN CAST(raise_error('window length must not be negative') AS BIGINT)
                 WHEN minutes = 0 OR minutes DIV 60 = 1 THEN ms - pmod(ms, {HOUR_MS})
                 WHEN minutes < 60 THEN ms - pmod(pmod(ms, {HOUR_MS}), minutes * {MINUTE_MS}L)
                 WHEN minutes < 1440 THEN ms - pmod(ms, {HOUR_MS}) - minutes DIV 60 * {HOUR_MS}
                 ELSE ms - pmod(ms, {HOUR_MS}) - minutes DIV 60 * {HOUR_MS}
                      - pmod(ms - pmod(ms, {HOUR_MS}) - minutes DIV 60 * {HOUR_MS}, {DAY_MS}) END""",
    ),
    "interval_label": (
        "start_ms BIGINT, end_ms BIGINT",
        "STRING",
        f"""CASE WHEN end_ms - start_ms < {HOUR_MS} THEN concat(floor((end_ms - start_ms) / {MINUTE_MS}), 'm')
                 WHEN end_ms - start_ms < {DAY_MS} THEN concat(floor((end_ms - start_ms) / {HOUR_MS}), 'h')
                 ELSE concat(floor((end_ms - start_ms) / {DAY_MS}), 'd') END""",
    ),
    "event_window": (
        "ms BIGINT, minutes INT",
        "STRUCT<start_ms: BIGINT, end_ms: BIGINT, `interval`: STRING>",
        f"""named_struct('start_ms', event_window_start(ms, minutes),
                         'end_ms', event_window_start(ms, minutes) + minutes * {MINUTE_MS}L,
                         'interval', interval_label(0L, minutes * {MINUTE_MS}L))""",
    ),
    "round_half_up": (
        "x DOUBLE",
        "DOUBLE",
        f"""CASE WHEN x IS NULL THEN NULL WHEN isnan(x) THEN 0D WHEN abs(x) * 100 >= {2**52} THEN x
                 WHEN x * 100 - floor(x * 100) >= 0.5D THEN (floor(x * 100) + 1) / 100D
                 ELSE floor(x * 100) / 100D END""",
    ),
    "generate_id": (
        "bytes BINARY",
        "STRING",
        "translate(rtrim('=', base64(unhex(md5(bytes)))), '+/', '-_')",
    ),
    "sketch_percentiles": (
        "sketch BINARY",
        "STRUCT<" + ", ".join(f"{name}: DOUBLE" for name in PERCENTILES) + ">",
        "CASE WHEN kll_sketch_get_n_double(sketch) > 0 THEN transform(array(kll_sketch_get_quantile_double("
        f"sketch, array({_PERCENTILES}))), q -> named_struct({_NAMES}))[0] END",
    ),
}


def register(spark: SparkSession) -> None:
    """Make :data:`FUNCTIONS` known to the session, replacing earlier ones."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
