from signalstats.functions.enums import call_state_for, enum_name, enum_number
from signalstats.functions.ids import dimension_hash, generate_id, grouping_key, series_id
from signalstats.functions.numeric import array_mean, array_variance, round_half_up, sd
from signalstats.functions.windows import (
    aligned_window,
    event_window,
    event_window_start,
    interval_label,
    interval_name,
    millis_to_timestamp,
    window_end,
)

__all__ = [
    "aligned_window",
    "array_mean",
    "array_variance",
    "call_state_for",
    "dimension_hash",
    "enum_name",
    "enum_number",
    "event_window",
    "event_window_start",
    "generate_id",
    "grouping_key",
    "interval_label",
    "interval_name",
    "millis_to_timestamp",
    "round_half_up",
    "sd",
    "series_id",
    "window_end",
]
