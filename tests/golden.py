"""The end-to-end scenario and its expected results."""

import json
import os

# event_time, logged_event_time, event_id, post-dial delay
PDD_EVENTS = [
    (1527966284972, 1527966304972, "PDD1", 2.8),
    (1527966285972, 1527966285982, "PDD2", 1.7),
    (1527966285972, 1527966285982, "PDD2a", 2.2),
    (1527966285972, 1527966285982, "PDD2b", 0.7),
    (1527966286972, 1527966287072, "PDD3", 4.8),
    (1527966287972, 1527966288072, "PDD4", 0.8),
    (1527966288972, 1527966289972, "PDD5", 3.8),
    (1527966289972, 1527966290972, "PDD6", 2.2),
    (1527966290972, 1527966290972, "PDD7", 2.7),
    (1527966291972, 1527966291972, "PDD8", 10.1),
    (1527966292972, 1527966292972, "PDD9", 1.1),
    (1527966293972, 1527966293972, "PDD10", 2.1),
    (1527966353972, 1527966353972, "PDD11", 1.1),
    (1527966354972, 1527966354972, "PDD12", 1.3),
    (1527966414972, 1527966414972, "PDD13", 1.8),
    (1527966474972, 1527966474972, "PDD14", 3.9),
    (1527966534972, 1527966534972, "PDD15", 1.9),
    (1527966594972, 1527966594972, "PDD16", 2.9),
    (1527966654972, 1527966654972, "PDD17", 1.9),
    (1527966654972, 1527966654972, "PDD17", 1.9),
    (1527967254972, 1527967254972, "PDD18-push-watermark", 5.9),
    (1527968454972, 1527968454972, "PDD19-force-watermark", 10.9),
]

# event_time, logged_event_time, name, state
CALL_STATE_EVENTS = [
    (1527966284972, 1527966304972, "state_change", "initialized"),
    (1527966285972, 1527966286972, "state_change", "ringing"),
    (1527966287972, 1527966288972, "state_change", "answered"),
    (1527966288972, 1527966289972, "progress", "progress"),
    (1527966289972, 1527966309972, "progress", "progress"),
    (1527966294972, 1527966294972, "state_change", "completed"),
]

STAT_NAMES = ["min", "p25", "median", "p75", "p90", "p95", "p99", "max", "mean", "sd", "variance"]

# window_start, samples, statistics, bins
FINAL_WINDOWS = [
    (1527966000000, 12, [0.7, 1.7, 2.2, 3.8, 4.8, 10.1, 10.1, 10.1, 2.92, 2.56, 6.53], [0, 0, 0, 2, 2, 8]),
    (1527966300000, 6, [1.1, 1.3, 1.9, 2.9, 3.9, 3.9, 3.9, 3.9, 2.15, 1.06, 1.13], [0, 0, 0, 0, 4, 2]),
    (1527966600000, 2, [1.9] * 9 + [0.0, 0.0], [0, 0, 0, 0, 2, 0]),
    (1527967200000, 1, [5.9] * 9 + [0.0, 0.0], [0, 0, 0, 0, 0, 1]),
    (1527968400000, 1, [10.9] * 9 + [0.0, 0.0], [0, 0, 0, 0, 0, 1]),
]

# Average p99 over the rows of an update-mode run in triggers of at most ten events.
GOLDEN_AVG_P99 = 7.13


def pdd_event(time, logged, event_id, pdd):
    return {
        "event_time": time,
        "logged_event_time": logged,
        "event_id": event_id,
        "route_id": "RI1",
        "event_type": "signaling_event",
        "signaling_event": {"name": "preflight", "event_type": "pdd", "pdd": {"pdd": pdd}},
        "event_dimensions": {"country": "us", "direction": "outbound", "carrier": "telco_a", "route": "RI1"},
    }


def call_state_event(time, logged, name, state):
    return {
        "event_time": time,
        "logged_event_time": logged,
        "event_id": "CE1234",
        "event_type": "signaling_event",
        "signaling_event": {"name": name, "event_type": "call_state", "call_state": {"state": state}},
        "event_dimensions": {"country": "us", "direction": "outbound", "carrier": "telco_a"},
    }


def pdd_events():
    return [pdd_event(*e) for e in PDD_EVENTS]


def call_state_events():
    return [call_state_event(*e) for e in CALL_STATE_EVENTS]


def write_triggers(folder, chunks):
    """One file of JSON lines per chunk, in order of modification time."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, chunk in enumerate(chunks):
        path = folder / f"part-{i:03d}.json"
        path.write_text("".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in chunk))
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    return str(folder)


def in_tens(events):
    return [events[i : i + 10] for i in range(0, len(events), 10)]
