"""Data model: enumerations, message layout, Spark schemas and job parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names and numbers of the enumerations of the event protocol.
# ---------------------------------------------------------------------------
ENUMS: dict[str, dict[int, str]] = {
    "CallState": {
        0: "unknown_call_state",
        1: "initialized",
        2: "ringing",
        3: "answered",
        4: "progress",
        5: "completed",
        6: "failed",
        7: "busy",
        8: "noanswer",
        9: "canceled",
    },
    "SignalingEventType": {0: "unknown_event_type", 1: "pdd", 2: "call_state"},
    "CallEventType": {0: "unknown_call_event", 1: "signaling_event"},
    "Country": {
        0: "unknown_country",
        1: "br",
        2: "ca",
        3: "cl",
        4: "fr",
        5: "gb",
        6: "in",
        7: "it",
        8: "mx",
        9: "nl",
        10: "us",
    },
    "Direction": {0: "unknown_direction", 1: "inbound", 2: "outbound"},
    "Carrier": {
        0: "unknown_carrier",
        1: "telco_a",
        2: "telco_b",
        3: "telco_c",
        4: "telco_d",
        5: "telco_e",
    },
}

# A second, shorter numbering of call states that differs from
# ENUMS["CallState"] and is kept as it is.
CALL_STATE_ORDINALS: dict[int, str] = {
    0: "initialized",
    1: "answered",
    2: "completed",
    3: "failed",
}

# ---------------------------------------------------------------------------
# Wire layout of the messages, {field: (number, type)}. A type is
# a protobuf scalar, the name of an enumeration or the name of a message.
# ---------------------------------------------------------------------------
MESSAGES: dict[str, dict[str, tuple[int, str]]] = {
    "PddEvent": {"pdd": (1, "float")},
    "CallStateEvent": {"state": (1, "CallState")},
    "SignalingEvent": {
        "name": (1, "string"),
        "event_type": (2, "SignalingEventType"),
        "pdd": (3, "PddEvent"),
        "call_state": (4, "CallStateEvent"),
    },
    "Dimensions": {
        "country": (1, "Country"),
        "direction": (2, "Direction"),
        "carrier": (3, "Carrier"),
        "route": (4, "string"),
    },
    "CallEvent": {
        "event_time": (1, "uint64"),
        "logged_event_time": (2, "uint64"),
        "event_id": (3, "string"),
        "route_id": (4, "string"),
        "event_type": (5, "CallEventType"),
        "signaling_event": (6, "SignalingEvent"),
        "event_dimensions": (7, "Dimensions"),
    },
    "Stats": {
        "min": (1, "double"),
        "p25": (2, "double"),
        "median": (3, "double"),
        "p75": (4, "double"),
        "p90": (5, "double"),
        "p95": (6, "double"),
        "p99": (7, "double"),
        "max": (8, "double"),
        "mean": (9, "double"),
        "sd": (10, "double"),
        "variance": (11, "double"),
    },
    "Histogram": {f"bin{i}": (i, "double") for i in range(1, 7)},
    "MetricAggregation": {
        "metric": (1, "string"),
        "window_start": (2, "uint64"),
        "window_end": (3, "uint64"),
        "window_interval": (4, "string"),
        "samples": (5, "uint32"),
        "stats": (6, "Stats"),
        "histogram": (7, "Histogram"),
        "dimensions": (8, "Dimensions"),
        "dimension_hash": (10, "string"),
    },
}

_SCALARS: dict[str, T.DataType] = {
    "string": T.StringType(),
    "uint64": T.LongType(),
    "uint32": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def message_schema(message: str) -> T.StructType:
    """Spark row type of a message: enums by name, unset fields NULL."""

    def of(kind: str) -> T.DataType:
        if kind in MESSAGES:
            return message_schema(kind)
        return T.StringType() if kind in ENUMS else _SCALARS[kind]

    return T.StructType([T.StructField(name, of(kind)) for name, (_, kind) in MESSAGES[message].items()])


CALL_EVENT = message_schema("CallEvent")
AGGREGATION = message_schema("MetricAggregation")
DIMENSIONS = tuple(MESSAGES["Dimensions"])

# Percentiles and histogram edges of an aggregate row (fixed values).
PERCENTILES: dict[str, float] = {
    "p25": 0.25,
    "median": 0.50,
    "p75": 0.75,
    "p90": 0.90,
    "p95": 0.95,
    "p99": 0.99,
}
HISTOGRAM_SPLITS: tuple[float, ...] = (-2.0, -1.0, 0.0, 1.0, 2.0)

# KLL at k=1024 is exact up to 1,024 values per key and has a normalised rank
# error of 0.27 % beyond.
SKETCH_K = 1024

# Column metadata that holds the length of the windows of stored rows.
WINDOW_MINUTES = "window_minutes"


@dataclass(frozen=True)
class TopicConfig:
    """A Kafka topic with its reader or writer options."""

    topic: str
    subscription_type: str = "subscribe"
    conf: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class JobConfig:
    """Parameters of one aggregation job.

    ``payload_format`` and ``output_format`` are ``json`` or ``protobuf``,
    ``id_algorithm`` is ``md5`` or ``murmur3``. With ``final_rows`` a job in update
    mode also writes each key once more when its window is closed, which it is when the
    watermark has passed its ``start`` or its ``end``. Unless ``closes`` says which, jobs
    that write rows of closed windows wait for the end, and others drop late rows from the
    start on. Payloads that do
    not decode go to the table ``reject_path``, progress reports with the counts of
    all left-out events to ``progress_path``.
    """

    app_name: str = "signal-statistics"
    query_name: str = "signal.statistics"
    trigger_interval: str = "10 seconds"
    output_mode: str = "update"
    checkpoint_path: str | None = None
    window_minutes: int = 5
    watermark_minutes: int = 10
    metric: str = "pdd"
    payload_format: str = "json"
    output_format: str = "json"
    id_algorithm: str = "md5"
    final_rows: bool = False
    closes: str | None = None
    reject_path: str | None = None
    progress_path: str | None = None
    spark_conf: dict[str, str] = field(default_factory=dict)
    source: TopicConfig | None = None
    sink: TopicConfig | None = None

    @property
    def closing(self) -> str:
        return self.closes or ("end" if self.final_rows or self.output_mode == "append" else "start")

    @classmethod
    def from_mapping(cls, settings: Mapping) -> JobConfig:
        """From a parsed configuration file; keys that are not set keep their defaults.

        Fixed values: the names of the first keys, up to ``core``.
        """
        names = {
            "appName": "app_name",
            "triggerInterval": "trigger_interval",
            "outputMode": "output_mode",
            "checkpointPath": "checkpoint_path",
            "windowInterval": "window_minutes",
            "watermarkInterval": "watermark_minutes",
            "core": "spark_conf",
            "payloadFormat": "payload_format",
            "outputFormat": "output_format",
            "idAlgorithm": "id_algorithm",
            "finalRows": "final_rows",
            "closes": "closes",
            "rejectPath": "reject_path",
            "progressPath": "progress_path",
        }
        topics = {"callEventsTopic": "source", "aggregationsTopic": "sink"}
        unknown = set(settings) - set(names) - set(topics)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        found = {names[key]: value for key, value in settings.items() if key in names}
        for key, name in topics.items():
            if key in settings:
                topic = settings[key]
                found[name] = TopicConfig(topic["topic"], topic.get("subscriptionType", "subscribe"), topic.get("conf", {}))
        return cls(**found)
