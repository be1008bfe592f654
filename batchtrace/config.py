"""Fixed vocabulary and tunable thresholds.

The values in the "fixed values" block must equal the source system's for
results to match: topic names, action names, status labels and DLQ reasons.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path

# --- fixed values (must match the source system) ---------------------------
# Input topics, routed topics and the dead-letter topic.
KITCHEN_TOPIC = "kitchen_station_events"
DISPATCH_TOPIC = "dispatch_events"
CLEAN_KITCHEN_TOPIC = "clean_kitchen_events"
CLEAN_DISPATCH_TOPIC = "clean_dispatch_events"
DLQ_TOPIC = "dead_letter_queue"

# Actions in process order: three kitchen steps, then three dispatch steps.
KITCHEN_ACTIONS = ("PREPARING", "COOKING", "PACKING")
DISPATCH_ACTIONS = ("LOADING", "DELIVERY", "DELIVERED")
COOKING = "COOKING"
LOADING = "LOADING"
DELIVERED = "DELIVERED"

# Event types written into the envelope metadata.
KITCHEN_EVENT_TYPE = "kitchen_action"
DISPATCH_EVENT_TYPE = "dispatch_action"

# Flag labels.
OK = "OK"
SENSOR_FAILURE = "SENSOR_FAILURE"
LOW_HEAT_WARNING = "LOW_HEAT_WARNING"
UNKNOWN = "UNKNOWN"
SUSPICIOUS_DROP = "SUSPICIOUS_DROP"
WARM_TRUCK_WARNING = "WARM_TRUCK_WARNING"

# Dead-letter reasons, in the order they are tested (first match wins).
DLQ_INVALID_JSON = "Invalid JSON String"
DLQ_MISSING_METADATA = "Missing Metadata"
DLQ_MISSING_EVENT_ID = "Missing Event ID"
DLQ_MISSING_EVENT_TYPE = "Missing Event Type"
DLQ_MISSING_PAYLOAD = "Missing Payload"
DLQ_MISSING_BATCH_ID = "Missing Batch ID"
DLQ_MISSING_ACTION = "Missing Batch Action"
DLQ_OTHERS = "Others"

# Journey source tags and location prefixes.
SOURCE_KITCHEN = "Kitchen"
SOURCE_DISPATCH = "Dispatch"
STATION_PREFIX = "Station "
DRIVER_PREFIX = "Driver "

# Default thresholds.
DEFAULT_MAX_TRUCK_TEMP = 5.0
DEFAULT_MIN_COOK_TEMP = 75.0
DEFAULT_MIN_WEIGHT_DROP = 2.0
# ---------------------------------------------------------------------------

# Route labels written by the router (our own names, used as partition values).
ROUTE_CLEAN_KITCHEN = "clean_kitchen"
ROUTE_CLEAN_DISPATCH = "clean_dispatch"
ROUTE_DLQ = "dlq"


@dataclass(frozen=True)
class Thresholds:
    """Business-rule thresholds; comparisons are documented per rule."""

    max_truck_temp: float = DEFAULT_MAX_TRUCK_TEMP
    min_cook_temp: float = DEFAULT_MIN_COOK_TEMP
    min_weight_drop: float = DEFAULT_MIN_WEIGHT_DROP

    @classmethod
    def from_mapping(cls, conf: dict | None) -> "Thresholds":
        conf = conf or {}
        names = {f.name for f in fields(cls)}
        return cls(**{k: float(v) for k, v in conf.items() if k in names})

    @classmethod
    def from_json_file(cls, path: str | Path) -> "Thresholds":
        """Thresholds from a JSON config file; missing file or keys give defaults."""
        p = Path(path)
        if not p.exists():
            return cls()
        return cls.from_mapping(json.loads(p.read_text()))


@dataclass(frozen=True)
class Topics:
    """Topic names; overridable per deployment."""

    kitchen: str = KITCHEN_TOPIC
    dispatch: str = DISPATCH_TOPIC
    clean_kitchen: str = CLEAN_KITCHEN_TOPIC
    clean_dispatch: str = CLEAN_DISPATCH_TOPIC
    dlq: str = DLQ_TOPIC
