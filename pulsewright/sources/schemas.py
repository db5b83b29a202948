"""Explicit schemas: reader for JSON field lists, and the output tables."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

# Field types of the JSON field lists and the Spark types used.
FIELD_TYPES: Mapping[str, T.DataType] = {
    "INTEGER": T.LongType(),
    "STRING": T.StringType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
}

FieldList = list[dict]


def struct_of(fields: str | FieldList) -> T.StructType:
    """StructType of a ``name/type/mode/fields`` list (JSON text or parsed)."""
    if isinstance(fields, str):
        fields = json.loads(fields)
    out = []
    for f in fields:
        mode = f.get("mode", "NULLABLE")
        kind = struct_of(f["fields"]) if f["type"] == "RECORD" else FIELD_TYPES[f["type"]]
        if mode == "REPEATED":
            kind = T.ArrayType(kind)
        out.append(T.StructField(f["name"], kind, mode != "REQUIRED"))
    return T.StructType(out)


def field(name: str, kind: str, mode: str = "NULLABLE") -> dict:
    return {"name": name, "type": kind, "mode": mode}


def record(name: str, fields: FieldList) -> dict:
    return {"name": name, "type": "RECORD", "mode": "NULLABLE", "fields": fields}


def floats(names: Iterable[str]) -> FieldList:
    return [field(n, "FLOAT") for n in names]


# Labels, zones and periods of the published tables.
SLEEP_LABELS = ("wake", "light", "deep", "rem", "awake", "asleep", "restless", "bedtime_start", "bedtime_end")
MEAL_LABELS = ("meal_start", "peak_postprandial_start", "meal_return_baseline")
EVENT_LABELS = SLEEP_LABELS + MEAL_LABELS
# The order of labels in the columns of the wide table.
WIDE_LABELS = (
    "bedtime_start",
    "bedtime_end",
    "wake",
    "light",
    "rem",
    "deep",
    "awake",
    "asleep",
    "restless",
    "meal_start",
    "peak_postprandial_start",
    "meal_return_baseline",
)
ZONE_NAMES = ("fatburn", "cardio", "peak", "outofrange")
PERIODS = (1, 7, 10, 14)
STATS = ("mean_bpm", "sd_bpm", "min_bpm", "max_bpm")
RESTING_STATS = ("mean_resting_bpm", "sd_resting_bpm", "min_resting_bpm", "max_resting_bpm")
PERIOD_DATES = ("period_start_date", "period_end_date", "earliest_bpm_date", "latest_bpm_date")

_ID = [field("pim_id", "INTEGER"), field("batch_time", "TIMESTAMP"), field("ds", "DATE")]


def _zone_bounds() -> list[str]:
    return [f"{side}_bpm_{zone}" for side in ("min", "max") for zone in ZONE_NAMES]


PERIOD_FIELDS = [field(d, "DATE") for d in PERIOD_DATES] + floats(
    [*STATS, *RESTING_STATS, *_zone_bounds(), "days", "count_"]
)

BPM_FEATURES = _ID + [record(f"period_{n}d", PERIOD_FIELDS) for n in PERIODS]

EVENTS_DETAIL = (
    _ID
    + [field("start_time", "DATETIME"), field("end_time", "DATETIME"), field("event", "STRING", "REQUIRED")]
    + floats([*STATS, "count_"])
)

EVENTS_DAILY = _ID + floats(
    [f"{stat}_{label}" for label in WIDE_LABELS for stat in ("mean_bpm", "sd_bpm", "min_bpm", "max_bpm", "count")]
)

HRV_SUMMARY = [
    field("ds", "DATE"),
    field("pim_id", "INTEGER"),
    *floats(["mean_rmssd", "mean_sdrr"]),
    field("batch_time", "TIMESTAMP"),
]
