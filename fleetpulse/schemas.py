"""Column layouts and the fixed tables of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Results depend on them, so they are stated as they are.
# ---------------------------------------------------------------------------

# Inclusive bounds of the numeric fields.
CORE_BOUNDS = {
    "wind_speed_ms": (0.0, 100.0),
    "rotor_rpm": (0.0, 30.0),
    "power_output_kw": (0.0, 5000.0),
    "temperature_c": (-40.0, 150.0),
    "vibration_mms": (0.0, 50.0),
    "blade_pitch_deg": (0.0, 90.0),
}
EXTENDED_BOUNDS = {
    "nacelle_position_deg": (0.0, 360.0),
    "wind_direction_deg": (0.0, 360.0),
    "ambient_temp_c": (-50.0, 60.0),
    "bearing_temp_c": (0.0, 150.0),
    "gearbox_sump_temp_c": (0.0, 200.0),
    "gear_temp_c": (0.0, 400.0),
    "hub_speed": (0.0, 50.0),
}

# Names of the older log layout, by current name.
LEGACY_NAMES = {
    "turbine_id": "Turbine_ID",
    "recorded_at": "Timestamp",
    "wind_speed_ms": "Wind_Speed",
    "rotor_rpm": "Generator_Speed",
    "power_output_kw": "Power",
    "temperature_c": "GeneratorTemp",
    "blade_pitch_deg": "BladePitchAngle",
    "nacelle_position_deg": "Nacelle_Position",
    "wind_direction_deg": "Wind_direction",
    "ambient_temp_c": "Ambient_Air_temp",
    "bearing_temp_c": "Bearing_Temp",
    "gearbox_sump_temp_c": "GearBoxSumpTemp",
    "gear_temp_c": "GearTemp",
    "hub_speed": "Hub_Speed",
}

STATUSES = ("online", "offline", "maintenance", "fault")
SEVERITIES = ("WARNING", "CRITICAL")
MACHINE_ID_LENGTH = 64

JSON_ERROR = "json_decode_error"
SCHEMA_ERROR = "schema_validation_error"

# Histogram bounds in seconds, and in rows for the batch size.
PROCESSING_BUCKETS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0)
WRITE_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
BATCH_ROW_BUCKETS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0)

# ---------------------------------------------------------------------------
# Layouts
# ---------------------------------------------------------------------------

NUMERIC_BOUNDS = {**CORE_BOUNDS, **EXTENDED_BOUNDS}
# A reading without vibration counts as 0.0, so it is core but never missing.
REQUIRED_NUMBERS = tuple(c for c in CORE_BOUNDS if c != "vibration_mms")

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)

READING_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("turbine_id", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        *[T.StructField(c, T.DoubleType()) for c in CORE_BOUNDS],
        T.StructField("status", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in EXTENDED_BOUNDS],
        T.StructField("producer_ts", T.TimestampType()),
    ]
)
READING_COLUMNS = READING_SCHEMA.fieldNames()

# Stored readings: the publish time is replaced by the time of storage.
TELEMETRY_SCHEMA = T.StructType(
    [f for f in READING_SCHEMA.fields if f.name != "producer_ts"]
    + [T.StructField("ingested_at", T.TimestampType())]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("turbine_id", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("severity", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("source_event_id", T.StringType()),
        T.StructField("alert_ts", T.TimestampType()),
    ]
)
ALERT_COLUMNS = ALERT_SCHEMA.fieldNames()

DLQ_ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("dlq_id", T.StringType()),
        T.StructField("original_topic", T.StringType()),
        T.StructField("original_partition", T.IntegerType()),
        T.StructField("original_offset", T.LongType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("failed_at", T.TimestampType()),
        T.StructField("retry_count", T.IntegerType()),
    ]
)
DLQ_SCHEMA = T.StructType(
    DLQ_ENVELOPE_SCHEMA.fields
    + [
        T.StructField("resolved", T.BooleanType()),
        T.StructField("resolved_at", T.TimestampType()),
    ]
)

BATCH_STATS_SCHEMA = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("elapsed_s", T.DoubleType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)


def with_day(schema: T.StructType, name: str = "event_date") -> T.StructType:
    """The stored form of a layout: its columns plus the day it is filed under."""
    return T.StructType(schema.fields + [T.StructField(name, T.DateType())])
