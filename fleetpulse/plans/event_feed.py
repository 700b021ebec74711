"""The ``events`` table seen as a feed of machine readings and of raw messages.

Twelve machines; event time is cut to the minute, so readings of one machine
share an instant now and then. ``seq`` is the order of arrival. The raw messages
mix the current and the older layout with broken and invalid payloads by
``seq % 20``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import computed_once, spread
from fleetpulse.operators.normalise import corrected_status
from fleetpulse.schemas import CORE_BOUNDS, EXTENDED_BOUNDS, LEGACY_NAMES, MACHINE_ID_LENGTH, NUMERIC_BOUNDS
from fleetpulse.session import use_utc
from fleetpulse.sources.messages import JSON_OPTIONS

EVENTS_LAYOUT = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

FIXED_PAYLOADS = ('{"turbine_id": "turbine-01", ', "[1, 2]")

# How a reading follows from an event.
READING_FIELDS = {
    "event_id": "concat('e-', cast(event_id AS string))",
    "turbine_id": "concat('turbine-', lpad(cast(user_id % 12 + 1 AS string), 2, '0'))",
    "recorded_at": "cast(date_trunc('minute', ts) AS timestamp)",
    "wind_speed_ms": "cast(event_id * 37 % 251 AS double) / 10",
    "rotor_rpm": "CASE WHEN event_type = 'error' THEN cast(0 AS double) ELSE cast(event_id * 53 % 201 AS double) / 10 END",
    "power_output_kw": "CASE WHEN event_type = 'error' THEN cast(0 AS double)"
    " WHEN event_type = 'signup' THEN cast(event_id * 11 % 60 AS double)"
    " ELSE cast(event_id * 91 % 20000 AS double) / 10 END",
    "temperature_c": "cast(event_id * 29 % 1100 AS double) / 10",
    "vibration_mms": "cast(event_id * 43 % 11000 AS double) / 1000",
    "blade_pitch_deg": "cast(event_id * 61 % 901 AS double) / 10",
    "status": "CASE event_type WHEN 'purchase' THEN 'maintenance' WHEN 'view' THEN 'offline' ELSE 'online' END",
    "nacelle_position_deg": "cast(event_id * 71 % 3601 AS double) / 10",
    "wind_direction_deg": "cast(event_id * 73 % 3601 AS double) / 10",
    "ambient_temp_c": "cast(event_id * 31 % 750 AS double) / 10 - 30",
    "bearing_temp_c": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE cast(event_id * 17 % 800 AS double) / 10 END",
    "gearbox_sump_temp_c": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE cast(event_id * 19 % 1300 AS double) / 10 END",
    "gear_temp_c": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(event_id * 23 % 3500 AS double) / 10 END",
    "hub_speed": "cast(event_id * 13 % 51 AS double) / 10",
    "producer_ts": "cast(ts AS timestamp)",
}


def events(spark: SparkSession, folder: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    # The pattern lets the stream read the table as one file or as a folder of files.
    return use_utc(spark).readStream.schema(EVENTS_LAYOUT).parquet(f"{folder}/events.parquet*")


def readings_of(events_frame: DataFrame) -> DataFrame:
    """One reading per event, in the reading layout, plus ``seq`` and ``ingested_at``."""
    fields = events_frame.select(
        F.col("event_id").alias("seq"), *[F.expr(text).alias(name) for name, text in READING_FIELDS.items()]
    )
    return fields.withColumns({"status": corrected_status(), "ingested_at": F.col("producer_ts")})


def _legacy_payload() -> dict:
    values = {LEGACY_NAMES[c]: F.col(c) for c in (*CORE_BOUNDS, *EXTENDED_BOUNDS) if c in LEGACY_NAMES}
    machine = F.substring_index("turbine_id", "-", -1).cast("int").cast("string")
    values["Turbine_ID"] = F.concat(F.lit("Turbine_"), machine)
    values["Timestamp"] = F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss")
    values["Generator_Speed"] = F.col("rotor_rpm") * 10
    values["BladePitchAngle"] = F.col("blade_pitch_deg") * 2
    return values


def messages_of(readings: DataFrame, *keep: Column) -> DataFrame:
    """Raw messages: thirteen good ones and seven bad ones out of twenty; ``keep`` adds columns of their readings."""
    fields = [c for c in readings.columns if c not in ("seq", "ingested_at")]

    def payload(**changes):
        columns = {c: F.col(c) for c in fields} | changes
        return F.to_json(F.struct(*[v.alias(k) for k, v in columns.items() if v is not None]), JSON_OPTIONS)

    legacy = F.to_json(F.struct(*[v.alias(k) for k, v in _legacy_payload().items()]), JSON_OPTIONS)
    kind = F.col("seq") % 20
    value = (
        F.when(kind == 3, legacy)
        .when(kind == 7, F.lit(FIXED_PAYLOADS[0]))
        .when(kind == 9, F.concat(payload(), F.lit(" trailing")))
        .when(kind == 11, payload(wind_speed_ms=F.lit(101.0)))
        .when(kind == 13, payload(temperature_c=None))
        .when(kind == 15, F.lit(FIXED_PAYLOADS[1]))
        .when(kind == 17, payload(status=F.lit("BROKEN")))
        .when(kind == 19, F.replace(payload(), F.lit('"wind_speed_ms":'), F.lit('"wind_speed_ms":null,"was":')))
        .otherwise(payload())
    )
    return _as_messages(readings, value, *keep)


def _as_messages(readings: DataFrame, value: Column, *keep: Column) -> DataFrame:
    """Message columns; the payload is computed once, however often it is looked at."""
    return computed_once(
        readings.select(
            F.lit("raw").alias("topic"),
            (F.col("seq") % 6).cast("int").alias("partition"),
            F.col("seq").alias("offset"),
            F.col("producer_ts").alias("timestamp"),
            value.alias("value"),
            *keep,
        )
    )


def variants_of(readings: DataFrame) -> DataFrame:
    """Messages by ``seq % 5``: all numbers sent as text, a machine id amid blanks, a blank one, one too long, a number that is none."""
    kind = F.col("seq") % 5
    named = F.col("turbine_id")
    changes = {
        "turbine_id": F.when(kind == 1, F.concat(F.lit(" \t"), named, F.lit("  ")))
        .when(kind == 2, F.lit("  \t "))
        .when(kind == 3, F.rpad(named, MACHINE_ID_LENGTH + 1, "0"))
        .otherwise(named),
        "wind_speed_ms": F.when(kind == 4, F.lit("fast")).otherwise(F.col("wind_speed_ms").cast("string")),
    }
    fields = [c for c in readings.columns if c not in ("seq", "ingested_at")]
    columns = {c: F.col(c).cast("string") if c in NUMERIC_BOUNDS else F.col(c) for c in fields} | changes
    return _as_messages(readings, F.to_json(F.struct(*[v.alias(k) for k, v in columns.items()]), JSON_OPTIONS))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_of(events(spark, folder))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages_of(readings_of(spread(events(spark, folder))))


def stream_messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages_of(readings_of(spread(stream_events(spark, folder))))
