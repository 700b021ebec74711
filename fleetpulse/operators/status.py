"""Latest reading per machine and the lists made from it."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.schemas import STATUSES

# Output name by reading column.
LATEST_NAMES = {
    "power_output_kw": "last_power_kw",
    "wind_speed_ms": "last_wind_ms",
    "temperature_c": "last_temp_c",
    "rotor_rpm": "last_rpm",
    "vibration_mms": "last_vibration",
    "bearing_temp_c": "last_bearing_temp_c",
    "gearbox_sump_temp_c": "last_gearbox_sump_temp_c",
    "gear_temp_c": "last_gear_temp_c",
    "nacelle_position_deg": "last_nacelle_deg",
    "wind_direction_deg": "last_wind_direction_deg",
    "ambient_temp_c": "last_ambient_temp_c",
    "hub_speed": "last_hub_speed",
    "status": "status",
}
# First match wins; these limits differ from the alert rules on purpose.
THERMAL_LIMITS = (
    ("bearing_temp_c", 65, "bearing_warning"),
    ("gearbox_sump_temp_c", 95, "gearbox_warning"),
    ("gear_temp_c", 280, "gear_warning"),
    ("temperature_c", 85, "generator_warning"),
)
# Order of the ranked list.
THERMAL_RANK = ("bearing_warning", "gear_warning", "gearbox_warning", "generator_warning")


def latest_readings(readings: DataFrame, columns: Sequence[str], arrival: str | None = None) -> DataFrame:
    """``columns`` of the newest reading per machine, with its ``recorded_at``.

    Stored telemetry holds one reading per machine and instant. There every
    column is carried by its own fixed-width buffer (the status as its position
    in the list of statuses), which lets Spark aggregate in a hash table inside
    generated code: one scan, no sort, one row per machine and partition
    shuffled.

    Frames that may hold several readings of one instant name the numeric
    ``arrival`` column; the first arrival of the newest instant is taken.
    """
    order = F.col("recorded_at")
    if arrival is not None:
        # Instant and arrival in one number of fixed width, which a hash aggregate can hold.
        micros = F.unix_micros("recorded_at").cast("decimal(18,0)")
        order = micros * F.lit(Decimal(10**19)) - F.col(arrival).cast("decimal(19,0)")
    names = F.array(*[F.lit(s) for s in STATUSES])
    newest = [
        F.max_by(F.array_position(names, F.col(c)) if c == "status" else F.col(c), order).alias(c)
        for c in columns
    ]
    grouped = readings.groupBy("turbine_id").agg(F.max("recorded_at").alias("recorded_at"), *newest)
    shown = [F.element_at(names, F.col(c).cast("int")).alias(c) if c == "status" else F.col(c) for c in columns]
    return grouped.select("turbine_id", "recorded_at", *shown)


def latest_status(readings: DataFrame, arrival: str | None = None) -> DataFrame:
    """All sensors of the newest reading per machine."""
    latest = latest_readings(readings, list(LATEST_NAMES), arrival)
    return latest.select(
        "turbine_id",
        F.col("recorded_at").alias("last_seen"),
        *[F.col(c).alias(shown) for c, shown in LATEST_NAMES.items()],
    )


def fleet_status(latest: DataFrame) -> DataFrame:
    return latest.select(
        "turbine_id", "last_seen", "last_power_kw", "last_wind_ms", "last_temp_c", F.col("status").alias("last_status")
    ).orderBy("turbine_id")


def latest_core(latest: DataFrame) -> DataFrame:
    return latest.select(
        "turbine_id",
        F.col("last_seen").alias("ts"),
        "last_wind_ms",
        "last_rpm",
        "last_power_kw",
        "last_temp_c",
        "last_vibration",
        "status",
    ).orderBy("turbine_id")


def latest_extended(latest: DataFrame) -> DataFrame:
    return latest.select(
        "turbine_id",
        F.col("last_seen").alias("ts"),
        "last_nacelle_deg",
        "last_wind_direction_deg",
        "last_ambient_temp_c",
        "last_bearing_temp_c",
        "last_gearbox_sump_temp_c",
        "last_gear_temp_c",
        "last_hub_speed",
    ).orderBy("turbine_id")


def thermal_status() -> Column:
    column, limit, label = THERMAL_LIMITS[0]
    status = F.when(F.col(column) > limit, F.lit(label))
    for column, limit, label in THERMAL_LIMITS[1:]:
        status = status.when(F.col(column) > limit, F.lit(label))
    return status.otherwise(F.lit("ok"))


def thermal_health(readings: DataFrame, arrival: str | None = None) -> DataFrame:
    """Newest reading with a bearing temperature per machine, and what runs hot."""
    columns = ["bearing_temp_c", "gearbox_sump_temp_c", "gear_temp_c", "temperature_c"]
    latest = latest_readings(readings.where(F.col("bearing_temp_c").isNotNull()), columns, arrival)
    return latest.select("turbine_id", "recorded_at", *columns, thermal_status().alias("thermal_status"))


def thermal_list(health: DataFrame) -> DataFrame:
    return health.orderBy("turbine_id")


def thermal_rank() -> Column:
    rank = F.when(F.col("thermal_status") == THERMAL_RANK[0], F.lit(1))
    for place, label in enumerate(THERMAL_RANK[1:], start=2):
        rank = rank.when(F.col("thermal_status") == label, F.lit(place))
    return rank.otherwise(F.lit(len(THERMAL_RANK) + 1))


def thermal_ranked(health: DataFrame) -> DataFrame:
    """The thermal list, most serious first."""
    return health.orderBy(thermal_rank(), "turbine_id").select(
        "turbine_id",
        F.col("recorded_at").alias("ts"),
        F.col("temperature_c").alias("gen_temp_c"),
        "bearing_temp_c",
        F.col("gearbox_sump_temp_c").alias("gbx_sump_c"),
        "gear_temp_c",
        "thermal_status",
    )
