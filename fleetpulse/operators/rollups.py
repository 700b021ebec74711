"""Tumbling-window summaries per machine, and their refresh."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.times import bucket_ceil, bucket_floor, instant, seconds_before, time_range


# How a measure follows from the readings of a bucket.
AVG, MAX, MIN, COUNT, NOT_ONLINE = "avg", "max", "min", "count", "not online"


@dataclass(frozen=True)
class Measure:
    kind: str
    column: str | None
    name: str

    def of_readings(self) -> Column:
        if self.kind == COUNT:
            column = F.count(F.lit(1))
        elif self.kind == NOT_ONLINE:
            column = F.count_if(F.col("status") != "online")
        else:
            column = {AVG: F.avg, MAX: F.max, MIN: F.min}[self.kind](self.column)
        return column.alias(self.name)


@dataclass(frozen=True)
class Rollup:
    """A summary table: bucket width, measures, and the range a refresh covers."""

    name: str
    seconds: int
    spec: tuple[Measure, ...]
    start_offset: int
    end_offset: int

    def measures(self) -> list[Column]:
        return [m.of_readings() for m in self.spec]


# The measures of both summaries.
FIVE_MINUTE_MEASURES = (
    Measure(AVG, "power_output_kw", "avg_power_kw"),
    Measure(AVG, "wind_speed_ms", "avg_wind_speed_ms"),
    Measure(AVG, "rotor_rpm", "avg_generator_speed"),
    Measure(MAX, "power_output_kw", "max_power_kw"),
    Measure(AVG, "temperature_c", "avg_temp_c"),
    Measure(MAX, "temperature_c", "max_temp_c"),
    Measure(AVG, "vibration_mms", "avg_vibration"),
    Measure(AVG, "bearing_temp_c", "avg_bearing_temp_c"),
    Measure(MAX, "bearing_temp_c", "max_bearing_temp_c"),
    Measure(AVG, "gearbox_sump_temp_c", "avg_gearbox_sump_temp_c"),
    Measure(AVG, "gear_temp_c", "avg_gear_temp_c"),
    Measure(AVG, "ambient_temp_c", "avg_ambient_temp_c"),
    Measure(COUNT, None, "sample_count"),
)
HOURLY_MEASURES = (
    Measure(AVG, "power_output_kw", "avg_power_kw"),
    Measure(MAX, "power_output_kw", "max_power_kw"),
    Measure(MIN, "power_output_kw", "min_power_kw"),
    Measure(AVG, "wind_speed_ms", "avg_wind_ms"),
    Measure(MAX, "wind_speed_ms", "max_wind_ms"),
    Measure(AVG, "rotor_rpm", "avg_rpm"),
    Measure(AVG, "temperature_c", "avg_temp_c"),
    Measure(MAX, "temperature_c", "max_temp_c"),
    Measure(AVG, "vibration_mms", "avg_vibration"),
    Measure(MAX, "vibration_mms", "max_vibration"),
    Measure(AVG, "bearing_temp_c", "avg_bearing_temp_c"),
    Measure(AVG, "gearbox_sump_temp_c", "avg_gearbox_sump_temp_c"),
    Measure(COUNT, None, "sample_count"),
    Measure(NOT_ONLINE, None, "non_online_count"),
)

# Refresh every 5 min over [now-30 min, now-1 min], every 10 min over [now-3 h, now-10 min].
FIVE_MINUTES = Rollup("metrics_5min", 300, FIVE_MINUTE_MEASURES, start_offset=1800, end_offset=60)
HOURLY = Rollup("metrics_1h", 3600, HOURLY_MEASURES, start_offset=10800, end_offset=600)


def build_rollup(telemetry: DataFrame, rollup: Rollup) -> DataFrame:
    """The whole summary; works on a batch and, below a watermark, on a stream."""
    span = F.window("recorded_at", f"{rollup.seconds} seconds")
    summary = telemetry.groupBy(span.alias("span"), "turbine_id").agg(*rollup.measures())
    return summary.select(F.col("span.start").alias("bucket"), *[c for c in summary.columns if c != "span"])


def refresh_range(
    rollup: Rollup, as_of, start_offset: float | None = None, end_offset: float | None = None
) -> tuple[Column, Column]:
    """Whole buckets inside ``[as_of - start_offset, as_of - end_offset]`` as ``[start, end)``."""
    start = seconds_before(as_of, rollup.start_offset if start_offset is None else start_offset)
    end = seconds_before(as_of, rollup.end_offset if end_offset is None else end_offset)
    return bucket_ceil(start, rollup.seconds), bucket_floor(end, rollup.seconds)


def refresh_rollup(
    telemetry: DataFrame,
    summary: DataFrame,
    rollup: Rollup,
    as_of,
    start_offset: float | None = None,
    end_offset: float | None = None,
) -> DataFrame:
    """Recompute the buckets of the range from telemetry; leave all others as they are."""
    start, end = refresh_range(rollup, instant(as_of), start_offset, end_offset)
    bucket = F.col("bucket")
    untouched = summary.where((bucket < start) | (bucket >= end))
    return untouched.unionByName(build_rollup(time_range(telemetry, start, end), rollup))


def rollup_coverage(summaries: dict[str, DataFrame]) -> DataFrame:
    """Rows, machines and first and last bucket of every summary table."""
    lines = [
        summary.agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("turbine_id").alias("turbines"),
            F.min("bucket").alias("earliest"),
            F.max("bucket").alias("latest"),
        ).select(F.lit(name).alias("rollup"), "rows", "turbines", "earliest", "latest")
        for name, summary in summaries.items()
    ]
    report = lines[0]
    for line in lines[1:]:
        report = report.unionByName(line)
    return report
