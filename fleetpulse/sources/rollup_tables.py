"""Stored rollups: full build and refresh in place."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.times import bucket_floor, instant, time_range
from fleetpulse.operators.rollups import Rollup, build_rollup, refresh_range
from fleetpulse.schemas import TELEMETRY_SCHEMA, with_day
from fleetpulse.sources.tables import (
    BUCKET_DAY,
    drop_days,
    file_by_day,
    read_table,
    replace_days,
    spread_by_day,
    stored_days,
    upsert,
)

ROLLUP_KEY = ("bucket", "turbine_id")


def rollup_schema(spark: SparkSession, rollup: Rollup) -> T.StructType:
    """Stored layout, derived from the measures themselves."""
    empty = spark.createDataFrame([], TELEMETRY_SCHEMA)
    built = build_rollup(empty, rollup).schema
    return with_day(T.StructType([T.StructField(f.name, f.dataType) for f in built]), BUCKET_DAY)


def _replace(spark: SparkSession, rows: DataFrame, path: str, before: list) -> None:
    """Write the days of ``rows``, and remove those of ``before`` that have no rows any more.

    What reaches the driver is a value per calendar day of the range.
    """
    rows = rows.persist()
    try:
        filled = {row[0] for row in rows.select(BUCKET_DAY).distinct().collect()}
        replace_days(spread_by_day(rows, BUCKET_DAY), path, BUCKET_DAY)
    finally:
        rows.unpersist()
    drop_days(spark, path, BUCKET_DAY, [day for day in before if day not in filled])


def store_rollup(telemetry: DataFrame, rollup: Rollup, path: str) -> None:
    """Summarise the whole history; days without readings go."""
    spark = telemetry.sparkSession
    summary = file_by_day(build_rollup(telemetry, rollup), "bucket", BUCKET_DAY)
    _replace(spark, summary, path, stored_days(spark, path, BUCKET_DAY))


def refresh_stored_rollup(
    telemetry: DataFrame,
    rollup: Rollup,
    path: str,
    as_of,
    start_offset: float | None = None,
    end_offset: float | None = None,
) -> None:
    """Recompute the buckets of the refresh range, and rewrite only the days they are in.

    Buckets of those days outside the range are carried over; buckets of the
    range without readings go, and so do days left empty.
    """
    spark = telemetry.sparkSession
    start, end = refresh_range(rollup, instant(as_of), start_offset, end_offset)
    bucket = F.col("bucket")
    day_range = F.col(BUCKET_DAY).between(F.to_date(start), F.to_date(end))
    stored = read_table(spark, path, rollup_schema(spark, rollup)).where(day_range)
    carried = stored.where((bucket < start) | (bucket >= end))
    fresh = file_by_day(build_rollup(time_range(telemetry, start, end), rollup), "bucket", BUCKET_DAY)
    _replace(spark, carried.unionByName(fresh), path, stored_days(spark, path, BUCKET_DAY, day_range))


def refresh_touched(telemetry: DataFrame, changes: DataFrame, rollup: Rollup, path: str) -> None:
    """Recompute the buckets that ``changes`` (new readings) fall into, from the stored telemetry.

    Nothing is kept between calls, so a reading is counted however late or early
    its time is. Only the days of the changes are read and rewritten.
    """
    spark = telemetry.sparkSession
    bucket = bucket_floor(F.col("recorded_at"), rollup.seconds)
    touched = changes.select("turbine_id", bucket.alias("bucket")).distinct().persist()
    try:
        row = touched.agg(F.min("bucket"), F.max("bucket")).first()
        if row[0] is None:
            return
        start, end = F.lit(row[0]), F.lit(row[1] + timedelta(seconds=rollup.seconds))
        within = time_range(telemetry, start, end).withColumn("bucket", bucket)
        readings = within.join(touched, ["turbine_id", "bucket"], "left_semi").drop("bucket")
        fresh = file_by_day(build_rollup(readings, rollup), "bucket", BUCKET_DAY)
        upsert(fresh, path, ROLLUP_KEY, BUCKET_DAY, rollup_schema(spark, rollup))
    finally:
        touched.unpersist()
