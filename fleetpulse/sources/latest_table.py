"""The newest reading of every machine as a stored table, kept current by merging."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.operators.status import LATEST_NAMES, latest_readings, thermal_status
from fleetpulse.schemas import TELEMETRY_SCHEMA
from fleetpulse.sources.versions import VersionedTable

#: What a stored row is the newest of: all readings, or those with a bearing temperature.
ANY, THERMAL = "any", "thermal"
_THERMAL_COLUMNS = ("bearing_temp_c", "gearbox_sump_temp_c", "gear_temp_c", "temperature_c")
_KEYS = ("kind", "turbine_id")

STATE_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        *[TELEMETRY_SCHEMA[c] for c in ("turbine_id", "recorded_at", *LATEST_NAMES)],
    ]
)


@dataclass(frozen=True)
class LatestTable:
    """Two rows per machine: its newest reading, and its newest one with a bearing temperature.

    Merged are newly stored readings, which are unique by machine and instant.
    The newest of a union is the newest of its parts, so batches may come late,
    in any order and again.
    """

    path: str

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.path, STATE_SCHEMA)

    def merge(self, readings: DataFrame) -> None:
        """Take in a batch; reads the batch and two rows per machine, whatever the history holds."""
        spark, columns = readings.sparkSession, list(LATEST_NAMES)
        version = self.table.version(spark)
        newest = latest_readings(readings, columns).withColumn("kind", F.lit(ANY))
        thermal = latest_readings(readings.where("bearing_temp_c IS NOT NULL"), columns).withColumn("kind", F.lit(THERMAL))
        rows = self.table.read(spark, version).unionByName(newest).unionByName(thermal)
        rest = [f.name for f in STATE_SCHEMA if f.name not in _KEYS]
        merged = rows.groupBy(*_KEYS).agg(F.max_by(F.struct(*rest), "recorded_at").alias("row"))
        self.table.replace(merged.select(*_KEYS, "row.*"), based_on=version)

    def latest_status(self, spark: SparkSession) -> DataFrame:
        """As ``status.latest_status`` of the whole history."""
        rows = self.table.read(spark).where(F.col("kind") == ANY)
        shown = [F.col(c).alias(name) for c, name in LATEST_NAMES.items()]
        return rows.select("turbine_id", F.col("recorded_at").alias("last_seen"), *shown)

    def thermal_health(self, spark: SparkSession) -> DataFrame:
        """As ``status.thermal_health`` of the whole history."""
        rows = self.table.read(spark).where(F.col("kind") == THERMAL)
        return rows.select("turbine_id", "recorded_at", *_THERMAL_COLUMNS, thermal_status().alias("thermal_status"))
