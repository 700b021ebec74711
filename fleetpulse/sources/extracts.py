"""CSV extracts of the telemetry and alert tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.schemas import ALERT_SCHEMA, TELEMETRY_SCHEMA


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # Offsets such as +00 are read by the lenient cast, not by the CSV reader.
    text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.dataType == T.TimestampType() else f.dataType) for f in schema]
    )
    rows = spark.read.schema(text).option("header", True).csv(path)
    return rows.select(
        *[
            F.try_to_timestamp(F.col(f.name)).alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name)
            for f in schema
        ]
    )


def read_telemetry_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TELEMETRY_SCHEMA)


def read_alerts_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ALERT_SCHEMA)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX").csv(path)
