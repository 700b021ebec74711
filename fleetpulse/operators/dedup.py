"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

READING_KEY = ("turbine_id", "recorded_at")
ALERT_KEY = ("alert_id",)
DLQ_KEY = ("dlq_id",)


def first_per_key(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The row that arrived first for each key.

    Copies are reduced inside every input partition before the shuffle, so a
    key that holds a large share of all rows sends one row per partition.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*arrival))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*").select(*df.columns)


def dedup_readings(readings: DataFrame, arrival: Sequence[str] = ("offset", "partition")) -> DataFrame:
    """One reading per machine and instant; the first arrival wins."""
    return first_per_key(readings, READING_KEY, arrival)


def dedup_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per id; copies of an id are equal but for their time stamp."""
    return first_per_key(alerts, ALERT_KEY, ("alert_ts",))
