"""Streams that keep derived tables current: rollups and deduplicated readings.

Both work batch by batch against what is stored and keep no state and no
watermark, so a reading counts however late it comes or whatever its date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from fleetpulse.operators.dedup import READING_KEY
from fleetpulse.operators.rollups import Rollup
from fleetpulse.schemas import TELEMETRY_SCHEMA, with_day
from fleetpulse.sources.latest_table import LatestTable
from fleetpulse.sources.partial_rollups import PartialRollups
from fleetpulse.sources.rollup_tables import refresh_touched
from fleetpulse.sources.tables import file_by_day, insert_if_absent, read_table


def stream_telemetry(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The telemetry table as a stream of newly stored rows."""
    reader = spark.readStream.schema(with_day(TELEMETRY_SCHEMA))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _writer(stream: DataFrame, write, name: str, checkpoint: str, drain: bool, seconds: float) -> DataStreamWriter:
    writer = stream.writeStream.foreachBatch(write).queryName(name).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=f"{seconds} seconds")


def rollup_stream(
    telemetry: DataFrame,
    rollup: Rollup,
    source: str,
    path: str,
    checkpoint: str,
    drain: bool = False,
    every_seconds: int | None = None,
) -> DataStreamWriter:
    """Keep the rollup at ``path`` current with the telemetry table at ``source``.

    ``telemetry`` is the stream of that table's new rows. Each batch recomputes
    the buckets its rows fall into from the table, as a refresh does; a batch
    that runs again gives the same rows.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        stored = read_table(changes.sparkSession, source, with_day(TELEMETRY_SCHEMA))
        refresh_touched(stored, changes, rollup, path)

    return _writer(telemetry, write, f"rollup-{rollup.name}", checkpoint, drain, every_seconds or rollup.seconds)


def partial_rollup_stream(
    telemetry: DataFrame, path: str, checkpoint: str, drain: bool = False, every_seconds: float = 60.0
) -> DataStreamWriter:
    """Keep the partial sums at ``path`` current; both rollups are read from them.

    ``telemetry`` is the stream of the telemetry table's new rows. A batch reads
    its own rows only, however late they are, and one that runs again writes the
    same parts.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        PartialRollups(path).add(changes, batch_id)

    return _writer(telemetry, write, "partial-rollups", checkpoint, drain, every_seconds)


def latest_stream(
    telemetry: DataFrame, path: str, checkpoint: str, drain: bool = False, every_seconds: float = 2.0
) -> DataStreamWriter:
    """Keep the newest reading of every machine at ``path`` current with the telemetry table.

    ``telemetry`` is the stream of that table's new rows. Merging a batch again
    changes nothing.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        LatestTable(path).merge(changes)

    return _writer(telemetry, write, "latest", checkpoint, drain, every_seconds)


def dedup_stream(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    arrival: Sequence[str],
    drain: bool = False,
    every_seconds: float = 2.0,
) -> DataStreamWriter:
    """Append each reading that is new to the table at ``path``; the first arrival stays, however far apart copies come."""

    def write(batch: DataFrame, batch_id: int) -> None:
        insert_if_absent(file_by_day(batch), path, READING_KEY, arrival, batch.columns)

    return _writer(readings, write, "dedup", checkpoint, drain, every_seconds)
