"""Dead-letter reports and replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.decode import decode
from fleetpulse.operators.normalise import normalise
from fleetpulse.operators.validate import validate
from fleetpulse.schemas import READING_COLUMNS

PREVIEW_LENGTH = 120


def error_counts(dlq: DataFrame) -> DataFrame:
    """Dead letters by reason, most common first."""
    return (
        dlq.groupBy(F.coalesce("error_type", F.lit("unknown")).alias("error_type"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "error_type")
    )


def watch(dlq: DataFrame) -> DataFrame:
    """What an operator follows, with the start of the payload; batch or stream."""
    return dlq.select(
        "failed_at",
        "error_type",
        "error_message",
        "original_topic",
        "original_partition",
        "original_offset",
        F.substring("raw_payload", 1, PREVIEW_LENGTH).alias("payload_preview"),
    )


def replay(dlq: DataFrame) -> DataFrame:
    """Read the payloads again.

    Adds ``action`` to every row: ``skipped`` (no JSON), ``recovered`` (now a
    good reading) or ``failed`` (JSON, still refused), and the reading columns.
    Rows already resolved are left out.
    """
    origin = {
        "topic": F.col("original_topic"),
        "partition": F.col("original_partition"),
        "offset": F.col("original_offset"),
        "timestamp": F.col("failed_at"),
        "value": F.col("raw_payload"),
        "origin": F.col("dlq_id"),
    }
    first_error = {"error_type": "dlq_error_type", "error_message": "dlq_error_message"}
    waiting = dlq.where(~F.col("resolved")).withColumnsRenamed(first_error)
    decoded = decode(waiting.withColumns(origin))
    valid_json = F.col("shape") != "broken"
    checked = validate(normalise(decoded.withColumn("replayable", valid_json)))
    return checked.withColumn(
        "action",
        F.when(~F.col("replayable"), F.lit("skipped"))
        .when(F.col("error_type").isNull(), F.lit("recovered"))
        .otherwise(F.lit("failed")),
    )


def replay_listing(replayed: DataFrame) -> DataFrame:
    """Dry run: what would go back to which topic."""
    action = F.when(F.col("action") == "skipped", F.lit("skip")).otherwise(F.lit("replay"))
    return replayed.select("dlq_id", action.alias("action"), "original_topic", F.col("dlq_error_type").alias("error_type"))


def replay_summary(replayed: DataFrame) -> DataFrame:
    skipped = F.col("action") == "skipped"
    return replayed.agg(F.count_if(~skipped).alias("replayed"), F.count_if(skipped).alias("skipped"))


def replay_messages(replayed: DataFrame) -> DataFrame:
    """Payloads to send back to their topic, unkeyed."""
    return replayed.where(F.col("replayable")).select(
        F.col("original_topic").alias("topic"), F.lit(None).cast("string").alias("key"), F.col("raw_payload").alias("value")
    )


def recovered_readings(replayed: DataFrame) -> DataFrame:
    return replayed.where(F.col("action") == "recovered").select(*READING_COLUMNS, "partition", "offset")


def replay_outcome(replayed: DataFrame, resolved_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """New state of the replayed rows: ``retry_count``, ``resolved``, ``resolved_at``."""
    stamp = F.current_timestamp() if resolved_at is None else resolved_at
    recovered = F.col("action") == "recovered"
    tried = F.col("action") != "skipped"
    return replayed.select(
        "dlq_id",
        "original_topic",
        "original_partition",
        "original_offset",
        "raw_payload",
        F.col("dlq_error_type").alias("error_type"),
        F.when(tried & ~recovered, F.col("error_message")).otherwise(F.col("dlq_error_message")).alias("error_message"),
        "failed_at",
        (F.col("retry_count") + tried.cast("int")).alias("retry_count"),
        recovered.alias("resolved"),
        F.when(recovered, stamp).cast("timestamp").alias("resolved_at"),
        *keep,
    )
