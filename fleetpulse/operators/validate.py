"""Check readings, name every fault, and split good from bad."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import computed_once
from fleetpulse.functions.text import message_id
from fleetpulse.operators.decode import decode
from fleetpulse.operators.normalise import normalise
from fleetpulse.schemas import (
    DLQ_SCHEMA,
    JSON_ERROR,
    MACHINE_ID_LENGTH,
    NUMERIC_BOUNDS,
    READING_COLUMNS,
    REQUIRED_NUMBERS,
    SCHEMA_ERROR,
    STATUSES,
)


def _checks() -> dict[str, str]:
    """Conditions a reading has to meet, by the fault found where one is not met."""
    statuses = ", ".join(f"'{status}'" for status in STATUSES)
    checks = {
        "event_id: not text": "event_id IS NOT NULL",
        "turbine_id: missing or not text": "turbine_id IS NOT NULL",
        "turbine_id: blank": "turbine_id <> ''",
        f"turbine_id: over {MACHINE_ID_LENGTH} characters": f"length(id_text) <= {MACHINE_ID_LENGTH}",
        "recorded_at: missing or no instant": "recorded_at IS NOT NULL",
        f"status: none of {', '.join(STATUSES)}": f"status IN ({statuses})",
        "vibration_mms: not a number": "vibration_mms IS NOT NULL",
    }
    for name in REQUIRED_NUMBERS:
        checks[f"{name}: missing or not a number"] = f"{name} IS NOT NULL"
    for name, (low, high) in NUMERIC_BOUNDS.items():
        checks[f"{name}: outside {low:g}..{high:g}"] = f"({name} IS NULL OR {name} BETWEEN {low}D AND {high}D)"
    return checks


def _faults() -> Column:
    """All faults of a reading, so that it can be mended in one go; NULL if there are none.

    One plain condition clears good readings. The list is made for the others.
    """
    checks = _checks()
    wrong_types = "CASE WHEN size(wrong_types) > 0 THEN concat('wrong type: ', array_join(wrong_types, ', ')) END"
    found = ", ".join([wrong_types, *[f"CASE WHEN NOT {met} THEN '{fault}' END" for fault, met in checks.items()]])
    good = " AND ".join(["wrong_types IS NULL", *checks.values()])
    return F.expr(f"CASE WHEN ({good}) IS NOT TRUE THEN filter(array({found}), fault -> fault IS NOT NULL) END")


def validate(normalised: DataFrame) -> DataFrame:
    """Add ``error_type`` and ``error_message``; both NULL for a good reading."""
    described = normalised.withColumn("faults", _faults())
    broken, other = F.col("shape") == "broken", F.col("shape") == "other"
    faulty = F.col("faults").isNotNull()
    verdict = {
        "error_type": F.when(broken, F.lit(JSON_ERROR)).when(other | faulty, F.lit(SCHEMA_ERROR)),
        "error_message": F.when(broken, F.lit("payload is not valid JSON"))
        .when(other, F.lit("payload is not a JSON object"))
        .when(faulty, F.array_join("faults", "; ")),
    }
    checked = described.withColumns(verdict).drop("faults", "wrong_types", "id_text", "shape")
    return computed_once(checked)


def check_messages(messages: DataFrame) -> DataFrame:
    """Raw messages to one frame that holds good and bad readings alike."""
    return validate(normalise(decode(messages)))


def accepted(checked: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Good readings; ``keep`` adds columns such as the message position."""
    return checked.where(F.col("error_type").isNull()).select(*READING_COLUMNS, *keep)


def rejected(checked: DataFrame, failed_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Bad readings as dead-letter rows: raw text, reason and origin.

    The id follows from the origin, so a redelivered message keeps its row.
    ``keep`` names columns to carry along.
    """
    columns = {
        "dlq_id": message_id(checked, F.lit("dlq")),
        "original_topic": F.col("topic"),
        "original_partition": F.col("partition"),
        "original_offset": F.col("offset"),
        "raw_payload": F.coalesce("value", F.lit("")),
        "error_type": F.col("error_type"),
        "error_message": F.col("error_message"),
        "failed_at": F.current_timestamp() if failed_at is None else failed_at,
        "retry_count": F.lit(0),
        "resolved": F.lit(False),
        "resolved_at": F.lit(None),
    }
    bad = checked.where(F.col("error_type").isNotNull())
    return bad.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in DLQ_SCHEMA], *keep)


def ingest_summary(checked: DataFrame) -> DataFrame:
    """One row of counts for a run over all lines of a log, blank ones included."""
    blank = F.col("value") == ""
    return checked.agg(
        F.count_if(~blank & F.col("error_type").isNull()).alias("published"),
        F.count_if(~blank & (F.col("error_type") == SCHEMA_ERROR)).alias("validation_failures"),
        F.count_if(~blank & (F.col("error_type") == JSON_ERROR)).alias("json_failures"),
        F.count_if(blank).alias("skipped_empty"),
    )
