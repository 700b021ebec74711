"""Message streams: Kafka topics, and folders of message files with the same columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import computed_once
from fleetpulse.schemas import ALERT_SCHEMA, DLQ_ENVELOPE_SCHEMA, MESSAGE_SCHEMA, READING_COLUMNS

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_OPTIONS = {"timestampFormat": ISO_MICROS}


def _text(value: Column) -> Column:
    """Payload bytes as text, or as hex digits where they are no UTF-8."""
    text = value.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.hex(value))


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    options: dict[str, str] | None = None,
    flush_rows: int | None = None,
    flush_seconds: float = 2.0,
) -> DataFrame:
    """A topic from its earliest offset. Needs Spark's Kafka connector on the class path.

    ``max_offsets`` bounds a micro-batch; every topic partition is read by its
    own task, or by several with the connector's ``minPartitions``. With
    ``flush_rows`` a batch waits for so many rows, ``flush_seconds`` at most.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if flush_rows:
        reader = reader.option("minOffsetsPerTrigger", flush_rows)
        reader = reader.option("maxTriggerDelay", f"{round(flush_seconds * 1000)}ms")
    texts = reader.load().select("topic", "partition", "offset", "timestamp", _text(F.col("value")).alias("value"))
    return computed_once(texts)


def stream_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet files with message columns, each read once."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def _as_messages(df: DataFrame, columns: Sequence[str], key: str | None) -> DataFrame:
    """Keyed payloads, each made once, however often a reader of them looks at it."""
    payload = F.to_json(F.struct(*columns), JSON_OPTIONS)
    keyed = F.lit(None).cast("string") if key is None else F.col(key)
    return computed_once(df.select(keyed.alias("key"), payload.alias("value")))


def reading_messages(readings: DataFrame) -> DataFrame:
    """Readings keyed by machine: one topic partition, so one order, per machine."""
    return _as_messages(readings, READING_COLUMNS, "turbine_id")


def alert_messages(alerts: DataFrame) -> DataFrame:
    return _as_messages(alerts, ALERT_SCHEMA.fieldNames(), "turbine_id")


def dlq_messages(dlq: DataFrame) -> DataFrame:
    """Envelopes without key: their order does not matter and they spread evenly."""
    return _as_messages(dlq, DLQ_ENVELOPE_SCHEMA.fieldNames(), None)


def _from_json(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows, each parsed once: a filter on one of them does not parse again."""
    return messages.select(F.inline(F.array(F.from_json("value", schema, JSON_OPTIONS))))


def alerts_from_messages(messages: DataFrame) -> DataFrame:
    """Alert rows of the alert topic; what is no alert is dropped."""
    return _from_json(messages, ALERT_SCHEMA).where(F.col("alert_id").isNotNull())


def dlq_from_messages(messages: DataFrame) -> DataFrame:
    rows = _from_json(messages, DLQ_ENVELOPE_SCHEMA).where(F.col("dlq_id").isNotNull())
    return rows.withColumns({"resolved": F.lit(False), "resolved_at": F.lit(None).cast("timestamp")})


def publish_to_kafka(messages: DataFrame, servers: str, topic: str, options: dict[str, str] | None = None) -> None:
    """Send one batch of key/value rows."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )


def publish_to_files(messages: DataFrame, path: str) -> None:
    """Append one batch of key/value rows to a folder."""
    messages.write.mode("append").parquet(path)
